import pytest

from casebook.llm import counts
from casebook.llm.queries import op9, tokenizer


def expected(lengths):
    return {
        n: (
            lengths.count(n), sum(x > n for x in lengths), sum(x for x in lengths if x > n),
            sum(min(x, n) for x in lengths), sum(x <= n for x in lengths), len(lengths), sum(lengths),
        )
        for n in set(lengths)
    }


def got(histogram):
    return {r[0]: tuple(r[1:]) for r in histogram.collect()}


def test_query(spark, sf, documents):
    import public_tokenizers
    from tokenizers import Tokenizer as Library

    library = Library.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lengths = [len(library.encode(t, add_special_tokens=False).ids) for t in documents.values()]
    assert got(op9(spark, sf)) == expected(lengths)


@pytest.mark.parametrize("lengths", [[0], [3, 3, 3], [0, 1, 1023, 1024, 1025, 5000, 5000, 90_000]])
def test_any_limit(spark, lengths):
    histogram = counts.length_histogram(spark.createDataFrame([(x,) for x in lengths] + [(None,)], "n_tokens long")).cache()
    assert got(histogram) == expected(lengths)
    for r in counts.tokens_within(histogram, [1, 1024, 4000, 10**6]).collect():
        assert (r.tokens, r.documents_over) == (sum(min(x, r.context) for x in lengths), sum(x > r.context for x in lengths))
    for r in counts.length_quantile(histogram, [0.25, 0.5, 1.0]).collect():
        assert r.n_tokens == min(x for x in lengths if sum(y <= x for y in lengths) >= r.share * len(lengths))


def test_rows(spark, frame):
    rows = [(1, None), (2, ""), (3, "one"), (3, "one"), (None, "one"), (4, "word " * 100_000)]
    histogram = got(counts.length_histogram(counts.token_lengths(frame(rows), tokenizer(spark))))
    assert histogram == expected([0, 0, 1, 1, 1, 100_000])
    assert got(counts.length_histogram(counts.token_lengths(frame([]), tokenizer(spark)))) == {}
