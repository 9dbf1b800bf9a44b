import math
import random
import re
from collections import Counter
from fractions import Fraction

import duckdb
import pytest

from casebook.llm import rules
from casebook.llm.queries import op1


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    counts = Counter(windows)
    marked = {k + d for k, w in enumerate(windows) if counts[w] > 1 for d in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(marked))


def test_statistics_of_random_texts():
    rng = random.Random(1)
    texts = [None, "", " \n\n", "\x0b\x0c", "a b c a b c", "x x x", "#\n#\n#"]
    texts += ["".join(rng.choice("ab# \n\té😀\x1c\x85 |") for _ in range(rng.randrange(80))) for _ in range(500)]
    texts += ["z " * 1_000_000]
    n, chars, symbols, _, dup, repeat = rules.statistics(texts)
    assert list(zip(n, chars, symbols, dup, repeat, strict=True)) == [brute(t) for t in texts]


def test_query(spark, sf, documents):
    labels = dict(duckdb.sql(f"select doc_id, quality from '{sf}/labels.parquet'").fetchall())
    rows = op1(spark, sf).collect()
    for r in rows:
        own = brute(documents[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == own
        assert r.base_failed == (own[0] < 50 or 100 * own[4] > 50 * own[0])
        assert r.kept == (not r.failed_rules) and not (r.base_failed and r.kept)
    assert len(rows) == len(documents) and labels


def test_binomial_tail_is_exact():
    p = Fraction(3, 100)
    for n in (1, 7, 60, 200):
        for k in range(0, min(n, 6) + 1):
            exact = sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1))
            got = rules.binomial_tail(k, n, 0.03)
            assert got == pytest.approx(float(exact), rel=1e-9) or (got == 1.0 and k > n * 0.03)
    assert 0 < rules.binomial_tail(29_500, 1_000_000, 0.03) < 0.01
    assert rules.binomial_tail(3_000_000 - 100, 100_000_000, 0.03) == pytest.approx(0.5, abs=0.03)


def test_sequence_stops_at_the_first_failure():
    assert rules.chosen(1000, [0, 2, 900, 0], (0.9, 0.8, 0.7, 0.6), 0.02, 0.01) == 0.8
    assert rules.chosen(20, [0, 0], (0.9, 0.8), 0.02, 0.01) is None
    assert rules.chosen(0, [0, 0], (0.9, 0.8), 0.02, 0.01) is None


def texts_of(rng, bad):
    words = [f"w{rng.randrange(10**6)}" for _ in range(60)]
    return " ".join(w + "#" * (rng.random() < (0.9 if bad else 0.01)) for w in words)


def test_false_rejections_stay_below_the_bound(spark):
    """Cutoffs of small holdouts, judged on fresh documents of the same kind."""
    rng = random.Random(7)
    rows = [(k, texts_of(rng, k % 5 == 0), "en" if k % 3 else "de") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, int(k % 5 != 0)) for k in range(2000)], "doc_id long, quality int")
    judged = rules.judge(docs, labels, alpha=0.09).collect()
    fresh = [r for r in judged if r.doc_id >= 2000]
    assert sum(not r.kept for r in fresh if r.doc_id % 5) <= 0.09 * len(fresh)
    assert sum(r.kept for r in fresh if r.doc_id % 5 == 0) < 0.1 * len(fresh)


def test_rows(spark, frame):
    good = " ".join(f"word{k}" for k in range(60))
    rows = [(1, good), (2, None), (3, ""), (4, "few words"), (4, "few words"), (None, good), (5, "again and again " * 100_000)]
    docs = frame(rows).selectExpr("*", "cast(null as string) as lang", "1 as kept", "2 as n_words", "'s' as stratum", "0 as quality")
    labels = spark.createDataFrame([(1, 1), (1, 0), (9, None)], "doc_id long, quality int")
    got = rules.judge(docs, labels).collect()
    assert len(got) == len(rows)
    kept = {r.doc_id: r.kept for r in got}
    assert kept == {1: True, 2: False, 3: False, 4: False, None: True, 5: False}
    assert rules.judge(docs.filter("false"), labels).collect() == []
    assert {r.kept for r in rules.judge(docs, labels.filter("false")).collect()} == {True, False}


def test_clashing_names_pass_unchanged(spark, frame):
    """Columns called like inner ones, of this operator or of an earlier form of it, come through."""
    good = " ".join(f"word{k}" for k in range(60))
    inner = ("_stratum", "_symbol_rate", "_dup_line_rate", "_repeat_rate", "symbol_rate", "symbol_rate_limit", "stratum", "marked", "quality", "c0", "c1", "good", "_id", "ID2")
    docs = frame([(k, good) for k in range(4)]).selectExpr("*", "'en' as lang", *(f"concat('own ', doc_id) as `{n}`" for n in inner))
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    for with_text in (True, False):
        got = rules.judge(docs, labels, with_text=with_text)
        assert ("text" in got.columns) == with_text and set(inner) <= set(got.columns)
        for r in got.collect():
            assert r.kept and all(r[n] == f"own {r.doc_id}" for n in inner) and r.lang == "en"
