import random

import pytest

from casebook.llm import lines
from casebook.llm.queries import op6


def aligned(a, b):
    """Length of a longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        old = 0
        for j, y in enumerate(b, 1):
            old, row[j] = row[j], old + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def shared(earlier, later, words, least):
    """Lines of the later list in runs of so many words that the earlier one holds, run by run."""
    gone = set()
    for s in range(len(later)):
        for p in range(len(earlier)):
            k = 0
            while p + k < len(earlier) and s + k < len(later) and earlier[p + k] == later[s + k]:
                k += 1
            if sum(words[s : s + k]) >= least:
                gone.update(range(s, s + k))
    return sorted(gone)


@pytest.mark.parametrize("kinds", [2, 4, 9, 25])
@pytest.mark.parametrize("piece", [1, 3, 256])
def test_alignment_finds_every_block(kinds, piece, monkeypatch):
    monkeypatch.setattr(lines, "PIECE", piece)
    rng = random.Random(kinds)
    size = {k: rng.choice([0, 1, 3, 9, 12]) for k in range(kinds)}
    for _ in range(300):
        parts = [[rng.randrange(kinds) for _ in range(rng.randrange(1, 7))] for _ in range(4)]
        a, b = ([x for _ in range(rng.randrange(7)) for x in [*rng.choice(parts), *[rng.randrange(kinds)] * rng.randrange(2)]] for _ in "ab")
        words = [size[x] for x in b]
        assert lines.repeated_lines(a, b, words, 25) == shared(a, b, words, 25)


def test_alignment_decides(monkeypatch):
    """Without either part of the alignment blocks stay."""
    p, q = list(range(8)), list(range(20, 28))
    a, b, words = [*p, 100, *q], [*q, 101, *p], [10] * 17
    assert len(lines.repeated_lines(a, b, words, 25)) == 16
    monkeypatch.setattr(lines, "exact_blocks", lambda *_: set())
    assert len(lines.repeated_lines(a, b, words, 25)) == 8
    monkeypatch.setattr(lines, "patience", lambda *_: [])
    assert lines.repeated_lines(a, b, words, 25) == []


def test_circles_are_aligned_once():
    line = [3] * 50_000
    assert lines.repeated_lines(line[:40_000], [*line, 9], [1] * 50_001, 25) == list(range(50_000))


def test_a_hot_holder_is_sent_to_in_parts(frame, monkeypatch):
    """A long first holder whose passage stands in many documents; some of these hold runs of others too."""
    monkeypatch.setattr(lines, "SENT", 10)
    docs = {0: "\n".join(f"line {k} of the holder" for k in range(300)) + "\n" + P}
    docs |= {k: f"own {k}\n{P}\nend {k}" for k in range(1, 80)}
    docs[90] = docs[0] + "\n" + docs[5]
    got = {r.doc_id: r.text for r in lines.dedup_lines(frame(list(docs.items()))).collect()}
    assert got == without_earlier_runs(docs)


def test_patience_is_an_alignment():
    rng = random.Random(2)
    for _ in range(400):
        a = [rng.randrange(12) for _ in range(rng.randrange(25))]
        b = [rng.randrange(12) for _ in range(rng.randrange(25))]
        pairs = lines.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
        assert len(pairs) <= aligned(a, b)
    unique = list(range(40))
    other = [x for x in unique if x % 5] + [100]
    assert len(lines.patience(unique, other)) == 32


P = "\n".join(f"passage line number {k} of ten words in all here now" for k in range(6))


def test_rows(frame):
    rows = [
        (1, f"head one\n{P}\ntail one"),
        (2, f"other head\n{P}\nother tail"),
        (3, P),
        (4, "Released under the license of all\nown text " + "w " * 40),
        (5, "Released under the license of all\nanother text " + "v " * 40),
        (6, None),
        (7, ""),
        (None, P),
        (8, f"x\n{P.replace(' ', '  ')}\r\ny"),
        (8, f"x\n{P.replace(' ', '  ')}\r\ny"),
        (9, f"a text\n{P}"),
        (9, f"{P}\nand another"),
        (10, "long " * 100_000),
        (11, "long " * 100_000),
    ]
    df = lines.dedup_lines(frame(rows).selectExpr("*", "7 as removed_lines", "'k' as keep"))
    got = [(r.doc_id, r.text, r.removed_lines) for r in df.collect()]
    assert len(got) == len(rows)
    assert set(df.columns) >= {"doc_id", "text", "key", "keep", "removed_words"}
    texts = {}
    for i, t, n in got:
        texts.setdefault(i, []).append((t, n))
    assert texts[1] == [(rows[0][1], 0)] and texts[2] == [("other head\nother tail", 6)]
    assert texts[3] == [("", 6)] and texts[4] == [(rows[3][1], 0)] and texts[5] == [(rows[4][1], 0)]
    assert texts[6] == [(None, 0)] and texts[7] == [("", 0)] and texts[None] == [(P, 0)]
    assert texts[8] == [("x\ny", 6)] * 2 and sorted(texts[9]) == sorted([(rows[10][1], 0), (rows[11][1], 0)])
    assert texts[10] == [(rows[12][1], 0)] and texts[11] == [("", 1)]


def test_empty_table(frame):
    assert lines.dedup_lines(frame([])).collect() == []


def test_passages_held_twice_and_moved_blocks_go():
    p, q = list(range(8)), list(range(20, 28))
    once, twice = [100, *p, 101], [102, *p, 103, *p, 104]
    ten = [10] * 40
    assert lines.repeated_lines(once, twice, ten[: len(twice)], 25) == [*range(1, 9), *range(10, 18)]
    assert lines.repeated_lines(twice, once, ten[: len(once)], 25) == list(range(1, 9))
    assert lines.repeated_lines([*p, 100, *q], [*q, 101, *p], ten[:17], 25) == [*range(8), *range(9, 17)]


def test_rows_with_passages_held_twice_and_moved(frame):
    q = P.replace("passage", "other")
    rows = [(1, f"head\n{P}\nmid\n{P}\n{q}"), (2, f"h\n{P}\nt"), (3, f"{q}\nx\n{P}\ny\n{P}\nz"), (4, f"{q}\nend\n{P}\n{P}")]
    got = {r.doc_id: r.text for r in lines.dedup_lines(frame(rows)).collect()}
    assert got == {1: rows[0][1], 2: "h\nt", 3: "x\ny\nz", 4: "end"}


def test_a_passage_of_lines_first_held_by_different_documents_goes(frame):
    a, b, c = (f"part {x} of the passage has these ten words in it" for x in "abc")
    short = "two words\n" * 12 + "two words"
    both = f"{a}\n{b}\n{c}"
    texts = [f"x\n{a}", f"y\n{b}", f"z\n{c}", f"u\n{both}", f"v\n{both}\nw", f"{short}\nr", f"q\n{short}"]
    got = {r.doc_id: r.text for r in lines.dedup_lines(frame(list(enumerate(texts)))).collect()}
    assert got == dict(enumerate(texts)) | {4: "v\nw", 6: "q"}


def test_a_line_goes_with_the_run_that_only_a_second_holder_has(frame):
    long = "long line " * 15
    texts = [f"x\n{long}\ny", f"{long}\nshort one\nz", f"a\n{long}\nshort one\nb", f"c\nshort one\n{long}\nshort one"]
    got = {r.doc_id: r.text for r in lines.dedup_lines(frame(list(enumerate(texts)))).collect()}
    assert got == {0: texts[0], 1: "short one\nz", 2: "a\nb", 3: "c\nshort one"}


def without_earlier_runs(docs, least=25):
    """Texts without the lines in any run of ``least`` words or more of consecutive lines that any
    earlier document holds. Uses nothing of the operator."""
    places, out = {}, {}
    for i in sorted(docs):
        raw = docs[i].split("\n")
        own = [" ".join(x.split()) for x in raw]
        words = [len(x.split()) for x in own]
        gone = set()
        for s, x in enumerate(own):
            for other, p in places.get(x, ()):
                if s and p and other[p - 1] == own[s - 1]:
                    continue  # part of a run that starts further up
                k = 0
                while p + k < len(other) and s + k < len(own) and other[p + k] == own[s + k]:
                    k += 1
                if sum(words[s : s + k]) >= least:
                    gone.update(range(s, s + k))
        for p, x in enumerate(own):
            places.setdefault(x, []).append((own, p))
        out[i] = "\n".join(x for k, x in enumerate(raw) if k not in gone)
    return out


def test_query_deletes_every_run_that_an_earlier_document_holds(spark, sf, documents):
    assert {r.doc_id: r.text for r in op6(spark, sf).collect()} == without_earlier_runs(documents)


def test_random_rows_lose_every_run_that_an_earlier_document_holds(frame):
    rng = random.Random(5)
    kinds = ["", "one", "two words", "a line of five words", "a line that has eight words in all", "long " * 26]
    pieces = [[rng.choice(kinds) + (f" {rng.randrange(3)}" if rng.random() < 0.5 else "") for _ in range(rng.randrange(1, 9))] for _ in range(12)]
    docs = {}
    for i in range(150):
        picked = [x for _ in range(rng.randrange(1, 6)) for x in [*rng.choice(pieces), *[f"own {i}"] * rng.randrange(2)]]
        docs[i] = "\n".join(picked)
    got = {r.doc_id: r.text for r in lines.dedup_lines(frame(list(docs.items()))).collect()}
    want = without_earlier_runs(docs)
    assert got == want
    assert sum(want[i] not in ("", docs[i]) for i in docs) > 50
