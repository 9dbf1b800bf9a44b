import hashlib
import random
import zlib

import numpy as np
import pytest

from casebook.llm import periodic
from casebook.llm.queries import op13


def plain_runs(words, least=24, periods=3):
    """Every period and every stretch that keeps it, one after the other."""
    found = {}
    for q in range(1, len(words) // periods + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, periods * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((a, b - a, q) for (a, b), q in found.items())


def plain_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def words_of(text):
    for gap in "\t\n\v\f\r":
        text = (text or "").replace(gap, " ")
    return [w for w in text.split(" ") if w]


def test_query(spark, sf, documents):
    rows = {r.doc_id: r for r in op13(spark, sf).collect()}
    assert rows.keys() == documents.keys()
    some = 0
    for i, text in documents.items():
        words, h = words_of(text), zlib.crc32(str(i).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        runs = plain_runs(words)
        best = min(((-n / q, s, q, n) for s, n, q in runs), default=None)
        want = (len(runs), None, None, None, None)
        if best:
            want = (len(runs), best[1], best[3], best[2], 1000 * best[3] // best[2])
        shown = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(runs, key=lambda r: (r[0], r[2])))
        r = rows[i]
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == want
        assert r.runs_sha256 == hashlib.sha256(shown.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(plain_collapsed(words, runs).encode()).hexdigest()
        some += bool(runs)
    assert some > 5


def looping(rng, letters):
    out = []
    for _ in range(rng.randrange(6)):
        kind = rng.random()
        if kind < 0.3:
            out += [rng.randrange(letters) for _ in range(rng.randrange(30))]
        elif kind < 0.7:
            out += ([rng.randrange(letters) for _ in range(rng.randrange(1, 12))] * 60)[: rng.randrange(1, 60)]
        else:
            out += out[: rng.randrange(40)]
    return out


@pytest.mark.parametrize("letters", [1, 2, 3, 5, 30])
def test_random_words(letters):
    """Several texts at once, with small alphabets, loops in loops and repeated parts."""
    rng = random.Random(letters)
    for _ in range(150):
        texts = [looping(rng, letters) for _ in range(rng.randrange(1, 5))]
        ids = np.array([x for t in texts for x in t], np.int64)
        number = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        want, at = [], 0
        for t in texts:
            want += [[s + at, n, q] for s, n, q in plain_runs(t)]
            at += len(t)
        found = periodic.runs_of(ids, number).tolist() if len(ids) else []
        assert found == sorted(want, key=lambda r: (r[0], r[2]))


def test_no_pair_repeats_in_the_grammar_and_roots_derive_the_text():
    rng = random.Random(9)
    ids = np.array([rng.randrange(4) for _ in range(2000)], np.int64)
    grammar = periodic.Grammar(ids, np.repeat([0, 1], [700, 1300]))

    def derive(symbol):
        if symbol < grammar.words:
            return [int(symbol)]
        return derive(grammar.left[symbol]) + derive(grammar.right[symbol])

    assert len(grammar.roots) == 2 and derive(grammar.roots[0]) + derive(grammar.roots[1]) == ids.tolist()
    for symbol in range(grammar.words, len(grammar.size), 37):
        at = int(grammar.first[symbol])
        assert derive(symbol) == ids[at : at + grammar.size[symbol]].tolist()


def test_shared_hashes_are_noticed(monkeypatch):
    """Words that share a hash form no run: the texts concerned are done again by their words."""
    real = periodic.Words

    class Same(real):
        def __init__(self, texts, fold):
            super().__init__(texts, fold)
            self.hashes = self.hashes % np.uint64(2)

    monkeypatch.setattr(periodic, "Words", Same)
    texts = [" ".join(f"w{k % 7}" for k in range(60)), " ".join(f"w{k}" for k in range(90))]
    found = [runs.tolist() for runs, _ in periodic.runs_of_texts(t.encode() for t in texts)]
    assert found == [[[0, 60, 7]], []]


def test_rows(spark, frame):
    loop = "to be or not " * 10 + "that"
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, loop), (4, loop), (None, loop), (5, "one word"), (6, "x " * 300_000), (7, "é 😀\n" * 12), (8, "a\x85b " * 30)]
    df = frame(rows).selectExpr("*", "'y' as start", "'z' as runs")
    out = periodic.add_runs(df).collect()
    assert len(out) == len(rows)
    got = {r.doc_id: (list(r.runs), r.start, r.length, r.period, r.collapsed) for r in out}
    assert got[1] == got[2] == got[3] == ([], None, None, None, "")
    assert got[4] == got[None] == ([0, 40, 4], 0, 40, 4, "to be or not that")
    assert got[5] == ([], None, None, None, "one word")
    assert got[6] == ([0, 300_000, 1], 0, 300_000, 1, "x")
    assert got[7] == ([0, 24, 2], 0, 24, 2, "é 😀") and got[8] == ([0, 30, 1], 0, 30, 1, "a\x85b")
    assert out[0].key == "x" and periodic.add_runs(frame([])).collect() == []


def test_strongest():
    runs = np.array([[0, 30, 10], [50, 60, 20], [5, 24, 8], [90, 25, 9]])
    assert periodic.strongest(runs) == (0, 30, 10)
    assert periodic.strongest(np.array([[0, 3 * 10**9, 10**9], [7, 3 * 10**9 + 1, 10**9]])) == (7, 3 * 10**9 + 1, 10**9)
