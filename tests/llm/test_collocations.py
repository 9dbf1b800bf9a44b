import random
import re
from collections import Counter

import numpy as np
import pytest

from casebook.llm import collocations
from workload.check import connect

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, top):
    """Brute force over (lang, text) with Python's integers."""
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 6):
                own.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, own in counts.items():
        many = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in many.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i : i + k]] = max(inside[p[i : i + k]], a)
        found = []
        for p, a in many.items():
            if 100 * inside[p] < 100 * a:
                n = totals[lang]
                score, k = min((1000 * a * n // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]], n))
        for rank, (score, a, phrase, left, right, n) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize(("least", "top", "budget"), [(8, 2000, 1 << 20), (4, 30, 200), (3, 2000, 20)])
def test_documents(spark, sf, least, top, budget):
    """Also with budgets that need many groups and prefixes of up to five words."""
    rows = connect(sf).execute("select lang, text from documents").fetchall()
    df = spark.read.parquet(f"{sf}/documents.parquet").repartition(5)
    found = got(collocations.collocations(df, least=least, top=top, budget=budget))
    assert found == plain(rows, least, top) and len(found) > 20


def test_random_words(spark, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK", 300)
    rng = random.Random(8)
    rows = []
    for _ in range(300):
        letters = rng.choice(["ab", "abc", "A b.", "x y é"])
        rows.append((rng.choice(["de", "en", None, "und"]), "".join(rng.choice([*letters, " ", " ", "\t", "\n", ";"]) for _ in range(rng.randrange(80)))))
    rows += [("hot", "the same line again and again\n" * 40)] * 50
    df = spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "1 as phrase", "2 as n", "3 as rank", "'w' as w1", "4 as a")
    for budget in (1 << 20, 50):
        assert got(collocations.collocations(df, least=5, budget=budget)) == plain(rows, 5, 2000)


def test_shared_hashes(spark, monkeypatch):
    """Another seed is taken when two words share a hash, and words are told apart letter by letter."""
    real = collocations.Pieces

    class Some(real):
        def __init__(self, texts, seed):
            super().__init__(texts, seed)
            if seed == 1:
                self.hashes = self.hashes % np.uint64(3) + np.uint64(1)

    monkeypatch.setattr(collocations, "Pieces", Some)
    pieces = Some([b"aa bb aa cc dd", b"ee aa"], 1)
    _, first, back = np.unique(pieces.hashes, return_index=True, return_inverse=True)
    spelled = [pieces.word(k) for k in range(7)]
    flags = collocations.differing(pieces, first[back])
    assert flags.tolist() == [w != spelled[first[b]] for w, b in zip(spelled, back, strict=True)]
    # What the executors do is not patched; the driver's loop over seeds is.
    seeds = []
    counts = collocations.word_counts

    def clashing(docs, seed):
        seeds.append(seed)
        out = counts(docs, seed)
        return out.withColumn("w1", out.w1 * 0 + 1) if seed == 1 else out

    monkeypatch.setattr(collocations, "word_counts", clashing)
    rows = [("en", "big red bus " * 9)]
    assert got(collocations.collocations(spark.createDataFrame(rows, "lang string, text string"), least=3)) == plain(rows, 3, 2000)
    assert seeds == [1, 2]


def test_rows(spark):
    rows = [("en", None), ("en", ""), (None, "a b " * 200), (None, "a b " * 200), ("xx", "one. two; three"), ("long", "w" * 300 + " " + "v" * 300 + " ") , ("far", "far away " * 50_000)]
    rows[5] = ("long", rows[5][1] * 120)
    df = spark.createDataFrame(rows, "lang string, text string")
    found = got(collocations.collocations(df))
    assert found == plain(rows, 100, 2000) and {r[0] for r in found} == {"und", "long", "far"}
    assert got(collocations.collocations(df.limit(0))) == []


def test_scores_beyond_64_bits(spark):
    """1000 * a * n / (l * r) in decimals, with counts of 10**15."""
    big = 10**15 - 7
    df = spark.createDataFrame([(big, big, 123_456_789, 987_654_321)], "a long, n long, l long, r long")
    exact = lambda c: f"cast({c} as decimal(15, 0))"
    value = df.selectExpr(f"(1000BD * {exact('a')} * {exact('n')}) div ({exact('l')} * {exact('r')}) as s").first().s
    assert value == 1000 * big * big // (123_456_789 * 987_654_321)
