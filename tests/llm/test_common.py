import random

import numpy as np
import pytest

from casebook.llm import common


def brute(edges):
    above = {x: x for e in edges for x in e}

    def root(x):
        while above[x] != x:
            x = above[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        above[b] = a
    return {x: root(x) for x in above if any(x in e for e in edges if e[0] != e[1])}


@pytest.mark.parametrize("kind", ["path", "star", "random", "loops"])
def test_components(spark, kind):
    rng = random.Random(kind)
    names = rng.sample(range(10**6), 300)
    edges = {
        "path": list(zip(names, names[1:], strict=False)),
        "star": [(names[0], x) for x in names[1:]] + [(x, names[0]) for x in names[1:50]],
        "random": [tuple(rng.sample(names, 2)) for _ in range(200)],
        "loops": [(x, x) for x in names[:5]] + [(names[0], names[1])] * 3,
    }[kind]
    got = common.components(spark.createDataFrame(edges, "a long, b long"), kind)
    assert {r.id: r.component for r in got.collect()} == brute(edges)


def test_no_edges(spark):
    assert common.components(spark.createDataFrame([], "a long, b long"), "none").collect() == []


def test_words():
    texts = [b"", b" one  Two\tone\n", b"\xc3\xa9 x", b"\x0b\x0c", b"one two"]
    words = common.Words(texts, fold=False)
    assert np.diff(words.firsts).tolist() == [0, 3, 2, 0, 2]
    own = words.hashes[words.of(1)]
    assert own[0] == own[2] != own[1] and words.hashes[words.of(4)][1] != own[1]
    assert common.Words(texts, fold=True).hashes[words.of(4)][1] == common.Words(texts, fold=True).hashes[words.of(1)][1]


def test_long_texts_are_whole(monkeypatch):
    text = b"some words in a row " * 9000
    whole = list(common.shingle_sets([text, b"a b"], 5))
    monkeypatch.setattr(common, "CHUNK_BYTES", 64)
    assert [s.tolist() for s in common.shingle_sets([text, b"a b"], 5)] == [s.tolist() for s in whole]
    assert len(whole[0]) == 5 and len(whole[1]) == 1


def test_long_words_are_told_apart():
    """Words of two letters whose polynomials modulo 2**64 agree (Thue and Morse), folded or not."""
    word = b"a"
    for _ in range(12):
        word += word.translate(bytes.maketrans(b"ab", b"ba"))
    other = word.translate(bytes.maketrans(b"ab", b"ba"))
    for fold in (False, True):
        words = common.Words([word + b" " + other, word.upper()], fold)
        assert words.hashes[0] != words.hashes[1] and (words.hashes[0] == words.hashes[2]) == fold


def test_rounds_write_little(spark, monkeypatch):
    """Edges are not written before the first round, nor the places of every vertex in each round."""
    names, write = [], common.stored
    monkeypatch.setattr(common, "stored", lambda df, name, by=None: names.append(name) or write(df, name, by))
    rng = random.Random(4)
    order = rng.sample(range(400), 400)
    edges = list(zip(order, order[1:], strict=False)) + [(order[0], order[1]), (7, 7)]
    got = common.components(spark.createDataFrame(edges, "a long, b long"), "path")
    assert {tuple(r) for r in got.collect()} == {(k, 0) for k in range(400)}
    rounds = max(int(n.rsplit("-", 1)[1]) for n in names if "near" in n)
    assert rounds > 1
    assert sorted(names) == sorted([f"path-{what}-{k + 1}" for what in ("near", "moves", "edges") for k in range(rounds)] + ["path-places"])
