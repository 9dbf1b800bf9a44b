import random
import re

import numpy as np
import pytest

from casebook.llm import minhash
from casebook.llm.queries import op3

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall((text or "").encode().lower())
    if not words:
        return frozenset()
    return frozenset([tuple(words)] if len(words) < 5 else zip(*(words[k:] for k in range(5)), strict=False))


def brute(rows):
    """(id, text) rows: id -> (size, component, kept), all pairs compared."""
    sets = {i: shingles(t) for i, t in rows}
    above = {i: i for i in sets}

    def root(x):
        while above[x] != x:
            x = above[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            x, y = sets[a], sets[b]
            if x and y:
                common = len(x & y)
                if 100 * common >= 75 * (len(x) + len(y) - common):
                    p, q = sorted((root(a), root(b)))
                    above[q] = p
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_query_agrees_with_all_pairs(spark, sf, documents):
    assert found(op3(spark, sf)) == brute(documents.items())


def near_copies(n, words, edits, seed):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(edits)):
            copy[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def test_large_groups_lose_no_link(spark, frame):
    """A group beyond one task, with members that only link to a few others."""
    texts = near_copies(500, 200, 22, 1) + near_copies(150, 120, 30, 2) + ["alone here with five words"]
    random.Random(3).shuffle(texts)
    rows = list(enumerate(texts, 10))
    assert found(minhash.near_duplicates(frame(rows))) == brute(rows)


@pytest.mark.parametrize("limits", [{"ASKING": 0, "SMALL": 12, "HUBS": 1, "BLOCK": 16}, {"HELD": 3000}])
def test_groups_taken_apart_lose_no_link(frame, monkeypatch, limits):
    """Groups compared by buckets, in many blocks, and in blocks bounded by their shingles."""
    for name, value in limits.items():
        monkeypatch.setattr(minhash, name, value)
    texts = near_copies(160, 150, 36, 4) + near_copies(60, 120, 12, 5) + near_copies(3, 4000, 300, 6)
    random.Random(7).shuffle(texts)
    rows = list(enumerate(texts, 10))
    assert found(minhash.near_duplicates(frame(rows))) == brute(rows)


def test_mostly_unlinked_crowd(frame, monkeypatch):
    """A template of which each document keeps about 60 %: buckets hold many, few pairs are linked."""
    taken = []
    apart = minhash._crowds
    monkeypatch.setattr(minhash, "_crowds", lambda *args: taken.append(1) or apart(*args))
    monkeypatch.setattr(minhash, "ASKING", 0)
    rng = random.Random(8)
    base = [f"w{k}" for k in range(300)]
    texts = []
    for k in range(150):
        own = [f"u{k}x{j}" for j in range(rng.randrange(60, 110))]
        texts.append(" ".join(base + own))
    rows = list(enumerate(texts, 10))
    assert found(minhash.near_duplicates(frame(rows))) == brute(rows)
    assert taken


def test_crowds_keep_their_labels(frame, monkeypatch):
    """Groups that are taken apart are not labelled a second time by the same edges."""
    named, label = [], minhash.components
    monkeypatch.setattr(minhash, "components", lambda edges, name: named.append(name) or label(edges, name))
    monkeypatch.setattr(minhash, "ASKING", 0)
    base = [f"w{k}" for k in range(300)]
    rows = [(k, " ".join(base + [f"u{k}x{j}" for j in range(60 + k % 50)])) for k in range(150)]
    assert found(minhash.near_duplicates(frame(rows))) == brute(rows)
    assert named == ["candidates", "first", "starred", "linked"]


def test_odd_rows(frame):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "ONE  two"), (6, "two one"), (None, "one two"), (4, "one two")]
    rows += [(7, "a\u00a0b c d e f"), (8, "a\u00a0b C d e f"), (9, "x " * 50_000)]
    out = [tuple(r) for r in minhash.near_duplicates(frame(rows)).collect()]
    own = {r[0]: r for r in out}
    assert len(out) == len(rows)
    assert [own[k][2] for k in (1, 2, 3, 4, 5, 6, 7, 8, 9)] == [1, 2, 3, 4, 4, 6, 7, 7, 9]
    assert own[None][2:] == (None, True) and own[1][1] == 0 and own[4][1] == 1 and own[9][1] == 1


def test_empty_table(frame):
    assert minhash.near_duplicates(frame([])).collect() == []


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(5)
    a, b = np.unique(rng.integers(0, 1 << 63, 3000, dtype=np.uint64)), np.unique(rng.integers(0, 1 << 63, 1000, dtype=np.uint64))
    union = np.union1d(a, b)
    assert (minhash.registers(union) == np.maximum(minhash.registers(a), minhash.registers(b))).all()
    same = (minhash.registers(a) == minhash.registers(union)).mean()
    assert abs(same - 0.75) < 0.08


@pytest.mark.parametrize(("share", "may"), [(0.8, True), (0.75, True), (0.3, False)])
def test_likelihood(share, may):
    rng = np.random.default_rng(6)
    pool = np.unique(rng.integers(0, 1 << 63, 4000, dtype=np.uint64))
    rng.shuffle(pool)
    n = int(2000 * 2 * share / (1 + share))
    a, b = np.sort(pool[:2000]), np.sort(np.concatenate((pool[:n], pool[2000 : 4000 - n])))
    got = minhash.may_match(minhash.registers(a), len(a), minhash.registers(b)[None, :], np.array([len(b)]), 75)
    assert got[0] == may
