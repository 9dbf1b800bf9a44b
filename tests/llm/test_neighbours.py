import math
import random

import duckdb
import numpy as np

from casebook.llm import neighbours
from casebook.llm.queries import op11


def plain(vectors, queries, k):
    """Brute force: (query, rank) to (vec_id, score)."""
    out = {}
    for q in queries:
        far = sorted((math.dist(vectors[q], v), i) for i, v in vectors.items() if i != q)
        out |= {(q, n + 1): (i, d) for n, (d, i) in enumerate(far[:k])}
    return out


def got(df):
    rows = df.collect()
    out = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in rows}
    assert len(out) == len(rows)
    return out


def recall(found, want):
    return len({(q, i) for (q, _), (i, _) in found.items()} & {(q, i) for (q, _), (i, _) in want.items()}) / len(want)


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)


def test_query(spark, sf):
    rows = duckdb.sql(f"select vec_id, embedding from '{sf}/embeddings.parquet'").fetchall()
    vectors = {i: v for i, v in rows if usable(v)}
    queries = [i for i in vectors if i % 100 == 0]
    found, want = got(op11(spark, sf)), plain(vectors, queries, 10)
    assert found.keys() == want.keys() and recall(found, want) >= 0.9
    for (q, n), (i, d) in found.items():
        assert abs(d - math.dist(vectors[q], vectors[i])) < 1e-12
        assert n == 1 or found[q, n - 1] <= (d, i) or found[q, n - 1][1] < d or found[q, n - 1][0] < i


def test_many_lists_of_two_levels(spark, monkeypatch):
    """Lists beyond the first level, several blocks of a list, and a vector that a third of the rows share."""
    monkeypatch.setattr(neighbours, "CENTROIDS", 8)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 24))
    x = centres[rng.integers(30, size=2000)] + 0.3 * rng.normal(size=(2000, 24))
    x[::3] = x[0]
    vectors = {i: v.tolist() for i, v in enumerate(x)}
    df = spark.createDataFrame(list(vectors.items()), "id long, vec array<double>").repartition(5)
    for size, block, sample in ((40, 16, 1000), (100, 2048, 300)):
        found = got(neighbours.nearest(df, df.id % 50 == 0, k=7, size=size, block=block, sample=sample))
        want = plain(vectors, [i for i in vectors if i % 50 == 0], 7)
        assert found.keys() == want.keys() and recall(found, want) >= 0.9


def test_test_abandons_early_and_rightly():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, 64))
    index = neighbours.Index(1.0, np.linalg.qr(rng.normal(size=(64, 64)))[0], x[:1], x[:1] * 0, np.ones(1, np.int64), x, np.zeros(1))
    scan = neighbours.Scan(index, x, np.arange(500), 10)
    q = x[0] + 0.05 * rng.normal(size=64)
    near = np.sort(np.linalg.norm(x - q, axis=1))
    own = scan.survivors(index.rotated(q[None])[0], near[9])
    assert sorted(np.linalg.norm(scan.x[own] - q, axis=1)) == near[:10].tolist()
    assert len(scan.survivors(index.rotated(q[None])[0], np.inf)) == 500


def test_rows(spark):
    one = [1.0, 0.0]
    rows = [
        (0, one), (1, one), (2, one), (2, one), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]), (7, [None, 1.0]),
        (8, [float("inf"), 1.0]), (9, []), (None, one), (10, [1.0, 2.0, 3.0]), (11, [2.0, 0.0]), (12, [-0.0, 1.0]), (13, [1e308, 1e308]),
    ]
    for kind in ("double", "float"):
        df = spark.createDataFrame(rows if kind == "double" else rows[:-1], f"id long, vec array<{kind}>").selectExpr("*", "'x' as vec_id", "1 as list", "2 as score", "3 as asked")
        found = got(neighbours.nearest(df, df.id >= 0, k=3))
        vectors = {i: v for i, v in rows if i in (0, 1, 2, 3, 11, 12) or (i == 13 and kind == "double")}
        want = plain(vectors, vectors, 3)
        assert found.keys() == want.keys()
        for key, (i, d) in found.items():
            assert i == want[key][0] and math.isclose(d, want[key][1], rel_tol=1e-12)
    few = got(neighbours.nearest(df, df.id == 3, k=50))
    assert [few[3, n + 1][0] for n in range(len(few))] == [12, 0, 1, 2, 11]
    assert got(neighbours.nearest(df.limit(0), df.id == 3)) == {} and got(neighbours.nearest(df, df.id == 77)) == {}
    assert got(neighbours.nearest(df.filter("id = 3"), df.id == 3)) == {}


def test_results_do_not_depend_on_partitions(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, vec array<float>")
    assert got(neighbours.nearest(df.repartition(1), df.id < 20)) == got(neighbours.nearest(df.repartition(7), df.id < 20))
