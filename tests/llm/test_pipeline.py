import random

import duckdb
import pytest

import corpus_pipeline
from casebook.llm import lines
from test_lines import without_earlier_runs as without_lines
from test_minhash import brute as groups



@pytest.fixture(scope="module")
def stages(spark, sf):
    """What goes into each stage and what comes out, by name."""
    out, docs = {}, spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.stored(stage(spark, docs, sf), name)
        if name != "packing":
            assert after.columns == columns
        out[name] = (docs, after)
        docs = after
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "quality_rules", "line_dedup", "near_dedup", "packing"]


def test_clean_documents_pass_the_filters(stages, sf):
    quality = dict(duckdb.sql(f"select doc_id, quality from '{sf}/labels.parquet'").fetchall())
    before, after = (texts(x) for x in stages["quality_classifier"])
    assert after.items() <= before.items()
    assert all(k in after for k, q in quality.items() if q)
    assert sum(k in after for k, q in quality.items() if not q) < 0.1 * sum(not q for q in quality.values())
    judged, kept = (texts(x) for x in stages["quality_rules"])
    assert kept.items() <= judged.items()
    long = [k for k, q in quality.items() if q and k in judged and len(judged[k].split()) >= 50]
    assert sum(k not in kept for k in long) <= 0.03 * len(long)


def test_line_dedup(stages):
    before, after = (texts(x) for x in stages["line_dedup"])
    want = without_lines(before, lines.BLOCK_WORDS)
    assert after == {k: t for k, t in want.items() if t.split() or t == before[k]}


def test_one_document_of_each_group_stays(stages):
    before, after = (texts(x) for x in stages["near_dedup"])
    assert set(after) == {k for k, (_, _, kept) in groups(before.items()).items() if kept}
    assert after.items() <= before.items()


def test_packing_and_run(spark, sf, stages):
    before, after = stages["packing"]
    pieces = after.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert {r.doc_id for r in pieces} == set(texts(before))
    assert all(r[1] == r[2] for r in pieces)
    got = corpus_pipeline.run(spark, sf)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, after.collect()))


def test_odd_rows(spark, sf):
    """Every stage on nulls, empty, long and repeated rows, and columns with inner names."""
    rng = random.Random(3)
    plain = " ".join(f"word{rng.randrange(900)}" for _ in range(80)) + "."
    rows = [(1, plain, "en"), (2, plain, "en"), (3, None, "en"), (4, "", None), (5, " \n", "en"), (None, plain + " x", None)]
    rows += [(6, "Long text here and there. " * 40_000, "en"), (7, plain + "\n" + "other words " * 60, None), (7, plain + "\n" + "other words " * 60, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    names = ["kept", "votes", "score", "removed_lines", "keep", "key", "_gone", "_stratum", "n_words", "ids", "failed_rules", "_other_3"]
    docs = docs.selectExpr("*", *(f"'{n}' as `{n}`" for n in names))
    for name, stage in corpus_pipeline.STAGES:
        for given in (docs, docs.filter("false")):
            after = stage(spark, given, sf)
            if name != "packing":
                assert after.columns == docs.columns
                assert all(tuple(r)[3:] == tuple(names) for r in after.collect())
            else:
                after.collect()
            if given is not docs:
                assert after.count() == 0
