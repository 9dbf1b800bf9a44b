import datetime as dt

import pytest
from plain_rows import rows
from pyspark.sql import functions as F

from casebook.session import shared_dir
from casebook.sources import readers, writers


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    source = spark.createDataFrame([(2, "B"), (3, "c"), (None, "m")], "k int, v string")
    assert rows(writers.upsert(target, source, ["k"])) == [(1, "a"), (2, "B"), (3, "c"), (None, "m"), (None, "n")]
    with pytest.raises(ValueError):
        writers.upsert(target, source.unionByName(source), ["k"])
    with pytest.raises(ValueError):
        writers.upsert(target, source, ["missing"])


def test_union_yearly(spark):
    def frame(year, name="id"):
        return spark.createDataFrame([(year, "x")], f"{name} int, fyear string")

    old = {"1920": frame(19), "2021": frame(20), "2122": frame(-21)}
    new = {"2122": frame(21, "new_id"), "2223": frame(22, "new_id")}
    found = readers.union_yearly(old, new, 20, 22, renames={"new_id": "id"}, drop=["fyear"])
    assert rows(found) == [(20,), (21,)]
    with pytest.raises(ValueError):
        readers.union_yearly(old, new, 30, 31)
    narrow = readers.union_yearly(old, {}, 19, 21, columns=["id"])
    assert rows(narrow) == [(19,), (20,)] or narrow.columns == ["id"]


def test_table_names():
    names = ["store_2020_03_31_v1", "store_2021_03_31_v2", "store_tmp_2022_01_01_v1", "other_2023_01_01_v1"]
    assert readers.latest_table(names, "store", ["tmp"]) == "store_2021_03_31_v2"
    assert readers.partner_table("store_2021_03_31_v2", "store", "journal") == "store_journal_2021_03_31_v2"
    with pytest.raises(ValueError):
        readers.latest_table(names, "nothing")
    with pytest.raises(ValueError):
        readers.partner_table("x", "store", "journal")
    years = ["apc_1920", "apc_2223", "apc_2324", "op_2425"]
    assert readers.latest_table_year(years, "apc", dt.date(2024, 5, 1)) == 24
    with pytest.raises(ValueError):
        readers.latest_table_year(years, "apc", dt.date(2026, 5, 1))


def test_csv_nulls(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,\n,x\n")
    assert rows(readers.read_csv_nulls(spark, str(tmp_path / "x.csv"), ["a", "b"])) == [("1", None), (None, "x")]


def test_write_once_archive_and_cache(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    path = str(tmp_path / "t")
    assert rows(writers.write_table(df, path)) == rows(df)
    with pytest.raises(Exception, match="(?i)exist"):
        writers.write_table(df, path)
    assert writers.write_table(df.limit(1), path, overwrite=True).count() == 1
    archive = writers.archive_path(str(tmp_path), "t", dt.date(2024, 3, 1), "1", "2")
    assert archive.endswith("t_2024_03_01_v1_cv2")
    assert writers.archive_snapshot(df, archive).count() == 2
    assert writers.archive_snapshot(df.limit(0), archive).count() == 2
    cached = writers.hard_cache(df, "cache")
    assert rows(cached) == rows(df) and cached.inputFiles()
    assert rows(writers.compact(df)) == rows(df)


def test_shared_dir_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    found = shared_dir(spark, "x")
    assert root is None or found.startswith(root)
    assert found != shared_dir(spark, "x")


def test_csv_ready(spark):
    df = spark.createDataFrame([(["a", "b"], 1), (None, 2)], "l array<string>, k int")
    assert rows(writers.export_csv_ready(df), "k", "l") == [(1, "a,b"), (2, "")]
    with pytest.raises(ValueError):
        writers.export_csv_ready(df.withColumn("s", F.struct("k")))


def test_audit(spark):
    df = spark.range(3)
    found = writers.add_audit(df, "1", "2", dt.date(2024, 1, 1), "db", 4, {"a": 1}, ["x"])
    meta = found.first().META
    assert (meta.version, meta.date, meta.stage_index, meta.params) == ("1", dt.date(2024, 1, 1), 4, '{"a": 1}')
    assert 0 <= meta.sampling < 1
    with pytest.raises(ValueError):
        writers.add_audit(found, "1", "2", dt.date(2024, 1, 1), "db", 4, {}, [])


def test_sample_cohort(spark):
    df = spark.createDataFrame([(i % 10, i) for i in range(100)], "p int, i int")
    fixed = readers.sample_cohort(df, ["p"], 3)
    assert fixed.count() == 30 and rows(fixed) == rows(readers.sample_cohort(df, ["p"], 3))
    drawn = readers.sample_cohort(df, ["p"], 3, seed=7)
    assert drawn.select("p").distinct().count() <= 3 and drawn.count() % 10 == 0
    assert readers.sample_cohort(df, ["p"], 99).count() == 100


def test_latest_snapshot(spark):
    df = spark.createDataFrame([("t_2024_01_01_x", 1), ("t_2024_02_01_x", 2)], "name string, v int")
    df = df.withColumn("day", readers.snapshot_date(F.col("name")))
    assert [r.v for r in readers.latest_snapshot(df, "day").collect()] == [2]


def test_catalog_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS yearly")
    names = readers.table_names(spark, "yearly")
    assert names == []
    df = spark.range(2)
    for suffix in ("1920", "2021"):
        df.createOrReplaceTempView(f"apc_{suffix}")
    assert "apc_1920" in readers.table_names(spark, "yearly")  # temporary views are listed too
    assert readers.read_source(spark, "apc_1920", ["id"]).count() == 2
