import os
import re

import pytest
from plain_rows import rows
from pyspark.sql import functions as F

from casebook.sources.published import Conflict, Published


@pytest.fixture
def months(spark, tmp_path):
    """A table by month, some files a month."""
    df = spark.range(0, 120).select(
        F.col("id"), (F.col("id") % 12).cast("int").alias("month"), F.concat(F.lit("v"), "id").alias("v")
    ).repartition(2)
    table = Published(spark, str(tmp_path / "t"))
    table.overwrite(df, ["month"])
    return table


def files(table, version=None):
    return {n for names in table.describe(version)["files"].values() for n in names}


def test_versions_are_whole_and_stay(spark, tmp_path):
    table = Published(spark, str(tmp_path / "t"))
    assert not table.exists() and table.versions() == []
    with pytest.raises(ValueError):
        table.read()
    first = table.overwrite(spark.range(3).toDF("k"), note={"by": "me"})
    second = table.overwrite(table.read().where("k > 0"))  # reads what it replaces
    assert rows(first) == [(0,), (1,), (2,)] and rows(second) == [(1,), (2,)]
    assert table.versions() == [1, 2] and rows(table.read(1)) == rows(first)
    assert table.describe(1)["note"] == {"by": "me"}
    assert table.overwrite(spark.range(0).toDF("k")).count() == 0 and table.read().columns == ["k"]
    none = spark.createDataFrame([], "k long, p int")
    assert table.overwrite(none, ["p"]).count() == 0 and table.read().columns == ["k", "p"]


def test_a_write_that_dies_changes_nothing(spark, months):
    before = rows(months.read())
    broken = months.read().withColumn("v", F.when(F.col("id") == 77, F.raise_error(F.lit("dies"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="dies"):
        months.overwrite(broken, ["month"]).count()
    assert months.versions() == [1] and rows(months.read()) == before
    # What it left behind is not read, and the next write is not disturbed by it.
    assert len([n for n in os.listdir(months.path.removeprefix("file:")) if n.startswith("_part")]) == 2
    assert months.overwrite(months.read().where("month = 3"), ["month"]).count() == 10


def test_two_writers(spark, months, monkeypatch):
    other = Published(spark, months.path)
    real = Published._write

    def overtaken(self, df, by):
        out = real(self, df, by)
        monkeypatch.setattr(Published, "_write", real)
        other.overwrite(other.read().where("month < 2"), ["month"])
        return out

    monkeypatch.setattr(Published, "_write", overtaken)
    with pytest.raises(Conflict):
        months.overwrite(months.read().where("month > 5"), ["month"])
    assert months.versions() == [1, 2] and months.read().count() == 20


def test_merge_writes_only_files_with_matching_keys(spark, months):
    before = files(months)
    source = months.read().where("month = 3").select("id", "month", F.lit("new").alias("v"))
    source = source.unionByName(spark.createDataFrame([(500, 3, "added")], "id long, month int, v string"))
    merged = months.merge(source, ["id", "month"])
    after = files(months)
    assert {n.split("/")[1] for n in before - after} == {"month=3"} == {n.split("/")[1] for n in after - before}
    got = {r.id: (r.month, r.v) for r in merged.collect()}
    assert len(got) == 121 and got[500] == (3, "added")
    assert all(got[i] == (i % 12, "new" if i % 12 == 3 else f"v{i}") for i in range(120))


def test_merge_reads_only_partitions_with_source_keys(spark, months):
    source = months.read().where("month = 3")
    found = months.describe()
    (root, names), = found["files"].items()
    rows_of = months._rows(found, {root: names}).where(F.col("month").isin([3]))
    plan = rows_of._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*month", plan)
    assert {n.split("/")[1] for n in months.holding(source, ["id", "month"])[root]} == {"month=3"}
    # Without the partition column among the keys the files are still only those that hold a key.
    assert {n.split("/")[1] for n in months.holding(source.where("id = 15"), ["id"])[root]} == {"month=3"}


def test_merge_moves_rows_between_partitions(spark, months):
    months.merge(spark.createDataFrame([(i, 99) for i in range(5, 120, 12)], "id long, month int"), ["id"])
    got = months.read()
    assert got.where("month = 5").count() == 0 and got.where("month = 99").count() == 10
    assert {r.v for r in got.where("month = 99").collect()} == {f"v{i}" for i in range(5, 120, 12)}
    assert months.read(1).where("month = 5").count() == 10


def test_merge_rows(spark, tmp_path):
    table = Published(spark, str(tmp_path / "t"))
    table.overwrite(spark.createDataFrame([(1, "a", 1), (1, "b", 2), (None, "n", 3), (2, None, 4)], "k int, v string, w int"))
    merged = table.merge(spark.createDataFrame([(1, "A"), (None, "m"), (3, None)], "k int, v string"), ["k"])
    assert rows(merged) == rows(spark.createDataFrame(
        [(1, "A", 1), (1, "A", 2), (None, "n", 3), (2, None, 4), (None, "m", None), (3, None, None)], "k int, v string, w int"
    ))
    empty = table.merge(spark.createDataFrame([], "k int, v string"), ["k"])
    assert rows(empty) == rows(merged)
    for source, keys in (("k int, x int", ["k"]), ("v string", ["k"]), ("k int", [])):
        with pytest.raises(ValueError):
            table.merge(spark.createDataFrame([], source), keys)
    with pytest.raises(ValueError):
        table.merge(spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string"), ["k"])


def test_merge_into_an_empty_table(spark, tmp_path):
    table = Published(spark, str(tmp_path / "t"))
    table.overwrite(spark.createDataFrame([], "k int, v string"))
    assert rows(table.merge(spark.createDataFrame([(1, "a")], "k int, v string"), ["k"])) == [(1, "a")]


def test_hot_key_of_the_target(spark, tmp_path):
    """One key in a third of all rows: every one of its rows is updated, once."""
    table = Published(spark, str(tmp_path / "t"))
    table.overwrite(spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("n")).repartition(6))
    merged = table.merge(spark.createDataFrame([(0, -1), (-5, -2)], "k long, n long"), ["k"])
    assert merged.count() == 3001 and merged.where("n = -1").count() == 1000


def test_compact_joins_small_files_only(spark, tmp_path):
    table = Published(spark, str(tmp_path / "t"))
    big = spark.range(200_000).select("id", F.lit(1).alias("p"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    table.overwrite(big.coalesce(1), ["p"])
    large = files(table)
    for k in range(3):
        table.merge(spark.createDataFrame([(-10 * k - j, 1 + j, "x") for j in range(1, 4)], "id long, p int, v string"), ["id"])
    before = table.read()
    assert large < files(table)
    after = table.compact(small=1 << 20)
    assert large < files(table) and len(files(table)) == 1 + 3
    assert after.groupBy("p").count().orderBy("p").collect() == before.groupBy("p").count().orderBy("p").collect()
    version = table.versions()[-1]
    table.compact(small=1 << 20)  # nothing left to do: single files stay
    assert table.versions()[-1] == version


def test_copies(spark, months, tmp_path):
    deep, shallow = months.clone(str(tmp_path / "deep")), months.clone(str(tmp_path / "shallow"), deep=False)
    want = rows(months.read())
    assert rows(deep.read()) == rows(shallow.read()) == want
    assert list(deep.describe()["files"]) == [deep.path] and list(shallow.describe()["files"]) == [months.path]
    months.merge(spark.createDataFrame([(1, 1, "changed")], "id long, month int, v string"), ["id"])
    shallow.merge(spark.createDataFrame([(2, 2, "own")], "id long, month int, v string"), ["id"])
    assert rows(deep.read()) == want
    assert len(shallow.describe()["files"]) == 2 and rows(shallow.read().where("v = 'own'"), "id") == [(2,)]
    assert shallow.read().count() == 120 and shallow.read().where("v = 'changed'").count() == 0
    again = months.clone(str(tmp_path / "deep"))
    assert rows(again.read()) == want and again.versions() == [1]
    old = months.clone(str(tmp_path / "old"), version=1)
    assert rows(old.read()) == want and old.describe()["note"] == {"copy_of": months.path, "version": 1}


def test_names_with_odd_letters(spark, tmp_path):
    table = Published(spark, str(tmp_path / "a b%20c"))
    df = spark.createDataFrame([(1, "x/y"), (2, "ü %"), (3, None)], "k int, p string")
    assert rows(table.overwrite(df, ["p"])) == rows(df)
    assert rows(table.merge(spark.createDataFrame([(2, "é=1")], "k int, p string"), ["k"]).where("k = 2")) == [(2, "é=1")]
