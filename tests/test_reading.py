"""Yearly tables in one scan, newest partitions by name, CSV lines that are no rows."""

import pytest
from plain_rows import rows
from pyspark.sql import functions as F

from casebook.operators import quality
from casebook.sources import readers


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stores(spark, tmp_path):
    """Years 19 to 23 in an old store and, with another name for the person, from 20 in a new one."""
    for y in range(19, 24):
        name = f"apc_{y}{y + 1}"
        spark.createDataFrame([(y, f"p{y}", 1)], "id int, person string, old int").write.parquet(str(tmp_path / "old" / name))
        if y >= 20:
            spark.createDataFrame([(-y, f"n{y}")], "id int, token string").write.parquet(str(tmp_path / "new" / name))
    (tmp_path / "old" / "other_1920").mkdir()
    return [readers.yearly_paths(spark, str(tmp_path / s), "apc") for s in ("old", "new")]


def test_yearly_scan_equals_the_union(spark, stores):
    old, new = stores
    assert sorted(old) == ["1920", "2021", "2122", "2223", "2324"] and sorted(new) == ["2021", "2122", "2223", "2324"]
    found = readers.scan_yearly(spark, old, new, 19, 23, renames={"token": "person"}, drop=["old"], year="fyear")
    assert rows(found) == [(-21, "n21", "2122"), (-22, "n22", "2223"), (19, "p19", "1920"), (20, "p20", "2021")]
    frames = [{k: spark.read.parquet(p) for k, p in s.items()} for s in stores]
    united = readers.union_yearly(*frames, 19, 23, columns=["id"])
    assert rows(united) == rows(readers.scan_yearly(spark, old, new, 19, 23, columns=["id"]))
    with pytest.raises(ValueError):
        readers.scan_yearly(spark, old, new, 30, 31)


def test_yearly_scan_is_one_scan_of_the_years_asked_for(spark, stores):
    plans = [plan(readers.scan_yearly(spark, *stores, 19, end, renames={"token": "person"})) for end in (20, 24)]
    assert [p.count("FileScan") for p in plans] == [1, 1] and "Union" not in plans[1]
    one = readers.scan_yearly(spark, *stores, 20, 21)
    assert len({f.split("/")[-2] for f in one.inputFiles()}) == 1
    filtered = plan(readers.scan_yearly(spark, *stores, 19, 24).where("id = 19"))
    assert "PushedFilters: [IsNotNull(id), EqualTo(id,19)]" in filtered


def test_yearly_types_must_agree(spark, stores, tmp_path):
    spark.createDataFrame([("x",)], "id string").write.parquet(str(tmp_path / "old" / "apc_1819"))
    old = readers.yearly_paths(spark, str(tmp_path / "old"), "apc")
    with pytest.raises(ValueError, match="id is"):
        readers.scan_yearly(spark, old, {}, 18, 21)


def test_rows_without_a_year_stay(spark):
    df = spark.createDataFrame([(1, 2020), (2, None), (3, 2021), (4, None)], "k int, y int")
    years = readers.by_year(df, "y")
    assert list(years) == [2020, 2021, None] and rows(years[None]) == [(2, None), (4, None)]
    assert sum(v.count() for v in years.values()) == 4


def test_newest_partition_reads_only_its_folder(spark, tmp_path):
    df = spark.sql("select id, date_add(date'2024-01-30', cast(id as int)) as day, cast(id + 8 as int) as n from range(4)")
    df = df.unionByName(spark.sql("select 9L as id, cast(null as date) as day, cast(null as int) as n"))
    for column, want in (("day", 3), ("n", 3)):
        path = str(tmp_path / column)
        df.write.partitionBy(column).parquet(path)
        found = readers.newest_partition(spark, path, column)
        assert rows(found, "id") == [(want,)]
        assert "PartitionFilters: [isnotnull(" in plan(found) and "number of files read: 1" in metrics_of(found)
    with pytest.raises(ValueError):
        readers.newest_partition(spark, str(tmp_path / "day" / "day=2024-01-30"), "id")


def metrics_of(df):
    """The scan's own count of files."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return f"number of files read: {leaf.metrics().apply('numFiles').value()}"


def test_csv_rejects(spark, tmp_path):
    text = 'a,b,c\n1,x,\n2,y\n3,"p,q",z\n4,a,b,c\n\n5,"open,b\n6,"x, ""y""",z\n,,\n'
    (tmp_path / "one.csv").write_text(text)
    (tmp_path / "two.csv").write_text("a,b,c\n7,u,v\n8\n")
    good, rejected = readers.read_csv_checked(spark, str(tmp_path), ["a", "b", "c"])
    assert {r.a for r in good.collect()} == {"1", "3", "6", "7", None}
    assert rows(good.where("a = 3")) == [("3", "p,q", "z")] and rows(good.where("a = 1")) == [("1", "x", None)]
    got = {r.line: (r.file.rsplit("/", 1)[1], r.reason) for r in rejected.collect()}
    assert got == {
        "2,y": ("one.csv", "fewer fields"), "4,a,b,c": ("one.csv", "more fields"),
        '5,"open,b': ("one.csv", "quotes do not match"), "8": ("two.csv", "fewer fields"),
    }


def test_sketches_merge(spark):
    df = spark.range(60_000).select((F.col("id") % 3).alias("part"), (F.col("id") % 20_000).alias("person"))
    kept = quality.people_sketches(df, ["part"], ["person"]).collect()
    sketches = spark.createDataFrame(kept, "part long, people binary")
    for found in (quality.people_of(sketches).first().people, *(r.people for r in quality.people_of(sketches, ["part"]).collect())):
        assert abs(found - 20_000) < 0.03 * 20_000
    assert quality.people_of(sketches.limit(0)).first().people in (0, None)
