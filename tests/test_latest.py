import pytest
from plain_rows import d, rows
from pyspark.sql import functions as F

from casebook.operators import latest

LINK = ["pid"]


def test_keep_latest_keeps_ties_and_drops_null_dates(spark):
    data = [("a", d("2020-01-01"), 1), ("a", d("2020-01-02"), 2), ("a", d("2020-01-02"), 3),
            ("b", None, 4), (None, d("2020-01-01"), 5)]
    df = spark.createDataFrame(data, "pid string, day date, n int")
    assert [r[0] for r in rows(latest.keep_latest(df, LINK, "day"), "n")] == [2, 3, 5]
    assert "new" in latest.keep_latest(df, LINK, "day", "new").columns


def test_latest_non_null(spark):
    data = [("a", d("2020-01-01"), "x"), ("a", d("2020-01-02"), None), ("b", None, "y"),
            ("c", d("2020-01-01"), "p"), ("c", d("2020-01-01"), "q")]
    df = spark.createDataFrame(data, "pid string, day date, v string")
    found = rows(latest.latest_non_null(df, LINK, "day", "v"), "pid", "v")
    assert found == [("a", "x"), ("b", "y"), ("c", "p"), ("c", "q")]


def test_latest_prefer_non_null(spark):
    data = [("a", d("2020-01-01"), "x"), ("a", d("2020-01-02"), None),
            ("b", d("2020-01-01"), None), ("b", d("2020-01-02"), None)]
    df = spark.createDataFrame(data, "pid string, day date, v string")
    found = rows(latest.latest_prefer_non_null(df, LINK, "day", "v"), "pid", "day", "v")
    assert found == [("a", d("2020-01-01"), "x"), ("b", d("2020-01-02"), None)]


PRIORITY = ["journal", "admitted", "emergency", "outpatient"]


@pytest.mark.parametrize(
    "data, want, legacy_want",
    [
        ([("journal", "2020-01-01", "A"), ("admitted", "2020-01-01", "B")], "A", "A"),
        ([("outpatient", "2020-01-01", "A"), ("emergency", "2020-01-01", "B")], "B", "B"),
        ([("journal", "2020-01-01", "A"), ("outpatient", "2020-01-02", "B")], "B", "B"),
        ([("journal", "2020-01-01", "A"), ("journal", "2020-01-01", "B")], None, None),
        ([("journal", "2020-01-01", "A"), ("journal", "2020-01-01", "A")], "A", None),
        ([("other", "2020-01-01", "A"), ("outpatient", "2020-01-01", "B")], "B", "A"),
    ],
)
def test_priority_source(spark, data, want, legacy_want):
    df = spark.createDataFrame(
        [("p", s, d(day), v) for s, day, v in data], "pid string, source string, day date, v string"
    )
    for legacy, expected in ((False, want), (True, legacy_want)):
        found = latest.priority_source(df, LINK, "day", "source", "v", PRIORITY, legacy)
        assert [r.v for r in found.collect()] == ([expected] if expected else [])


def test_conflicts(spark):
    data = [("a", "x"), ("a", "x"), ("b", "x"), ("b", "y"), ("c", None), ("d", "x"), ("d", None)]
    df = spark.createDataFrame(data, "pid string, v string")
    assert rows(latest.drop_conflicts(df, LINK, "v")) == [("a", "x"), ("d", "x"), ("d", None)]
    assert rows(latest.null_conflicts(df, LINK, "v")) == [
        ("a", "x"), ("b", None), ("c", None), ("d", "x"), ("d", None)]


def ladder_frame(spark):
    def entry(day):
        return {"day": d(day)}

    data = [
        ("A", "2020-01-01", "E1", [entry("2019-01-01")]),
        ("B", "2020-01-01", "E1", [entry("2019-01-01")]),
        ("B", "2020-01-01", "E2", [entry("2019-01-02")]),
        ("C", "2020-01-01", "E1", [entry("2019-01-01")]),
        ("C", "2020-01-02", "E2", [entry("2019-01-01")]),
        ("D", "2020-01-01", None, [entry("2019-01-01")]),
        ("D", "2020-01-01", "E002", [entry("2019-01-01")]),
        ("E", "2020-01-01", "E1", [entry("2019-01-01")]),
        ("E", "2020-01-01", "E2", [entry("2019-01-01"), entry("2018-01-01")]),
        ("F", "2020-01-01", "E1", [entry("2019-01-01")]),
        ("F", "2020-01-01", "E1", [entry("2019-01-01")]),
        ("G", "2020-01-01", "E1", []),
        ("H", "2020-01-01", "E1", [entry("2019-01-01")]),
        ("H", "2020-01-02", "E2", []),
    ]
    return spark.createDataFrame(
        [(p, d(x), area, j) for p, x, area, j in data],
        "pid string, extract date, area string, journal array<struct<day: date>>",
    )


def test_dedup_ladder(spark):
    df = ladder_frame(spark)
    kept = latest.dedup_ladder(df, LINK, "extract", "journal", "day", ["area"])
    found = rows(kept, "pid", "area", "extract")
    # G and H end with a newest extract without a journal, which removes them.
    assert [(p, a) for p, a, _ in found] == [
        ("A", "E1"), ("B", "E2"), ("C", "E2"), ("D", "E002"), ("E", "E2"), ("F", "E1")]


def test_dedup_ladder_drops_people_whose_best_rows_have_nulls(spark):
    df = ladder_frame(spark).where("pid = 'D' and area is null")
    kept = latest.dedup_ladder(df, LINK, "extract", "journal", "day", [], no_nulls_in=["area"])
    assert kept.count() == 0
    both = ladder_frame(spark).where("pid = 'D'")
    kept = latest.dedup_ladder(both, LINK, "extract", "journal", "day", [], no_nulls_in=["area"])
    assert [r.area for r in kept.collect()] == ["E002"]


def test_dedup_deaths(spark):
    data = [("4444", "2020-10-05", "2020-12-30", 1), ("4444", "2020-10-05", "2020-12-31", 2),
            ("4444", "2020-10-06", "2020-12-31", 3), ("5", "2020-01-01", "2020-01-02", 9),
            ("5", "2020-01-01", "2020-01-02", 8)]
    df = spark.createDataFrame(
        [(p, d(a), d(b), i) for p, a, b, i in data], "pid string, died date, reg date, id int"
    )
    assert rows(latest.dedup_deaths(df, LINK, "died", "reg", "id"), "pid", "id") == [
        ("4444", 2), ("5", 8)]


def test_array_key_with_nulls(spark):
    data = [("a", ["1", None], d("2020-01-01")), ("a", ["1", None], d("2020-01-02")),
            ("a", [None, "1"], d("2020-01-01"))]
    df = spark.createDataFrame(data, "pid string, v array<string>, extract date")
    assert latest.dedup_latest_entry(df, ["pid", "v"], "extract").count() == 2


def test_latest_with_start(spark):
    data = [("a", "ex", d("2020-01-01"), 1), ("a", "ex", d("2020-03-01"), 2), ("a", "never", d("2019-01-01"), 3)]
    df = spark.createDataFrame(data, "pid string, flag string, day date, n int")
    found = rows(latest.latest_with_start(df, ["pid", "flag"], "day", "start"), "flag", "n", "start")
    assert found == [("ex", 2, d("2020-01-01")), ("never", 3, d("2019-01-01"))]


def test_results_do_not_depend_on_partitions(spark):
    data = [(i % 7, i % 3, d(f"2020-01-{i % 5 + 1:02d}"), str(i % 11)) for i in range(400)]
    df = spark.createDataFrame(data, "pid int, k int, day date, v string")

    def everything():
        return [
            rows(latest.keep_latest(df, LINK, "day")),
            rows(latest.first_per_key(df, ["pid", "k"], [F.col("day").desc(), F.col("v")])),
            rows(latest.priority_source(df, LINK, "day", "v", "k", ["1", "2"])),
            rows(latest.null_conflicts(df, ["pid", "day"], "v")),
        ]

    spark.conf.set("spark.sql.shuffle.partitions", "1")
    one = everything()
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    many = everything()
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert one == many


def test_unknown_sources_that_agree_share_their_value(spark):
    data = [("a", "2020-01-01", "x", "A"), ("a", "2020-01-01", "y", "A"), ("b", "2020-01-01", "x", "A"),
            ("b", "2020-01-01", "y", "B")]
    df = spark.createDataFrame(data, "pid string, day string, source string, v string")
    found = latest.priority_source(df, LINK, "day", "source", "v", ["journal"])
    assert rows(found, "pid", "source", "v") == [("a", "y", "A")]


def test_ladder_does_not_depend_on_the_order_of_rows(spark):
    schema = "pid string, extract date, journal array<struct<day: date, code: string>>, area string"
    one = ("a", d("2020-03-31"), [(d("2020-01-01"), "x")], "E1")
    two = ("a", d("2020-03-31"), [(d("2020-01-01"), "y")], "E1")
    winners = {
        str(latest.dedup_ladder(spark.createDataFrame(data, schema).coalesce(1), LINK, "extract", "journal", "day", ["area"]).collect())
        for data in ([one, two], [two, one])
    }
    assert len(winners) == 1


@pytest.mark.parametrize("pick", [latest.dedup_latest_entry, latest.first_or_last, lambda *a: latest.latest_with_start(*a, "first")])
def test_equal_dates_are_decided_without_ties(spark, pick):
    schema = "pid string, day date, v string, codes array<string>"
    one, two = ("a", d("2020-01-01"), "x", ["p"]), ("a", d("2020-01-01"), "x", ["q"])
    winners = {str(pick(spark.createDataFrame(data, schema).coalesce(1), LINK, "day").collect()) for data in ([one, two], [two, one])}
    assert len(winners) == 1
