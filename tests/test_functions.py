import pytest
from plain_rows import d, rows
from pyspark.sql import functions as F

from casebook.functions import codes, dates, readings, values


def column(spark, schema, data, **exprs):
    df = spark.createDataFrame(data, schema)
    return [tuple(r) for r in df.select(*(e.alias(n) for n, e in exprs.items())).collect()]


def test_valid_id(spark):
    ids = ["9434765919", "943476591", "94347659190", "9434765918", "0000000000", "9990000018", None]
    found = column(spark, "id string", [(i,) for i in ids], ok=values.valid_id(F.col("id")))
    assert [f[0] for f in found] == [True, False, False, False, False, False, False]


def test_check_digit_against_plain_rule(spark):
    def rule(text):
        total = sum(int(c) * w for c, w in zip(text, range(10, 1, -1)))
        want = 11 - total % 11
        return int(text[9]) == (0 if want == 11 else want)

    ids = [f"{n * 7919 % 10**10:010d}" for n in range(2000)]
    found = column(spark, "id string", [(i,) for i in ids], ok=values.check_digit_ok(F.col("id")))
    assert [f[0] for f in found] == [rule(i) for i in ids]


def test_hash_key(spark):
    found = column(spark, "a int, b string, c string", [(1, None, "A")],
                   key=values.hash_key("a", "c"), skipped=values.hash_key("a", "b", "c"),
                   kept=values.hash_key("a", "b", "c", null_token="?"))[0]
    assert found[0] == "b6d4913b6c53f6699e89d883423f6e86ff80042dc21b64127205e6b8f4dd1e5b"
    assert found[1] == found[0] != found[2]


def test_hash_key_splices_arrays(spark):
    data = [(["120", None],), ([None, "120"],)]
    found = column(spark, "v array<string>", data, key=values.hash_key("v"))
    assert found[0] == found[1]


def test_blanks(spark):
    data = [("",), ("null",), ("NULL",), ("Null",), ("x",), (None,)]
    found = column(spark, "v string", data, null=values.null_if_blank(F.col("v")),
                   text=values.has_text(F.col("v")))
    assert [f[0] for f in found] == [None, None, None, None, "x", None]
    assert [f[1] for f in found] == [False, False, False, False, True, False]


def test_parse_date(spark):
    data = [("20200229",), ("2020-02-29",), ("2020-02-29 10:11:12",), ("20200230",), ("x",), (None,)]
    found = column(spark, "v string", data, day=dates.parse_date(F.col("v")))
    assert [f[0] for f in found] == [d("2020-02-29")] * 3 + [None] * 3


def test_ages(spark):
    data = [(d("2000-01-01"), d("2000-12-31")), (d("2000-01-01"), d("2001-01-01")),
            (d("2001-01-01"), d("2002-01-01")), (d("2000-01-02"), d("2000-01-01")),
            (None, d("2000-01-01")), (d("1800-01-01"), d("2000-01-01"))]
    found = column(spark, "b date, a date", data, years=dates.age_years(F.col("b"), F.col("a")),
                   age=dates.age_at(F.col("b"), F.col("a")))
    assert [f[0] for f in found] == [0, 1, 0, None, None, 199]
    assert [f[1] for f in found] == [0, 1, 0, None, None, None]


def test_valid_age(spark):
    found = column(spark, "a string", [("5",), ("-1",), ("x",), (None,)],
                   age=dates.valid_age(F.col("a")))
    assert [f[0] for f in found] == [5, None, None, None]


def test_month_windows(spark):
    data = [("2019-01-01", "2020-01-01"), ("2018-12-31", "2020-01-01"), ("2020-01-02", "2020-01-01"),
            ("2019-02-28", "2020-02-29"), ("2020-01-01", "2020-01-01")]
    data = [(d(a), d(b)) for a, b in data]
    found = column(spark, "e date, x date", data,
                   inside=dates.within_months_before(F.col("e"), F.col("x")),
                   later=dates.later_than_months(F.col("e"), F.col("x")))
    assert [f[0] for f in found] == [True, False, False, True, True]
    assert [f[1] for f in found] == [False, False, True, False, True]


def test_year_bound(spark):
    found = column(spark, "e date", [(d("2018-12-31"),), (d("2019-01-01"),)],
                   two=dates.on_or_after_year(F.col("e"), 19),
                   four=dates.on_or_after_year(F.col("e"), 2019))
    assert found == [(False, False), (True, True)]


def test_code_map_later_key_wins(spark):
    found = column(spark, "c string", [("x",), ("y",), (None,)],
                   flag=codes.code_map(F.col("c"), {"a": ["x", "y"], "b": ["y"]}))
    assert [f[0] for f in found] == ["a", "b", None]


def test_code_level():
    assert [codes.code_level(c) for c in ("DIAG_4_01", "DIAG2_01", "DIAG_3_01")] == [4, 2, 3]
    with pytest.raises(ValueError):
        codes.code_level("DIAG_01")


def test_primary_or_any(spark):
    data = [("I61", []), ("I22", None), ("FOO", []), (None, []), (None, ["I61"]), ("J10", ["I219"])]
    found = column(spark, "c string, l array<string>", data,
                   flag=codes.flag_by_primary_or_any(F.col("c"), F.col("l")),
                   legacy=codes.flag_by_primary_or_any(F.col("c"), F.col("l"), legacy=True))
    assert [f[0] for f in found] == [
        "STROKE", "HEARTATTACK", "NO_CVD", "NO_CVD", "CVD_NON_PRIMARY", "CVD_NON_PRIMARY"]
    assert found[-1][1] == "NO_CVD"


def test_flag_by_prefix(spark):
    flags = {"A": ["I1", "I2"], "B": ["I21"]}
    found = column(spark, "c string", [("I219",), ("I10",), ("X",), (None,)],
                   flag=codes.flag_by_prefix(F.col("c"), flags))
    assert [f[0] for f in found] == ["B", "A", "NON_CVD", "NON_CVD"]


def test_assoc_flag(spark):
    data = [("STROKE", "I61"), ("NON_CVD", "I61,J10"), (None, "I63"), ("NON_CVD", "J10"), ("X", None)]
    found = column(spark, "f string, t string", data,
                   flag=codes.assoc_flag(F.col("f"), F.col("t"), "STROKE", ["I61", "I63"]))
    assert [f[0] for f in found] == [0, 1, 1, 0, 0]


def test_any_code_matches(spark):
    data = [(["I21"],), (["I219"],), (["I2199"],), (["I22", None],), ([],), (["XI21"],)]
    found = column(spark, "l array<string>", data, ok=codes.any_code_matches(F.col("l"), ["I21"]))
    assert [f[0] for f in found] == [True, True, False, False, False, False]


def test_single_and_pair(spark):
    data = [("271649006", None, ["001", None]), ("271650006", None, ["002", None]),
            ("271649006", None, [None, None]), ("271649006", None, ["001", "002"]),
            ("271649006", None, [None, "001"]), ("X", None, ["001", None]), (None, None, ["1", None]),
            ("X", "BP_COD", ["001", "002"]), ("X", "BP_COD", ["80", "80"]), ("X", "BP_COD", ["1", None])]
    single = readings.is_single(F.col("c"), F.col("v"))
    found = column(spark, "c string, k string, v array<string>", data,
                   single=F.coalesce(single, F.lit(False)),
                   pair=F.coalesce(readings.is_pair(F.col("k"), F.col("v")), F.lit(False)),
                   legacy=F.coalesce(readings.is_pair(F.col("k"), F.col("v"), legacy=True), F.lit(False)))
    assert [f[0] for f in found] == [True, True] + [False] * 8
    assert [f[1] for f in found] == [False] * 7 + [True, True, False]
    assert [f[2] for f in found] == [False] * 7 + [True, False, False]


def test_plausible(spark):
    data = [(20, 100, 80), (20, None, 80), (20, 100, None), (20, 75, 80), (20, 100, 45), (20, 75, 45),
            (20, None, None), (2, 100, 80), (60, 100, 80), (None, 100, 80)]
    df = spark.createDataFrame(data, "a int, s int, d int")
    ok = readings.is_plausible(F.col("a"), F.col("s"), F.col("d"), 5, 50, 80, 60)
    assert rows(df.where(ok)) == [(20, 100, 80), (20, 100, None), (20, None, 80)]


BANDS = [(80, 149, 80, "0.2"), (80, 151, 89, "1b"), (79, 149, 80, "1a"), (79, 139, 80, "0.1"),
         (79, 139, 95, "1a"), (80, 181, 120, "1d"), (80, 161, 121, "1d"), (80, 161, 120, "1c"),
         (79, 141, 121, "1d"), (79, 141, 120, "1c"), (79, 141, 101, "1c"), (79, 141, 100, "1a"),
         (79, 141, 90, "1a"), (79, 49, 20, None), (79, 0, 90, None), (79, 100, None, None)]


def test_risk_bands(spark):
    found = column(spark, "a int, s int, d int, want string", BANDS,
                   band=readings.risk_band(F.col("a"), F.col("s"), F.col("d")))
    assert [f[0] for f in found] == [b[3] for b in BANDS]


def test_risk_default(spark):
    data = [(d("2020-01-01"), "1a"), (d("2020-01-01"), None), (None, "1a"), (None, None)]
    found = column(spark, "g date, b string", data, risk=readings.risk_default(F.col("g"), F.col("b")))
    assert [f[0] for f in found] == ["1a", "1e", "-1", "-1"]


def test_priority_rank(spark):
    found = column(spark, "s string", [("b",), ("a",), ("?",), (None,)],
                   new=readings.priority_rank(F.col("s"), ["a", "b"]),
                   old=readings.priority_rank(F.col("s"), ["a", "b"], legacy=True))
    assert found == [(2, 2), (1, 1), (3, None), (3, None)]
