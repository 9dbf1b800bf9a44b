from plain_rows import d, rows
from pyspark.sql import functions as F

from casebook.operators import spells

EPISODE = (
    "record_id string, spell_id string, record_start_date date, code string, flag string, "
    "code_array array<string>, lsoa string, birth_date date, person_id string, ethnicity string, "
    "sex string, dataset string, spell_start date, spell_end date"
)


def episode(record, spell, day, code="I21", flag="HEARTATTACK", codes=("I21",), lsoa="E1",
            birth="1950-01-01", person="p", ethnicity="A", sex="1"):
    return (record, spell, d(day), code, flag, list(codes), lsoa, d(birth), person, ethnicity, sex,
            "admitted", d("2020-01-01"), d("2020-02-01"))


def test_spell_bounds_ignore_placeholders(spark):
    data = [("a", "20000", "2022-01-01", "2022-01-05"), ("b", "20000", None, "2022-02-05"),
            ("c", "20000", "2022-02-01", None), ("d", "30000", "1800-01-01", "1801-01-01"),
            ("e", "30000", "2023-01-01", "2023-01-01"), ("f", "30000", "2023-01-02", None),
            ("g", "-1", "2020-01-01", "2020-01-02"), ("h", None, "2020-01-01", "2020-01-02")]
    df = spark.createDataFrame(
        [(r, s, d(a), d(b)) for r, s, a, b in data],
        "record_id string, spell_id string, admission_date date, discharge_date date",
    )
    found = {r.record_id: r for r in spells.spell_bounds(df).collect()}
    assert len(found) == 8
    assert {(found[k].spell_start, found[k].spell_end) for k in "abc"} == {
        (d("2022-01-01"), d("2022-02-05"))}
    assert {(found[k].spell_start, found[k].spell_end) for k in "def"} == {
        (d("2023-01-01"), d("2023-01-01"))}
    assert found["d"].admission_date is None and found["g"].spell_id is None
    assert found["g"].spell_start is None and found["h"].spell_start is None


def test_modal_value(spark):
    data = [("s", "x", "2020-01-03"), ("s", "x", "2020-01-04"), ("s", "y", "2020-01-01"),
            ("t", "x", "2020-01-02"), ("t", "y", "2020-01-01"), ("u", "x", "2020-01-01"),
            ("u", "y", "2020-01-01"), ("v", "bad", "2020-01-01"), ("v", None, "2020-01-01")]
    df = spark.createDataFrame([(s, v, d(x)) for s, v, x in data], "s string, v string, day date")
    found = dict(rows(spells.modal_value(df, ["s"], "v", "day", ["bad"]).distinct(), "s", "v"))
    assert found == {"s": "x", "t": "y", "u": "y", "v": None}


def test_latest_value_goes_to_all_rows(spark):
    data = [("s", None, "2020-01-05"), ("s", "E2", "2020-01-03"), ("s", "E1", "2020-01-03"),
            ("s", "E0", "2020-01-01"), ("t", None, "2020-01-01")]
    df = spark.createDataFrame([(s, v, d(x)) for s, v, x in data], "s string, v string, day date")
    found = rows(spells.latest_value(df, ["s"], "v", "day"), "s", "v")
    assert found == [("s", "E1")] * 4 + [("t", None)]


def test_collapse_and_summarise(spark):
    data = [
        episode("2", "1", "2020-01-02", "I61", "STROKE", ["I61", "J10"], lsoa=None, person="q"),
        episode("1", "1", "2020-01-01", birth="1801-01-01", ethnicity="Z"),
        episode("3", "1", "2020-01-03", lsoa="E9", ethnicity="B"),
        episode("4", "2", "2020-01-01", "J10", "NO_CVD", ["J10"], person="0000000000"),
        episode("5", "2", "2020-01-02", "I21", "HEARTATTACK", ["I21"], sex="2"),
        episode("6", None, "2020-01-02"),
        episode("7", "3", "2020-01-02", None, None, []),
    ]
    found = {r.spell_id: r for r in spells.spell_pipeline(spark.createDataFrame(data, EPISODE)).collect()}
    assert set(found) == {"1", "2", "3"}
    one, two, three = found["1"], found["2"], found["3"]
    assert one.record_id_assoc == ["1", "2", "3"]
    assert (one.code, one.code_array) == ("MULTIPLE", ["I21", "I61"])
    assert (one.flag, one.flag_assoc) == ("MULTIPLE", ["HEARTATTACK", "STROKE"])
    assert (one.lsoa, one.person_id, one.birth_date) == ("E9", "p", d("1950-01-01"))
    assert one.ethnicity == "A" and one.all_codes == ["I21", "I61", "J10"]
    assert (two.flag, two.flag_assoc) == ("HEARTATTACK", ["HEARTATTACK", "NO_CVD"])
    assert (two.person_id, two.sex) == ("p", "1")
    assert (three.code, three.flag, three.flag_assoc) == ("NO_CVD", "NO_CVD", None)


def test_summarise_single_flags(spark):
    data = [(["A", "B"], ["A", "NO_CVD"]), (["NO_CVD"], ["NO_CVD"]), ([""], ["A"])]
    df = spark.createDataFrame(data, "code array<string>, flag array<string>")
    found = [tuple(r) for r in spells.summarise_multi(df).select("code", "flag", "flag_assoc").collect()]
    assert found == [("MULTIPLE", "A", ["A", "NO_CVD"]), ("NO_CVD", "NO_CVD", None), (None, "A", None)]


def test_large_spell_keeps_all_its_members(spark):
    data = [episode(f"{i:05d}", "hot", "2020-01-01") for i in range(20_000)]
    data += [episode("x", "cold", "2020-01-01")]
    df = spark.createDataFrame(data, EPISODE)
    wide = {r.spell_id: r for r in spells.collapse_spell(df).collect()}
    assert wide["hot"].record_id == [f"{i:05d}" for i in range(20_000)] and wide["hot"].code == ["I21"]
    assert wide["cold"].record_id == ["x"]
    assert spells.spell_members(df).where("spell_id = 'hot'").count() == 20_000


def test_episode_methods(spark):
    df = spark.createDataFrame([("11,2A",), ("21",), (None,)], "admission_method string")
    found = [r.flag_assoc for r in spells.episodes_with_methods(df).collect()]
    assert found == [["11", "2A"], ["21"], None]


def test_spells_do_not_depend_on_partitions(spark):
    data = [episode(str(i), str(i % 9), f"2020-01-{i % 3 + 1:02d}", lsoa=f"E{i % 4}",
                    person=f"p{i % 5}", sex=str(i % 2)) for i in range(200)]
    df = spark.createDataFrame(data, EPISODE)
    columns = ["spell_id", "lsoa", "person_id", "sex", "ethnicity"]
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    one = rows(spells.collapse_spell(df), *columns)
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    many = rows(spells.collapse_spell(df.orderBy(F.col("record_id").desc())), *columns)
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert one == many
