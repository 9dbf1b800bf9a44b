import datetime as dt

import pytest
from plain_rows import d, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebook.constants import CONDITIONS, LINK
from casebook.operators import filters, history, links, quality, shaping
from casebook.plans import curation, deaths, demographic, events, journal, patient, report
from casebook.plans.cohort import clean_extract, extract, journal_table
from casebook.plans.hospital import hospital_extract, hospital_prep
from casebook.plans.labels import LABELS

JOURNAL = (
    "person_id string, birth_date date, extract_date date, cohort string, code string, "
    "journal_date date, cluster string, sex string, lsoa string, ethnicity string, "
    "code_array array<string>"
)
BORN = d("1960-01-01")


def entry(person, day, code=None, cluster=None, values=(None, None), extract_day="2024-01-01"):
    return (person, BORN, d(extract_day), "C01", code, d(day), cluster, "1", "E1", "A", list(values))


def diagnoses(spark, data):
    found = journal.diagnosis(spark.createDataFrame(data, JOURNAL)).collect()
    return {r.person_id: r for r in found}


def test_diagnosis_clusters_codes_and_resolution(spark):
    found = diagnoses(spark, [
        entry("p1", "2020-01-01", cluster="AFIB_COD"), entry("p1", "2021-01-01", cluster="AFIB_COD"),
        entry("p1", "2022-01-01", cluster="AFIBRES_COD"),
        entry("p2", "2020-01-01", cluster="AFIB_COD"), entry("p2", "2020-01-01", cluster="AFIBRES_COD"),
        entry("p3", "2020-01-01", "445010006", "OTHER"), entry("p3", "2020-01-02", "x", "SBROOME_COD"),
        entry("p3", "2020-01-03", "x", "PRD_COD"), entry("p3", "2020-01-04", "x", "UNKNOWN"),
        entry("p4", "1970-01-01", cluster="AFIB_COD"),
        entry("p5", "2020-01-01", cluster="HYP_COD"), entry("p5", "2019-01-01", cluster="HYPRES_COD"),
    ])
    assert set(found) == {"p1", "p2", "p3", "p4", "p5"}
    assert found["p1"].AF_diagnosis_date is None
    assert found["p2"].AF_diagnosis_date == d("2020-01-01")
    assert found["p3"].FH_diagnosis_date == d("2020-01-01")
    assert found["p3"].FHSCREEN_diagnosis_date == d("2020-01-02")
    assert found["p3"].NDH_diagnosis_date == d("2020-01-03")
    assert found["p4"].AF_diagnosis_date is None  # ten years old then
    assert found["p5"].HTN_diagnosis_date == d("2020-01-01")
    assert len(found["p1"].asDict()) == 2 + len(CONDITIONS)


def test_resolution_with_null_code_counts(spark):
    found = diagnoses(spark, [entry("p", "2020-01-01", cluster="CKD_COD"),
                              entry("p", "2020-01-02", None, "CKDRES_COD")])
    assert found["p"].CKD_diagnosis_date is None


def test_blood_pressure(spark):
    systolic, diastolic = "271649006", "271650006"
    data = [
        entry("p", "2020-01-01", systolic, None, ("140", None)),
        entry("p", "2020-01-01", systolic, None, ("99", None)),
        entry("p", "2020-01-01", diastolic, None, ("80.5", None)),
        entry("p", "2020-01-02", "x", "BP_COD", ("150", "80")),
        entry("p", "2020-01-02", "x", "BP_COD", ("130", "85"), "2024-04-01"),
        entry("p", "2020-01-03", systolic, None, ("140", None)),
        entry("p", "2017-12-31", "x", "BP_COD", ("130", "85")),
        entry("p", "2020-01-04", "x", "BP_COD", ("abc", "85")),
        entry("p", "2020-01-05", "x", "BP_COD", ("49", "85")),
    ]
    found = journal.blood_pressure(spark.createDataFrame(data, JOURNAL), "readings")
    assert rows(found, "journal_date", "systolic", "diastolic", "flag") == [
        (d("2020-01-01"), 99.0, 80.5, "0.1"), (d("2020-01-02"), 130.0, 85.0, "0.1")]
    assert quality.unique_check(found, ["record_id"]).first().is_unique
    text = {r.record_start_date: r.code for r in events.reading_events(found).collect()}
    assert text == {d("2020-01-01"): "99/80.5", d("2020-01-02"): "130/85"}


def test_smoking(spark):
    data = [entry("p", "2020-01-01", "s"), entry("p", "2022-01-01", "s"), entry("p", "2021-01-01", "e"),
            entry("p", "2021-01-01", "other")]
    status = journal.smoking(spark.createDataFrame(data, JOURNAL), {"current": ["s"], "ex": ["e"]})
    periods = journal.smoking_periods(status.select(*LINK, "journal_date", "flag", "age"))
    assert rows(periods, "flag", "journal_date", "record_start_date", "age") == [
        ("current", d("2022-01-01"), d("2020-01-01"), 62), ("ex", d("2021-01-01"), d("2021-01-01"), 61)]
    assert quality.max_entries_check(periods, LINK).first().within_limit


DEATH = (
    "death_id string, confirmed_id string, unconfirmed_id string, birth_date string, "
    "date_of_death string, registration_date string, sex string, code string, code_array string, "
    "residence string, location string, current string, cancelled string"
)


def death(i, died="20200110", registered="20200112", place="E1", location="E1", current="True",
          cancelled="N", confirmed="p1", unconfirmed=None, born="19500101", code="I219", others="I219,I634"):
    return (i, confirmed, unconfirmed, born, died, registered, "1", code, others, place, location,
            current, cancelled)


def test_deaths(spark):
    data = [
        death("1"), death("2", died="20200109"), death("3", place="W0"), death("4", place=None, confirmed=None,
        unconfirmed="p2"), death("5", place=None, location="W0", confirmed="p3"),
        death("6", current="False", confirmed="p4"), death("7", cancelled="Y", confirmed="p4"),
        death("8", current=None, confirmed="p4"), death("9", died="19400101", confirmed="p4"),
        death("10", died="rubbish", confirmed="p4"), death("11", confirmed=None),
        death("12", died="20300101", confirmed="p4"), death("13", code="C34", others="C34", confirmed="p5"),
    ]
    found = deaths.deaths(spark.createDataFrame(data, DEATH), "deaths", dt.date(2025, 1, 1))
    kept = {r.person_id: r for r in found.collect()}
    assert set(kept) == {"p1", "p2", "p5"}
    assert kept["p1"].record_id_assoc == "2" and kept["p1"].flag == "HEARTATTACK"
    assert (kept["p1"].flag_assoc_stroke, kept["p1"].flag_assoc_heartattack) == (1, 0)
    assert (kept["p5"].flag, kept["p5"].flag_assoc_cvd_other) == ("NON_CVD", 0)


def test_history_before_death(spark):
    people = spark.createDataFrame(
        [("p", BORN, d("2020-01-02")), ("q", BORN, None), ("r", BORN, None)],
        "person_id string, birth_date date, date_of_death date")
    data = [("p", "2019-12-02", "OUT", []), ("p", "2019-12-03", "STROKE", []),
            ("p", "2020-01-01", "HEARTATTACK", []), ("p", "2020-01-02", "STROKE", []),
            ("p", "2020-01-03", "STROKE", []), ("q", "2020-01-01", "MULTIPLE", ["STROKE", "HEARTATTACK"]),
            ("q", "2020-02-01", None, None)]
    ev = spark.createDataFrame([(p, BORN, d(x), f, a) for p, x, f, a in data],
        "person_id string, birth_date date, record_start_date date, flag string, flag_assoc array<string>")
    counts = history.conditional_history(people, ev, {"stroke": "STROKE", "mi": "HEARTATTACK"})
    found = {r.person_id: r for r in counts.collect()}
    assert (found["p"].stroke_count, found["p"].max_stroke_date) == (2, d("2020-01-02"))
    assert (found["q"].stroke_count, found["q"].mi_count) == (1, 1)
    assert (found["r"].stroke_count, found["r"].max_mi_date) == (0, None)
    flags = {r.person_id: r.f for r in history.flags_before_death(people, ev, "f").collect()}
    assert flags == {"p": ["HEARTATTACK", "STROKE"], "q": None, "r": None}
    nameless = ev.withColumn("flag", F.lit(None).cast("string"))
    flags = {r.person_id: r.f for r in history.flags_before_death(people, nameless, "f").collect()}
    assert flags == {"p": [], "q": None, "r": None}


def test_cutoff(spark):
    ev = spark.createDataFrame([("a", d("2020-01-01")), ("a", d("2020-01-02")), ("a", None), ("b", d("2020-01-01"))],
                               "p string, day date")
    cut = spark.createDataFrame([("a", d("2020-01-02"))], "p string, cut date")
    strict = links.before_cutoff(ev, cut, "day", "cut", ["p"])
    assert rows(strict, "p", "day") == [("a", d("2020-01-01"))]
    loose = links.before_cutoff(ev, cut, "day", "cut", ["p"], True, True)
    assert rows(loose, "p", "day") == [("a", d("2020-01-01")), ("a", d("2020-01-02")), ("b", d("2020-01-01"))]


def test_risk_assignment(spark):
    people = spark.createDataFrame(
        [(p, BORN, d("2020-06-01"), d(g)) for p, g in
         [("new", "2019-01-01"), ("old", "2019-01-01"), ("none", None)]],
        "person_id string, birth_date date, latest_extract_date date, HTN_diagnosis_date date")
    readings = spark.createDataFrame(
        [("new", BORN, d("2020-01-01"), "1a"), ("new", BORN, d("2020-02-01"), "1b"),
         ("new", BORN, d("2020-06-02"), "1c"), ("old", BORN, d("2019-05-31"), "1a"),
         ("none", BORN, d("2020-02-01"), "1a")],
        "person_id string, birth_date date, record_start_date date, flag string")
    assert rows(patient.assign_risk(people, readings), "person_id", "hyp_risk_group") == [
        ("new", "1b"), ("none", "-1"), ("old", "1e")]


def test_extract_key_and_cohorts(spark):
    df = spark.createDataFrame([(1, "C01", "A"), (2, None, "B"), (3, "C03", "C")], "idx int, cohort string, val string")
    found = extract(df, df.limit(0), ["C01"], ["idx", "val"]).collect()
    assert [r.extract_id for r in found] == ["b6d4913b6c53f6699e89d883423f6e86ff80042dc21b64127205e6b8f4dd1e5b"]


def test_cohort_and_journal(spark):
    schema = (
        "person_id string, birth_date date, extract_date date, cohort string, practice string, sex string, "
        "lsoa string, ethnicity string, time_stamp string, meta_practice string, age int, extract_id string, "
        "journal array<struct<journal_date: date, code: string, value1: string, value2: string>>")
    e = {"journal_date": d("2019-05-01"), "code": "c1", "value1": "1", "value2": None}
    f = {"journal_date": d("2019-06-01"), "code": "c2", "value1": None, "value2": None}

    def row(person, day, area, entries, key):
        return (person, BORN, d(day), "C01", "g", "1", area, "A", "t", "m", 50, key, entries)

    data = [row("9434765919", "2020-01-01", "E1", [e], "k1"), row("9434765919", "2020-01-01", "E1", [e, f], "k2"),
            row("9434765919", "2020-04-01", "E1", [e], "k3"), row("9434765918", "2020-01-01", "E1", [e], "k4"),
            row(None, "2020-01-01", "E1", [e], "k5")]
    clean = clean_extract(spark.createDataFrame(data, schema))
    assert rows(clean, "extract_id") == [("k2",), ("k3",)]
    ref = spark.createDataFrame([("c1", "X", 1), ("c1", "Y", 1), ("c1", "Z", 0)], "ref_code string, cluster string, active int")
    found = journal_table(clean, ref)
    assert rows(found, "code", "extract_date", "cluster") == [
        ("c1", d("2020-04-01"), "X"), ("c1", d("2020-04-01"), "Y"), ("c2", d("2020-01-01"), None)]
    assert quality.unique_check(found, ["journal_id"]).first().is_unique


def test_hospital_prep(spark):
    data = [("1", "I21 9", "I21 9, J32 , I23, FOO", "s"), ("2", "R69X", "R69X", "s"), ("3", None, None, "s")]
    df = spark.createDataFrame(data, "record_id string, DIAG_4_01 string, DIAG_4_CONCAT string, spell_id string")
    df = df.withColumns({"admission_date": F.lit(d("2020-01-01")), "discharge_date": F.lit(d("2020-01-02"))})
    found = hospital_prep(df, "admitted", "DIAG_4_01", "DIAG_4_CONCAT", admitted=True).collect()
    assert [(r.code, r.code_array, r.flag) for r in found] == [
        ("I219", ["I219", "J32", "I23", "FOO"], "HEARTATTACK")]
    emergency = spark.createDataFrame([("1", "ABCD")], "record_id string, DIAG2_01 string")
    numbered = emergency.select("*", *(F.lit("x" if i == 3 else None).alias(f"D{i:02d}") for i in range(1, 13)))
    found = hospital_prep(numbered, "emergency", "DIAG2_01", "codes", numbered_prefix="D").first()
    assert (found.code, found.code_array, found.dataset) == ("AB", ["x"], "emergency")


def demographic_case(spark, cohort, others):
    schema = shaping.EVENT_SCHEMA
    base = {f.name: None for f in schema}
    data = [{**base, "person_id": p, "birth_date": BORN, "dataset": LABELS.cohort,
             "category": LABELS.cohort_category, "record_start_date": d(x), "ethnicity": v} for p, x, v in cohort]
    ev = spark.createDataFrame([tuple(r[f.name] for f in schema) for r in data], schema)
    shape = "person_id string, birth_date date, dataset string, record_start_date date, ethnicity string"

    def source(name):
        return spark.createDataFrame([(p, BORN, s, d(x), v) for p, s, x, v in others if s == name], shape)

    j = spark.createDataFrame([(p, BORN, d(x), v) for p, s, x, v in others if s == LABELS.journal],
                              "person_id string, birth_date date, journal_date date, code string")
    ref = spark.createDataFrame([("eA", "A"), ("eB", "B"), ("eZ", "Z")], "ref_code string, ethnicity string")
    found = demographic.demographic(ev, j, source(LABELS.outpatient), source(LABELS.emergency), ref, 20)
    return {r.person_id: (r.dataset, r.ethnicity, r.enhanced_ethnicity_flag) for r in found.collect()}


def test_demographic(spark):
    found = demographic_case(
        spark,
        [("known", "2020-01-01", "A"), ("known", "2020-02-01", "Z"), ("both", "2020-01-01", "A"),
         ("both", "2020-01-01", "B"), ("lost", "2020-01-01", "Z"), ("late", "2020-01-01", "99"),
         ("old", "2020-01-01", None)],
        [("both", "journal", "2020-01-01", "eB"), ("lost", "journal", "2020-01-01", "eZ"),
         ("late", "journal", "2020-01-01", "eA"), ("late", "outpatient", "2020-01-02", "H"),
         ("old", "emergency", "2019-12-31", "A"), ("known", "outpatient", "2021-01-01", "H")],
    )
    assert found == {"known": ("cohort", "A", 0), "both": ("journal", "B", 1), "lost": (None, None, 1),
                     "late": ("outpatient", "H", 1), "old": (None, None, 1)}


def event_rows(spark, data):
    schema = shaping.EVENT_SCHEMA
    base = {f.name: None for f in schema}
    filled = [{**base, "person_id": "p", "birth_date": BORN, "record_id": str(i),
               "record_start_date": d("2020-01-01"), **r} for i, r in enumerate(data)]
    return spark.createDataFrame([tuple(r[f.name] for f in schema) for r in filled], schema)


def test_curation(spark):
    def ev(dataset, category, flag=None, codes=None):
        return {"dataset": dataset, "category": category, "flag": flag, "code_array": codes}

    df = event_rows(spark, [
        ev("admitted", "spell", "NO_CVD"), ev("admitted", "episode", None), ev("admitted", "spell", "STROKE", ["a", "b"]),
        ev("cohort", "cohort_extract"), ev("readings", "bp", "1a"), ev("other", "bp"), ev("readings", "other"),
    ])
    found = curation.curated_events(df)
    assert rows(found, "dataset", "code_array") == [("admitted", "a,b"), ("cohort", ""), ("readings", "")]
    assert "birth_date" not in found.columns
    people = spark.createDataFrame([("p", BORN, ["x"])], "person_id string, birth_date date, l array<string>")
    shared = curation.curated_patients(people)
    assert shared.first().birth_year == "1960" and shared.first().l == "x"
    rules = {r.rule: r.rows for r in curation.broken_rules(found, shared).collect()}
    assert set(rules.values()) == {0}
    rules = {r.rule: r.rows for r in curation.broken_rules(df, people).collect()}
    assert rules["events_flag"] == 1 and rules["events_dataset"] == 1 and rules["events_category"] == 1
    assert rules["events_columns"] == 1 and rules["patients_columns"] == 1 and rules["patients_birth_year"] == 1


def full_table(spark, schema, data):
    """Rows with every column filled by its type."""
    filler = {T.StringType(): "x", T.DateType(): d("2020-01-01"), T.IntegerType(): 1}
    base = {f.name: filler.get(f.dataType, ["x"]) for f in schema}
    return spark.createDataFrame([tuple({**base, **r}[f.name] for f in schema) for r in data], schema)


def test_report(spark):
    good = full_table(spark, shaping.EVENT_SCHEMA, [{"dataset": n} for n in LABELS.datasets])
    people = full_table(spark, patient.PATIENT_SCHEMA, [{"cohort": "C01"}, {"cohort": "C02"}])
    found = report.report(good, people, ["C01", "C02"])
    assert [r.level for r in found.collect()] == ["pass"] * 12
    assert len({r.check for r in found.collect()}) == 10
    bad = good.where("dataset <> 'deaths'").withColumn("sex", F.lit(None).cast("string"))
    bad = bad.withColumn("person_id", F.when(F.col("dataset") != "cohort", F.col("person_id")))
    found = {(r.check, r.message) for r in report.report(bad, people, ["C01", "C03"]).collect() if r.level == "warning"}
    assert found == {
        ("events_datasets_present", "missing: deaths"), ("events_fields_all_null", "only nulls: sex"),
        ("events_required_fields", "nulls: person_id"), ("patients_cohorts_present", "missing: C03"),
        ("patients_cohorts_present", "not expected: C02")}
    empty = report.report(good.limit(0), people, ["C01", "C02"])
    assert [r.check for r in report.failures(empty).collect()] == ["events_not_empty"]
    narrow = report.report(good.drop("sex"), people, ["C01", "C02"]).where("check = 'events_schema'").first()
    assert narrow.level == "warning" and "sex" in narrow.message


def test_every_unexpected_value_is_listed(spark):
    events = full_table(spark, shaping.EVENT_SCHEMA, [{"dataset": f"new{k:02}"} for k in range(30)] * 2)
    people = full_table(spark, patient.PATIENT_SCHEMA, [{"cohort": "C01"}, {"cohort": "C02"}])
    found = report.unexpected_values(events, people, ["C01"]).collect()
    assert sorted((r.check, r.value, r.rows) for r in found) == [
        *(("events_datasets_present", f"new{k:02}", 2) for k in range(30)), ("patients_cohorts_present", "C02", 1)]


def test_shaping_errors(spark):
    df = spark.createDataFrame([(1, "a", True)], "i int, s string, b boolean")
    with pytest.raises(TypeError):
        shaping.make_array(df, "x", ["i", "s"])
    with pytest.raises(TypeError):
        shaping.split_to_array(df, "i")
    with pytest.raises(TypeError):
        shaping.ensure_types(df, {"b": "short"})
    with pytest.raises(ValueError):
        shaping.unify_schema(df, {"nowhere": "i"})
    with pytest.raises(ValueError):
        shaping.add_hash_key(df, "k", [])
    with pytest.raises(TypeError):
        links.filter_by_frame(df, df, ["i"])
    assert shaping.make_array(df.withColumn("j", F.lit(2)), "x", ["i", "j"], drop=False).first().x == [1, 2]


def test_filters(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    assert rows(filters.filter_values(df, "v", "a")) == [("a",)]
    assert rows(filters.filter_values(df, "v", ["a"], keep=False)) == [("b",)]
    region = spark.createDataFrame([("W0", None), (None, "E01010044"), (None, "W01000327"), ("E123", None)],
                                   "p string, q string")
    assert rows(filters.region_filter(region, "p", "q")) == [("E123", None), (None, "E01010044")]


def test_quality(spark):
    df = spark.createDataFrame([(1, None), (None, None), (None, None)], "a int, b int")
    assert not quality.unique_check(df, ["a"]).first().is_unique
    assert rows(quality.all_null_columns(df)) == [("b",)]
    assert rows(quality.nulls_in_required(df, ["a", "b"])) == [("a", 2), ("b", 3)]
    with pytest.raises(ValueError):
        quality.require_unique(df, ["a"], "table")
    one = quality.max_entries_check(spark.createDataFrame([("p",)] * 4, "p string"), ["p"]).first()
    assert (one.within_limit, one.largest) == (False, 4)
    assert quality.is_empty(df.limit(0)).first().is_empty


def test_rolling_daily(spark):
    data = [(d(f"2020-02-{day:02d}"),) for day in range(1, 10) for _ in range(day)]
    found = history.rolling_daily(spark.createDataFrame(data, "day date"), "day", "mean")
    assert [r[2] for r in rows(found)] == [1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 5.0, 6.0]


def test_timing_rows(spark):
    found = report.timing_rows(spark, {"events": 1.5}).collect()
    assert [tuple(r) for r in found] == [
        ("events", "total_time", "1.500", "timing"),
        ("pipeline", "total_time", "1.500", "pipeline_stats"),
        ("pipeline", "stages", "1", "pipeline_stats"),
    ]


def test_broken_rules_stop_a_run(spark):
    from casebook.plans import run

    broken = spark.createDataFrame([("a", 0), ("b", 2)], "rule string, rows long")
    with pytest.raises(RuntimeError, match="b"):
        run._ruled(broken, broken)
    assert run._ruled(broken, broken.where("rows = 0")) is broken


def test_repeated_spell_ids_raise(spark):
    rows = spark.createDataFrame([("e1", "k1", 2020)], "record_id string, link string, fyear int")
    people = spark.createDataFrame([("k1", "p1", 2020)], "link string, person_id string, fyear int")
    ids = spark.createDataFrame([("e1", "s1", 2020), ("e1", "s2", 2020)], "record_id string, spell_id string, fyear int")
    with pytest.raises(ValueError, match="spell ids"):
        hospital_extract(
            ({"2021": rows}, {}), ({"2021": people}, {}), 20, 22, "link", columns=["record_id", "link"],
            spells=({"2021": ids}, {}), spell_columns=("record_id", "spell_id"),
        )


def test_more_smoking_periods_than_statuses_raise(spark):
    rows = [("p", d("1950-01-01"), str(k)) for k in range(4)]
    df = spark.createDataFrame(rows, "person_id string, birth_date date, flag string")
    with pytest.raises(ValueError, match="smoking"):
        journal.checked_periods(df)
    assert journal.checked_periods(df.limit(3)).count() == 3


def test_patient_reads_each_product_once_per_branch(spark, tmp_path):
    """The last step scans the events once for each kind, and nothing twice."""
    from casebook.operators.shaping import EVENT_SCHEMA
    from casebook.plans.patient import patient

    path = str(tmp_path / "events")
    spark.createDataFrame([], EVENT_SCHEMA).write.partitionBy("dataset", "category").parquet(path)
    stored = spark.read.schema(EVENT_SCHEMA).parquet(path)
    conditions = ", ".join(f"{c}_diagnosis_date date" for c in CONDITIONS)
    people = "person_id string, birth_date date"
    diagnoses = spark.createDataFrame([], f"{people}, {conditions}")
    first = spark.createDataFrame([], f"{people}, latest_extract_date date, latest_practice_identifier string, sex string, lsoa string, cohort string")
    table = patient(stored, diagnoses, spark.createDataFrame([], f"{people}, ethnicity string"), first=first)
    text = table._jdf.queryExecution().executedPlan().toString()
    # Deaths three times (the person's, and as a cut-off for spells and for episodes).
    assert 0 < text.count("FileScan parquet") <= 6


def test_run_stops_at_repeated_keys(spark):
    from workload.jobs import run
    from workload.views import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    r = run(t)
    r.extract_key = ["person_id"]
    with pytest.raises(ValueError, match="extract_id is not unique"):
        r.extract
