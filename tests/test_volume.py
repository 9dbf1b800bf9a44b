"""How much is shuffled and written on the way to the products, and how much of it stays."""

import os
import re
import time
from contextlib import contextmanager

import pytest
from plain_rows import d, rows
from pyspark.sql import functions as F

from casebook.operators import latest, quality, spells
from casebook.plans import cohort, journal
from casebook.plans import events as events_plan
from casebook.plans.hospital import eligible_people, hospital_prep
from casebook.sources import writers
from casebook.sources.published import Published


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keys_are_compared_by_hash_first(spark, monkeypatch):
    seen, found = [], quality.duplicate_keys
    monkeypatch.setattr(quality, "duplicate_keys", lambda df, on: seen.append(df.columns) or found(df, on))
    df = spark.range(100).select(F.sha2(F.col("id").cast("string"), 256).alias("key"), "id")
    quality.require_unique(df, ["key"], "table")
    assert seen == [["_mark"]]
    with pytest.raises(ValueError):
        quality.require_unique(df.unionByName(df.where("id = 5")), ["key"], "table")
    nulls = spark.createDataFrame([(None, 1), (None, 2)], "key string, id int")
    with pytest.raises(ValueError):
        quality.require_unique(nulls, ["key"], "table")
    # Hashes that agree for different keys are no repeats.
    monkeypatch.setattr(quality.F, "xxhash64", lambda *columns: F.lit(7))
    assert quality.require_unique(df, ["key"], "table").count() == 100
    with pytest.raises(ValueError):
        quality.require_unique(df.unionByName(df.where("id = 5")), ["key"], "table")


def test_tables_are_written_with_a_codec_for_hex(spark, tmp_path):
    table = Published(spark, str(tmp_path / "t"))
    table.overwrite(spark.range(3))
    assert all(n.endswith(".zstd.parquet") for names in table.describe()["files"].values() for n in names)


EXTRACT = (
    "person_id string, birth_date date, extract_date date, practice string, sex string, lsoa string, ethnicity string, "
    "time_stamp string, meta_practice string, cohort string, age int, "
    "journal array<struct<journal_date:date,code:string,value1:string,value2:string>>"
)
KEY = ("person_id", "birth_date", "extract_date", "practice", "meta_practice")


def extracts(spark):
    entry = lambda day, code: (day and d(day), code, "1", None)
    row = lambda person, day, practice, *journal: (
        person, d("1950-01-01"), d(day), practice, "1", "E1", "A", "t", f"m{practice}", "C01", 60, list(journal))
    data = [
        row("4000000004", "2020-01-01", "p1", entry("2019-01-01", "a"), entry("2019-02-01", "b")),
        row("4000000004", "2020-01-01", "p2", entry("2019-02-01", "c")),
        row("4000000004", "2020-04-01", "p1", entry("2019-01-01", "a")),
        row("4000000012", "2020-04-01", "p1"),
        row("4000000020", "2020-04-01", "p1", entry(None, "a")),
        row("1234567890", "2020-04-01", "p1", entry("2019-01-01", "a")),
    ]
    df = spark.createDataFrame(data, EXTRACT)
    return cohort.extract(df, df.limit(0), ["C01"], KEY)


def test_extract_ids_are_not_sorted_along(spark):
    df = extracts(spark)
    plainly, lean = cohort.clean_extract(df), cohort.clean_extract(df, key_columns=KEY)
    assert rows(lean) == rows(plainly) and lean.columns == plainly.columns and lean.count() == 2
    assert "sha2" in plan(plainly).split("Exchange")[-1] and "sha2" not in plan(lean).split("Exchange")[-1]


def test_journal_carries_ids_as_bytes(spark):
    clean = cohort.clean_extract(extracts(spark), key_columns=KEY)
    ref = spark.createDataFrame([("a", "A_COD", 1), ("a", "B_COD", 1)], "ref_code string, cluster string, active int")
    plainly, lean = cohort.journal_table(clean, ref), cohort.journal_table(clean, ref, hashed=True)
    assert rows(lean) == rows(plainly) and lean.schema == plainly.schema and lean.count() == 3
    stored = spark.createDataFrame(clean.collect(), clean.schema)
    assert "unhex" in plan(cohort.journal_table(stored, None, hashed=True)).split("Exchange")[-1]


def test_people_are_those_of_the_cohort(spark):
    df = extracts(spark)
    found = eligible_people(cohort.with_journal(df))
    assert rows(found) == rows(eligible_people(cohort.cohort_table(cohort.clean_extract(df))))
    assert [r.person_id for r in found.collect()] == ["4000000004"]


def test_people_need_no_cohort_table(spark, tmp_path):
    from workload.jobs import run
    from workload.views import Tables

    r = run(Tables(spark, "/root/testdata/sf0.001"))
    r.out = str(tmp_path / "run")
    r.people  # noqa: B018
    assert set(r.seconds) == {"extract", "people"}
    assert rows(r.people) == rows(eligible_people(r.cohort))
    # Ids that follow from the stored columns are not stored.
    s = r.sources
    plainly = cohort.extract(s.annual, s.quarterly, r.cohorts, r.extract_key)
    assert r.extract.columns == plainly.columns
    assert rows(r.extract.select("meta_practice", "extract_id")) == rows(plainly.select("meta_practice", "extract_id"))
    assert rows(r.cohort.select("cohort_id")) == rows(r.clean_extract.select("extract_id"))
    for name in ("extract", "clean_extract"):
        assert "extract_id" not in Published(spark, f"{r.out}/{name}").read().columns


def test_lines_meet_orders_before_their_texts_are_made(spark):
    from workload.views import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    for df in (t.admitted.select("record_id", "person_id"), t.line_person.select("line_key", "person_id")):
        text = plan(df)
        assert "concat_ws(-" in text and "concat_ws(-" not in text[text.index("Join") :]


EPISODE = (
    "record_id string, spell_id string, admission_date date, discharge_date date, DIAG_4_01 string, "
    "DIAG_4_CONCAT string, person_id string, birth_date date"
)


def test_spell_dates_come_from_all_episodes_and_go_to_eligible_ones(spark):
    data = [
        ("a", "1", d("2020-01-01"), d("2020-01-02"), "I21 9", "I21 9, E119", "p", d("1950-01-01")),
        ("b", "1", d("2019-12-31"), d("2020-01-09"), "I639", "I639", "q", d("1950-01-01")),
        ("c", "-1", d("2020-01-01"), d("2020-01-02"), "J189", "J189", "p", d("1950-01-01")),
    ]
    people = spark.createDataFrame([("p", d("1950-01-01"))], "person_id string, birth_date date")
    df = spark.createDataFrame(data, EPISODE)
    episodes = hospital_prep(df, "admitted", "DIAG_4_01", "DIAG_4_CONCAT", admitted=True, eligible=people)
    found = {r.record_id: r for r in episodes.collect()}
    assert set(found) == {"a", "c"}
    assert (found["a"].spell_start, found["a"].spell_end) == (d("2019-12-31"), d("2020-01-09"))
    assert (found["a"].code, found["a"].code_array, found["a"].flag) == ("I219", ["I219", "E119"], "HEARTATTACK")
    assert found["c"].spell_id is None and found["c"].spell_start is None
    every = hospital_prep(df, "admitted", "DIAG_4_01", "DIAG_4_CONCAT", admitted=True)
    assert sorted(every.columns) == sorted(episodes.columns) and every.columns[-4:] == ["flag", "spell_start", "spell_end", "dataset"]
    # Lists are made after the join: none is shuffled.
    text = plan(every)
    assert "split(" in text and "split(" not in text[text.index("Exchange") : text.rindex("Exchange")]


def test_modal_values_are_counted_in_one_step(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.lit(d("2020-01-01")).alias("day"), F.lit("x").alias("a"), F.lit("y").alias("b"))
    found = spells.modal_values(df, ["k"], "day", {"a": [], "b": ["y"]})
    assert plan(found).count("Exchange") == 2
    assert rows(found) == [(k, "x", None) for k in range(7)]


def test_ladder_makes_derived_columns_again(spark):
    df = spark.createDataFrame(
        [(k % 5, d("2020-01-01"), "a", [(d("2020-01-01"), "x")]) for k in range(20)], "p int, extract date, area string, journal array<struct<day:date,c:string>>"
    ).withColumn("twice", F.col("p") * 2)
    lean = latest.dedup_ladder(df, ["p"], "extract", "journal", "day", ["area"], derived={"twice": F.col("p") * 2})
    assert rows(lean) == rows(latest.dedup_ladder(df, ["p"], "extract", "journal", "day", ["area"]))


def test_a_stored_copy_of_the_episodes_is_not_needed(spark, tmp_path, monkeypatch):
    """Spells follow from the join that gives the episodes their dates, without a shuffle of their own."""
    from workload import spells as queries
    from workload.registry import QUERIES

    def fail(*_):
        raise AssertionError("stored")

    monkeypatch.setattr(queries, "stored", fail, raising=False)
    assert QUERIES["collapse_spell"](spark, "/root/testdata/sf0.001").count() > 0
    assert QUERIES["spell_pipeline"](spark, "/root/testdata/sf0.001").count() > 0


def test_entries_without_ids_are_those_of_the_journal(spark):
    clean = cohort.clean_extract(extracts(spark), key_columns=KEY)
    ref = spark.createDataFrame([("a", "A_COD", 1), ("a", "B_COD", 1)], "ref_code string, cluster string, active int")
    whole, lean = cohort.journal_table(clean, ref, hashed=True), cohort.journal_table(clean, ref, identified=False)
    assert lean.columns == [c for c in whole.columns if c != "journal_id"]
    assert rows(lean) == rows(whole.drop("journal_id")) and lean.count() == 3
    stored = spark.createDataFrame(clean.collect(), clean.schema)
    assert "sha2" not in plan(cohort.journal_table(stored, ref, identified=False))
    assert cohort.require_unique_entries(lean) is lean
    # Values in another place give the same id, in the journal as here.
    swapped = lean.withColumn("code_array", F.reverse("code_array"))
    with pytest.raises(ValueError, match="journal: journal_id is not unique"):
        cohort.require_unique_entries(lean.unionByName(swapped))


def test_events_need_no_ids_of_the_journal(spark, tmp_path):
    from workload.jobs import run
    from workload.views import Tables

    r = run(Tables(spark, "/root/testdata/sf0.001"))
    r.out = str(tmp_path / "run")
    r.demographic, r.diagnoses  # noqa: B018
    assert not {"cohort", "journal", "entries"} & set(r.seconds)
    assert "record_id" not in Published(spark, f"{r.out}/readings").read().columns
    lean = [rows(df) for df in (r.entries, r.readings, r.diagnoses)]
    other = run(Tables(spark, "/root/testdata/sf0.001"))
    other.out = str(tmp_path / "other")
    assert other.entries.columns == r.entries.columns
    other = run(Tables(spark, "/root/testdata/sf0.001"))
    other.out = str(tmp_path / "whole")
    other.journal  # noqa: B018
    assert other.entries is other.journal
    assert lean == [rows(df) for df in (other.journal.drop("journal_id"), other.readings, other.diagnoses)]


def shuffled_files(spark):
    """Names of the shuffle files on this machine's disk."""
    env = spark._jvm.org.apache.spark.SparkEnv.get()
    files = env.blockManager().diskBlockManager().getAllFiles().iterator()
    names = set()
    while files.hasNext():
        names.add(files.next().getName())
    return {n for n in names if n.startswith("shuffle")}


def test_shuffle_files_go_when_a_write_ends(spark, tmp_path):
    before = shuffled_files(spark)
    counts = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    written, _, new = writers.keep(counts, str(tmp_path / "p"))
    ends = time.time() + 20
    while shuffled_files(spark) - before and time.time() < ends:
        time.sleep(0.1)
    assert not shuffled_files(spark) - before
    assert new and rows(written) == [(k, 100) for k in range(10)]
    # What has lost its files is made again.
    assert counts.count() == 10 and rows(counts) == rows(counts) == rows(written)


def test_whole_episodes_are_shuffled_once(spark):
    row = lambda i, spell, person: (
        f"r{i}", spell, d("2020-01-01"), d(f"2020-01-{2 + i:02}"), "I21 9", "I21 9, E119", person, d("1950-01-01"))
    data = [row(0, "1", "p"), row(0, "1", "p"), row(1, "1", "p"), row(2, "1", "q"), row(3, "1", None), row(4, "2", "q"), row(5, None, "p"), row(6, "-1", "q")]
    born = "person_id string, birth_date date"
    people = spark.createDataFrame([("p", d("1950-01-01")), ("p", d("1950-01-01")), (None, d("1950-01-01"))], born)
    found = spells.spell_bounds(spark.createDataFrame(data, EPISODE), people=people)
    assert rows(found.select("record_id", "spell_id", "spell_start", "spell_end")) == [
        *[("r0", "1", d("2020-01-01"), d("2020-01-05"))] * 2, ("r1", "1", d("2020-01-01"), d("2020-01-05")), ("r5", None, None, None)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        details = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        text = found._jdf.queryExecution().explainString(details)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    inputs = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", text)
    # One for the episodes of spells, one for the few without a spell.
    assert sum("DIAG_4_CONCAT" in i for i in inputs) == 2


def stages(path):
    return [n for n in os.listdir(path) if n.startswith("_stage")]


def test_episodes_are_made_from_a_stage_that_does_not_stay(spark, tmp_path, monkeypatch):
    from workload.jobs import run
    from workload.views import Tables

    seen, plain_stage = [], writers.stage

    @contextmanager
    def watched(session, below):
        with plain_stage(session, below) as store:
            yield lambda df: (store(df), seen.append(stages(below)))[0]

    monkeypatch.setattr(writers, "stage", watched)
    r = run(Tables(spark, "/root/testdata/sf0.001"))
    r.out = str(tmp_path / "run")
    s = r.sources
    plainly = hospital_prep(s.admitted, r.labels.admitted, *s.codes, admitted=True, eligible=r.people)
    assert r.episodes.columns == plainly.columns and rows(r.episodes) == rows(plainly)
    assert [len(names) for names in seen] == [1] and not stages(f"{r.out}/episodes")
    # A later run knows the product, though the stage is gone.
    again = run(Tables(spark, "/root/testdata/sf0.001"))
    again.out = r.out
    assert rows(again.episodes) == rows(plainly) and "episodes" not in again.seconds and len(seen) == 1


def test_a_stage_goes_when_its_reader_fails(spark, tmp_path):
    with pytest.raises(ValueError, match="no rows"), writers.stage(spark, str(tmp_path)) as store:
        assert store(spark.range(3)).count() == 3 and len(stages(tmp_path)) == 1
        raise ValueError("no rows")
    assert not stages(tmp_path)


def test_stored_episodes_are_dealt_by_spell_once(spark, tmp_path):
    from workload.jobs import run
    from workload.views import Tables

    r = run(Tables(spark, "/root/testdata/sf0.001"))
    r.out = str(tmp_path / "run")
    plainly, dealt = events_plan.spell_events(r.episodes), events_plan.spell_events(r.episodes, gather=True)
    # One for the ids and codes, one for the values that are counted.
    assert plan(dealt).count("Exchange hashpartitioning") == 2 < plan(plainly).count("Exchange hashpartitioning")
    assert rows(dealt) == rows(plainly)
    # The readings' two aggregates share one.
    readings = journal.blood_pressure(r.entries, r.labels.readings, r.first_reading)
    assert plan(readings).count("Exchange hashpartitioning") == 1


def test_rows_are_not_sorted_for_a_partitioned_write(spark, tmp_path, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    setting, seen, parquet = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet
    before = spark.conf.get(setting)

    def noted(writer, *arguments):
        seen.append(int(spark.conf.get(setting)))
        parquet(writer, *arguments)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    # More values than a task holds files open, nulls among them, and in no order.
    value = F.when(F.col("id") % 50 > 0, F.col("id") * 7 % 50)
    df = spark.range(0, 1000, 1, 2).select("id", value.alias("k"))
    written = Published(spark, str(tmp_path / "t")).overwrite(df, ["k"])
    assert seen[0] > 1 and spark.conf.get(setting) == before
    assert rows(written.select("id", "k")) == rows(df)
