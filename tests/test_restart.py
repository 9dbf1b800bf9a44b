"""Runs that go on where another one ended."""

import os
import shutil

import pytest
from plain_rows import rows
from pyspark.sql import functions as F

from casebook.plans import report as report_plan
from casebook.plans.run import Run
from casebook.sources.fingerprint import fingerprint
from casebook.sources.writers import keep
from workload import jobs
from workload.views import Tables

SF = "/root/testdata/sf0.001"


def run(spark, out, sf=SF):
    made = jobs.run(Tables(spark, sf))
    made.out = str(out)
    return made


def test_a_second_run_takes_over_finished_products(spark, tmp_path, monkeypatch):
    first = run(spark, tmp_path / "run")
    want = rows(first.cohort, "cohort_id")
    assert {"extract", "clean_extract", "cohort"} <= set(first.seconds)

    def dies(self):
        raise KeyboardInterrupt

    monkeypatch.setattr(Run, "journal", property(dies))
    with pytest.raises(KeyboardInterrupt):
        first.all()
    monkeypatch.undo()
    second = run(spark, tmp_path / "run")
    assert rows(second.cohort, "cohort_id") == want and second.seconds == {}
    second.people  # noqa: B018
    assert set(second.seconds) == {"people"}
    # Another argument makes another product, and what follows from it.
    third = run(spark, tmp_path / "run")
    third.cohorts = third.cohorts[:1]
    assert third.cohort.count() <= len(want) and {"extract", "clean_extract", "cohort"} <= set(third.seconds)


def test_changed_inputs_are_noticed(spark, tmp_path):
    source = str(tmp_path / "source")
    spark.range(5).write.parquet(source)
    make = lambda: spark.read.parquet(source).select((F.col("id") * 2).alias("id"), F.transform(F.array("id"), lambda x: x + 1).alias("l"))
    path = str(tmp_path / "product")
    assert [keep(make(), path)[2] for _ in range(2)] == [True, False]
    spark.range(5, 7).write.mode("append").parquet(source)
    kept, _, new = keep(make(), path)
    assert new and kept.count() == 7
    assert keep(make().where("id > 2"), path)[2] and keep(make().where("id > 2"), path, ["id"])[2]


def test_what_has_no_files_is_made_anew(spark, tmp_path):
    listed = spark.createDataFrame([(1,)], "k int")
    assert fingerprint(listed) is None
    assert fingerprint(spark.sql("values 1, 2")) == fingerprint(spark.sql("values 1, 2")) != fingerprint(spark.sql("values 1, 3"))
    assert all(keep(listed, str(tmp_path / "p"))[2] for _ in range(2))


def test_failed_checks_publish_nothing(spark, tmp_path):
    def check(df):
        if df.count() > 3:
            raise ValueError("too many")

    path = str(tmp_path / "p")
    assert keep(spark.range(3).toDF("k"), path, check=check)[0].count() == 3
    with pytest.raises(ValueError, match="too many"):
        keep(spark.range(9).toDF("k"), path, check=check)
    kept, observed, new = keep(spark.range(3).toDF("k"), path, observed={"n": F.count("k")}, check=check)
    assert (kept.count(), observed, new) == (3, {"n": 3}, True)
    assert keep(spark.range(3).toDF("k"), path, observed={"n": F.count("k")}, check=check)[1:] == ({"n": 3}, False)


def test_the_report_needs_no_further_scan(spark, tmp_path):
    made = run(spark, tmp_path / "run")
    events, patients = made.events, made.patient
    observed = made.observed["events"], made.observed["patient"]
    assert not observed[0]["_extra_rows"] and observed[0]["_rows"] == events.count()
    quick = report_plan.report(events, patients, made.cohorts, made.labels, *observed)
    assert "FileScan" not in quick._jdf.queryExecution().executedPlan().toString()
    assert rows(quick) == rows(report_plan.report(events, patients, made.cohorts, made.labels))
    # Unexpected values are looked up where there are any.
    odd = events.withColumn("dataset", F.when(F.col("dataset") == "deaths", "strange").otherwise(F.col("dataset")))
    counts = odd.agg(*(c.alias(n) for n, c in report_plan.events_counts(odd, made.labels).items())).first().asDict()
    assert rows(report_plan.report(odd, patients, made.cohorts, made.labels, counts, observed[1])) == rows(
        report_plan.report(odd, patients, made.cohorts, made.labels)
    )
    again = run(spark, tmp_path / "run")
    assert rows(again.report) == rows(quick) and set(again.seconds) == {"report"}
    assert again.observed["events"] == observed[0]


def test_half_written_archives_are_made_anew(spark, tmp_path):
    from casebook.sources.writers import archive_snapshot

    path = str(tmp_path / "a")
    os.makedirs(f"{path}/_part=half/_temporary/0")
    spark.range(2).write.parquet(f"{path}/_part=dead")
    assert archive_snapshot(spark.range(5).toDF("k"), path).count() == 5
    assert archive_snapshot(spark.range(0).toDF("k"), path).count() == 5
    shutil.copytree(path, f"{path}2")  # a copy of an archive names its own files
    from casebook.sources.published import Published

    copy = Published(spark, f"{path}2")
    assert list(copy.describe()["files"]) == [copy.path] and copy.read().count() == 5
