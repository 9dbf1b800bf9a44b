"""Plan shapes that keep hot keys and large tables workable."""

import pytest
from plain_rows import d, rows
from pyspark.sql import functions as F

from casebook.operators import latest, links, spells


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df)


@pytest.fixture
def skewed(spark):
    """A third of the rows belong to one key."""
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("p"), F.col("id")))
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 2).cast("int"))
    return spark.range(30000, numPartitions=6).select(
        hot.alias("pid"), day.alias("day"), "id",
        F.concat(*(F.sha2(F.concat(F.lit(str(i)), "id"), 512) for i in range(3))).alias("filler"),
    )


@pytest.fixture
def shuffled(spark):
    """No broadcast, and a low bar for what counts as a skewed partition."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_one_row_per_key_is_cut_before_the_shuffle(skewed):
    text = plan(latest.first_per_key(skewed, ["pid"], [F.col("day").desc(), F.col("id")]))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_ties_are_not_gathered_by_a_window(shuffled, skewed):
    kept = latest.keep_latest(skewed, ["pid"], "day")
    text = final_plan(kept)
    assert "Window" not in text
    assert "skew=true" in text
    newest = {p: max(x.day for x in rs) for p, rs in _by_key(skewed).items()}
    assert kept.count() == sum(1 for r in skewed.collect() if r.day == newest[r.pid])


def _by_key(df):
    groups = {}
    for r in df.collect():
        groups.setdefault(r.pid, []).append(r)
    return groups


def test_rows_without_a_key_are_not_shuffled(shuffled, skewed):
    df = skewed.withColumn("pid", F.when(F.col("pid") != "hot", F.col("pid")))
    right = df.where("pid is not null").groupBy("pid").agg(F.max("day").alias("last"))
    joined = links.attach(df, right, ["pid"])
    assert joined.count() == 30000 and joined.where("pid is null and last is not null").count() == 0
    branches = plan(joined.where("pid is null"))
    assert "Exchange" not in branches


def test_hot_spell_is_reduced_before_the_shuffle(skewed):
    df = skewed.withColumns({"a": F.lit("A"), "b": F.lit("B")})
    text = plan(spells.modal_values(df, ["pid"], "day", {"a": [], "b": []}))
    first_exchange = text.rindex("Exchange")
    assert "partial_count" in text[first_exchange:]


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, d("2020-01-01"), "x")], "k int, day date, v string").write.parquet(path)
    from casebook.operators.filters import from_year
    from casebook.sources.readers import latest_snapshot

    df = spark.read.parquet(path)
    text = plan(from_year(df, "day", 19).select("k"))
    assert "GreaterThanOrEqual(day,2019-01-01)" in text and "v:string" not in text
    assert "EqualTo(day,ScalarSubquery" in plan(latest_snapshot(df, "day"))


def test_event_filters_prune_union_branches(spark):
    from casebook.operators.filters import events_of

    branches = [spark.range(5).select("id", F.lit(n).alias("dataset"), F.lit("c").alias("category")) for n in "abc"]
    union = branches[0].unionByName(branches[1]).unionByName(branches[2])
    text = plan(events_of(union, "b", "c"))
    assert "Union" not in text and text.count("Range") == 1


def test_run_on_the_given_tables(spark, tmp_path):
    from workload.jobs import run
    from workload.views import Tables

    r = run(Tables(spark, "/root/testdata/sf0.001"))
    r.out = str(tmp_path / "run")
    tables = r.all()
    people = tables["patient"]
    assert people.count() == people.select("person_id", "birth_date").distinct().count() > 0
    late = people.where("max_stroke_date > date_of_death or max_mi_date > date_of_death")
    assert late.count() == 0
    events = tables["events"]
    assert events.count() == sum(
        tables[n].count() for n in ("cohort", "episodes", "deaths", "readings")
    ) + events.where("category = 'spell'").count()
    assert rows(tables["report"].where("level = 'fail'")) == []
    spelled = tables["episodes"].where("spell_id is not null and spell_start is not null and spell_end is not null")
    assert events.where("category = 'spell'").count() == spelled.select("spell_id").distinct().count()
    spells_members = events.where("category = 'spell'").agg(F.sum(F.size("record_id_assoc"))).first()[0]
    assert spells_members == spelled.select("record_id").distinct().count()
    assert set(r.seconds) >= {"events", "patient"}


def test_hot_person_meets_anchors_by_bins(shuffled):
    """A third of all events on one person: they meet its anchor by bins of days, and only near it."""
    spark = shuffled
    person = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("p")
    day = F.date_add(F.lit("2010-01-01").cast("date"), (F.col("id") % 3650).cast("int")).alias("day")
    events = spark.range(30_000).select(person, day, "id")
    anchors = events.groupBy("p").agg(F.max("day").alias("anchor"))
    for found, low, high in (
        (links.within_days(events, anchors, "day", "anchor", ["p"], 30), 1, 30),
        (links.within_months(events, anchors, "day", "anchor", ["p"], 12), 0, 366),
    ):
        gap = F.datediff("anchor", "day")
        direct = events.join(anchors, "p").where((gap >= low) & (gap <= high)) if low else events.join(anchors, "p").where(
            F.months_between("anchor", "day").between(0, 12)
        )
        assert rows(found) == rows(direct)
    paired = links.near_before(events, anchors, "day", "anchor", ["p"], 30)
    assert paired.where("p = 0").count() < 200  # of 10,000 events
    assert "_bin" in final_plan(paired) and paired.columns == ["p", "day", "id", "anchor"]


def test_ladder_makes_no_hash_for_its_sort(spark):
    df = spark.createDataFrame(
        [(k % 5, d("2020-01-01"), "a", [(d("2020-01-01"), "x")]) for k in range(20)], "p int, extract date, area string, journal array<struct<day:date,c:string>>"
    )
    text = plan(latest.dedup_ladder(df, ["p"], "extract", "journal", "day", ["area"]))
    # The tree is printed from the top: hashes are made after the exchange and the first places only.
    assert text.count("Exchange") == 1 and text.count("WindowGroupLimit") == 3
    assert "xxhash64" in text[: text.index("Exchange")] and "xxhash64" not in text[text.index("Exchange") :]


def test_many_sides_meet_in_one_join(shuffled):
    """However many sides: one exchange for them, one for the frame, one join."""
    spark = shuffled
    people = spark.range(300).select((F.col("id") % 200).alias("a"), F.when(F.col("id") % 7 > 0, F.col("id") % 5).alias("b"), "id")
    keys = spark.range(0, 200, 2).select(F.col("id").alias("a"), (F.col("id") % 5).alias("b"))
    sides = [keys.where(f"a % {k + 2} = 0").select("a", "b", F.when(F.col("a") % 3 > 0, F.array(F.lit(k), F.col("a"))).alias(f"s{k}")) for k in range(6)]
    found = links.enrich_left(people, *sides, on=["a", "b"])
    text = plan(found)
    assert text.count("Exchange hash") == 2 and text.count("SortMergeJoin") == 1
    direct = people
    for side in sides:
        direct = direct.join(side, ["a", "b"], "left")
    assert rows(found) == rows(direct) and found.columns == direct.columns
    assert links.enrich_left(people, on=["a", "b"]).count() == links.enrich_left(people, sides[0], on=["a", "b"]).count() == 300
    with pytest.raises(ValueError):
        links.enrich_left(people, sides[0], sides[0], on=["a", "b"])
