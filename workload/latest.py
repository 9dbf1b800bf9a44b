"""Newest, first and unambiguous rows: orders, events, extracts."""

from pyspark.sql import functions as F

from casebook.constants import LINK
from casebook.operators import latest
from workload.registry import query
from workload.views import TIE_COLUMNS, Tables, day

_ORDER_DAY = "CAST(o_orderdate AS DATE)"


@query(
    "filter_latest",
    f"""SELECT o_custkey, o_orderkey, CAST({_ORDER_DAY} AS VARCHAR) AS latest_date FROM (
        SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY {_ORDER_DAY} DESC) AS place
        FROM orders) WHERE place = 1""",
)
def _(t: Tables):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return latest.keep_latest(rows, ["o_custkey"], "o_orderdate", "latest_date")


@query(
    "latest_version",
    f"""SELECT o_custkey, o_orderstatus, o_orderkey, CAST(version AS VARCHAR) AS version FROM (
        SELECT *, date_trunc('month', {_ORDER_DAY})::DATE AS version,
            rank() OVER (PARTITION BY o_custkey, o_orderstatus
                         ORDER BY date_trunc('month', {_ORDER_DAY}) DESC) AS place
        FROM orders) WHERE place = 1""",
)
def _(t: Tables):
    version = F.trunc(day("o_orderdate"), "month").alias("version")
    rows = t.orders.select("o_custkey", "o_orderstatus", "o_orderkey", version)
    return latest.latest_version(rows, ["o_custkey", "o_orderstatus"], "version")


# Appointments with an ethnicity, which is null for some and unknown for others.
@query(
    "latest_non_null",
    """SELECT person_id, CAST(birth_date AS VARCHAR) AS birth_date,
        CAST(record_start_date AS VARCHAR) AS record_start_date, ethnicity FROM (
        SELECT *, rank() OVER (PARTITION BY person_id, birth_date
                               ORDER BY record_start_date DESC) AS place
        FROM outpatient WHERE ethnicity IS NOT NULL) WHERE place = 1""",
)
def _(t: Tables):
    return latest.latest_non_null(t.outpatient, LINK, "record_start_date", "ethnicity")


@query(
    "latest_prefer_non_null",
    """SELECT person_id, CAST(birth_date AS VARCHAR) AS birth_date,
        CAST(record_start_date AS VARCHAR) AS record_start_date, ethnicity FROM (
        SELECT *, rank() OVER (PARTITION BY person_id, birth_date
                               ORDER BY ethnicity IS NULL, record_start_date DESC) AS place
        FROM outpatient) WHERE place = 1""",
)
def _(t: Tables):
    return latest.latest_prefer_non_null(t.outpatient, LINK, "record_start_date", "ethnicity")


# Two sources that meet on the same days: orders by month, and order lines by month.
_CANDIDATES = """
    SELECT o_custkey AS person, 'hospital' AS source, o_orderstatus AS value,
        CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders
    UNION ALL
    SELECT o_custkey, 'journal', l_returnflag, CAST(date_trunc('month', l_shipdate) AS DATE)
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def _candidates(t: Tables):
    orders = t.orders.select(
        F.col("o_custkey").alias("person"), F.lit("hospital").alias("source"),
        F.col("o_orderstatus").alias("value"), F.trunc(day("o_orderdate"), "month").alias("month"),
    )
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("person"), F.lit("journal").alias("source"),
        F.col("l_returnflag").alias("value"), F.trunc(day("l_shipdate"), "month").alias("month"),
    )
    return orders.unionByName(lines)


@query(
    "priority_source",
    f"""SELECT person, source, CAST(month AS VARCHAR) AS month, max(value) AS value FROM (
        SELECT *, rank() OVER (PARTITION BY person ORDER BY month DESC,
            CASE source WHEN 'journal' THEN 1 ELSE 2 END) AS place FROM ({_CANDIDATES}))
    WHERE place = 1 GROUP BY person, source, month HAVING count(DISTINCT value) = 1""",
)
def _(t: Tables):
    order = ["journal", "hospital"]
    return latest.priority_source(_candidates(t), ["person"], "month", "source", "value", order)


@query(
    "drop_conflicts",
    f"""SELECT person, CAST(month AS VARCHAR) AS month, max(value) AS value
    FROM ({_CANDIDATES}) GROUP BY ALL HAVING count(DISTINCT value) = 1""",
)
def _(t: Tables):
    return latest.drop_conflicts(_candidates(t), ["person", "month"], "value")


@query(
    "null_conflicts",
    f"""SELECT person, CAST(month AS VARCHAR) AS month,
        CASE WHEN count(DISTINCT value) = 1 THEN max(value) END AS value
    FROM ({_CANDIDATES}) GROUP BY person, month""",
)
def _(t: Tables):
    return latest.null_conflicts(_candidates(t), ["person", "month"], "value")


# The key without the extract date: the newest extract decides first.
@query(
    "dedup_ladder",
    """SELECT person_id, CAST(birth_date AS VARCHAR) AS birth_date, cohort,
        CAST(extract_date AS VARCHAR) AS extract_date, practice, meta_practice,
        n_entries AS entries FROM (
        SELECT *, row_number() OVER (PARTITION BY person_id, birth_date
            ORDER BY extract_date DESC, newest_entry DESC NULLS LAST, n_entries DESC, practice,
                     sex, lsoa, ethnicity, time_stamp, meta_practice) AS place
        FROM extract_rows) WHERE place = 1 AND newest_entry IS NOT NULL""",
)
def _(t: Tables):
    kept = latest.dedup_ladder(
        t.extracts, LINK, "extract_date", "journal", "journal_date", TIE_COLUMNS
    )
    columns = [*LINK, "cohort", "extract_date", "practice", "meta_practice"]
    return kept.select(*columns, F.size("journal").alias("entries"))


@query(
    "dedup_rank_then_key",
    f"""SELECT o_custkey, o_orderkey, CAST(died AS VARCHAR) AS died,
        CAST(registered AS VARCHAR) AS registered FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey
                                     ORDER BY died, registered DESC, o_orderkey) AS place
        FROM (SELECT *, CAST(date_trunc('quarter', {_ORDER_DAY}) AS DATE) AS died,
                  CAST(date_trunc('month', {_ORDER_DAY}) AS DATE) AS registered FROM orders))
    WHERE place = 1""",
)
def _(t: Tables):
    rows = t.orders.select(
        "o_custkey", "o_orderkey",
        F.trunc(day("o_orderdate"), "quarter").alias("died"),
        F.trunc(day("o_orderdate"), "month").alias("registered"),
    )
    return latest.dedup_deaths(rows, ["o_custkey"], "died", "registered", "o_orderkey")


# The key holds an array with nulls in it.
@query(
    "dedup_latest_entry",
    """SELECT person_id, code, value1, value2, CAST(journal_date AS VARCHAR) AS journal_date,
        CAST(extract_date AS VARCHAR) AS extract_date, meta_practice FROM (
        SELECT r.*, e.journal_date, e.code, e.value1, e.value2, row_number() OVER (
            PARTITION BY person_id, birth_date, journal_date, code, value1, value2
            ORDER BY extract_date DESC, meta_practice) AS place
        FROM extract_rows r JOIN entries e ON r.meta_practice = e.line_key) WHERE place = 1""",
)
def _(t: Tables):
    rows = t.extracts.select(
        *LINK, "extract_date", "meta_practice", F.explode("journal").alias("e")
    ).select(
        *LINK, "extract_date", "meta_practice", "e.journal_date", "e.code",
        F.array("e.value1", "e.value2").alias("code_array"),
    )
    keys = [*LINK, "journal_date", "code", "code_array"]
    kept = latest.dedup_latest_entry(rows, keys, "extract_date", ties=["meta_practice"])
    values = [F.get("code_array", F.lit(i)).alias(f"value{i + 1}") for i in range(2)]
    columns = ["person_id", "code", "journal_date", "extract_date", "meta_practice"]
    return kept.select(*columns, *values)


@query(
    "first_or_last_in_status",
    f"""SELECT o_custkey, o_orderstatus, which, o_orderkey,
        CAST(o_orderdate AS VARCHAR) AS o_orderdate FROM (
        SELECT o_custkey, o_orderstatus, o_orderkey, {_ORDER_DAY} AS o_orderdate, 'first' AS which,
            row_number() OVER (PARTITION BY o_custkey, o_orderstatus
                               ORDER BY {_ORDER_DAY}, o_orderkey) AS place FROM orders
        UNION ALL
        SELECT o_custkey, o_orderstatus, o_orderkey, {_ORDER_DAY}, 'last',
            row_number() OVER (PARTITION BY o_custkey, o_orderstatus
                               ORDER BY {_ORDER_DAY} DESC, o_orderkey) FROM orders)
    WHERE place = 1""",
)
def _(t: Tables):
    rows = t.orders.select(
        "o_custkey", "o_orderstatus", "o_orderkey", day("o_orderdate").alias("o_orderdate")
    )
    keys, ties = ["o_custkey", "o_orderstatus"], ["o_orderkey"]
    first = latest.first_or_last(rows, keys, "o_orderdate", last=False, ties=ties)
    last = latest.first_or_last(rows, keys, "o_orderdate", ties=ties)
    return first.withColumn("which", F.lit("first")).unionByName(
        last.withColumn("which", F.lit("last"))
    )


@query(
    "latest_with_start",
    f"""SELECT o_custkey, o_orderstatus, arg_max(o_orderkey, {{'d': {_ORDER_DAY}, 'k': o_orderkey}})
            AS o_orderkey,
        CAST(max({_ORDER_DAY}) AS VARCHAR) AS o_orderdate,
        CAST(min({_ORDER_DAY}) AS VARCHAR) AS started
    FROM orders GROUP BY o_custkey, o_orderstatus""",
)
def _(t: Tables):
    rows = t.orders.select(
        "o_custkey", "o_orderstatus", "o_orderkey", day("o_orderdate").alias("o_orderdate")
    )
    keys = ["o_custkey", "o_orderstatus"]
    return latest.latest_with_start(rows, keys, "o_orderdate", "started", ties=["o_orderkey"])


@query(
    "top_1_by_date",
    f"""SELECT o_orderkey, CAST({_ORDER_DAY} AS VARCHAR) AS o_orderdate FROM orders
    ORDER BY {_ORDER_DAY} DESC, o_orderkey LIMIT 1""",
)
def _(t: Tables):
    rows = t.orders.select("o_orderkey", day("o_orderdate").alias("o_orderdate"))
    return latest.top_by_date(rows, "o_orderdate", ties=["o_orderkey"])


