"""Histories, counts and checks."""

from pyspark.sql import functions as F

from casebook.operators import history, quality
from casebook.sources.writers import hard_cache
from workload.registry import query
from workload.views import Tables, day

_CUT = "SELECT o_custkey, max(CAST(o_orderdate AS DATE)) AS cut FROM orders WHERE " \
       "o_orderpriority = '1-URGENT' GROUP BY o_custkey"


def _lines(t: Tables):
    """Order lines as events of a person: the return flag as flag, the line status as another."""
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("person"), day("l_shipdate").alias("record_start_date"),
        F.col("l_returnflag").alias("flag"), F.array("l_linestatus").alias("flag_assoc"),
    )


def _people(t: Tables):
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", day("o_orderdate"))
    cut = t.orders.groupBy(F.col("o_custkey").alias("person")).agg(F.max(urgent).alias("cut"))
    return t.customer.select(F.col("c_custkey").alias("person")).join(cut, ["person"], "left")


@query("conditional_history", f"""
    SELECT c_custkey AS person, CAST(cut AS VARCHAR) AS cut,
        count(*) FILTER (l_returnflag = 'R') AS returned_count,
        CAST(max(CAST(l_shipdate AS DATE)) FILTER (l_returnflag = 'R') AS VARCHAR)
            AS max_returned_date,
        count(*) FILTER (l_linestatus = 'O') AS open_count,
        CAST(max(CAST(l_shipdate AS DATE)) FILTER (l_linestatus = 'O') AS VARCHAR) AS max_open_date
    FROM customer LEFT JOIN ({_CUT}) ON c_custkey = o_custkey
    LEFT JOIN (SELECT orders.o_custkey AS owner, lineitem.* FROM lineitem
               JOIN orders ON l_orderkey = o_orderkey)
        ON c_custkey = owner AND (cut IS NULL OR CAST(l_shipdate AS DATE) <= cut)
    GROUP BY c_custkey, cut""")
def _(t: Tables):
    flags = {"returned": "R", "open": "O"}
    return history.conditional_history(_people(t), _lines(t), flags, "cut", ["person"])


@query("flags_before_death", f"""
    SELECT c_custkey AS person, CAST(cut AS VARCHAR) AS cut, flags FROM customer
    LEFT JOIN ({_CUT}) a ON c_custkey = a.o_custkey
    LEFT JOIN (
        SELECT o.o_custkey AS owner,
            coalesce(array_to_string(list_sort(list(DISTINCT nullif(l_returnflag, 'N'))
                FILTER (l_returnflag <> 'N')), ','), '') AS flags
        FROM lineitem JOIN orders o ON l_orderkey = o_orderkey JOIN ({_CUT}) c
            ON o.o_custkey = c.o_custkey
        WHERE CAST(l_shipdate AS DATE) >= cut - 30 AND CAST(l_shipdate AS DATE) < cut
        GROUP BY 1) ON c_custkey = owner""")
def _(t: Tables):
    lines = _lines(t).withColumn("flag", F.when(F.col("flag") != "N", F.col("flag")))
    return history.flags_before_death(_people(t), lines, "flags", "cut", ["person"])


@query("pivot_latest", """
    SELECT o_custkey, CAST(CAST(max(o_orderdate) FILTER (o_orderstatus = 'F') AS DATE) AS VARCHAR)
            AS "F",
        CAST(CAST(max(o_orderdate) FILTER (o_orderstatus = 'P') AS DATE) AS VARCHAR) AS "P",
        CAST(NULL AS VARCHAR) AS "X"
    FROM orders GROUP BY o_custkey""")
def _(t: Tables):
    rows = t.orders.select("o_custkey", "o_orderstatus", day("o_orderdate").alias("d"))
    return history.pivot_latest(rows, ["o_custkey"], "o_orderstatus", "d", ["F", "P", "X"])


# Clicks and views find a condition, errors and signups end it.
@query("resolved_latest", """
    SELECT f.user_id, f.diagnosis, CAST(f.day AS VARCHAR) AS day
    FROM (SELECT user_id, CASE event_type WHEN 'click' THEN 'AF' ELSE 'HTN' END AS diagnosis,
              max(CAST(ts AS DATE)) AS day
          FROM events WHERE event_type IN ('click', 'view') GROUP BY ALL) f
    LEFT JOIN (SELECT user_id, CASE event_type WHEN 'error' THEN 'AF' ELSE 'HTN' END AS diagnosis,
                   max(CAST(ts AS DATE)) AS ended
               FROM events WHERE event_type IN ('error', 'signup') GROUP BY ALL) r
        USING (user_id, diagnosis)
    WHERE ended IS NULL OR f.day >= ended""")
def _(t: Tables):
    rows = t.events.select(
        "user_id", day("ts").alias("day"), F.col("event_type").alias("cluster"),
        F.lit(None).cast("string").alias("code"),
    )
    return history.resolved_latest(
        rows, ["user_id"], day="day",
        conditions={"AF": ["click"], "HTN": ["view"]},
        resolutions={"AF": "error", "HTN": "signup"},
    )


@query("parent_max", """
    SELECT user_id, parent, event_type, CAST(max_date AS VARCHAR) AS max_date,
        CAST(max(max_date) OVER (PARTITION BY user_id, parent) AS VARCHAR) AS parent_date
    FROM (SELECT user_id, CASE WHEN event_type IN ('click', 'error') THEN 'AF' ELSE 'HTN' END
              AS parent, event_type, max(CAST(ts AS DATE)) AS max_date
          FROM events GROUP BY ALL)""")
def _(t: Tables):
    parent = F.when(F.col("event_type").isin("click", "error"), "AF").otherwise("HTN")
    rows = t.events.select("user_id", parent.alias("parent"), "event_type", day("ts").alias("d"))
    return history.parent_max(rows, ["user_id"], "parent", "event_type", "d", "parent_date")


@query("initial_people", """
    SELECT DISTINCT person_id, CAST(birth_date AS VARCHAR) AS birth_date FROM extract_rows""")
def _(t: Tables):
    return history.initial_people(t.extracts)


@query("distinct_rows", "SELECT DISTINCT l_partkey, l_returnflag FROM lineitem")
def _(t: Tables):
    return history.initial_people(t.lineitem, ["l_partkey", "l_returnflag"])


@query("rolling_daily", """
    SELECT CAST(day AS VARCHAR) AS day, n AS count,
        avg(n) OVER (ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)
            AS rolling
    FROM (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1)""")
def _(t: Tables):
    return history.rolling_daily(t.events.select(F.col("ts").alias("day")), "day", "rolling")


@query("unique_check", """
    SELECT 'line' AS what, count(*) = count(DISTINCT (l_orderkey, l_linenumber)) AS is_unique
    FROM lineitem
    UNION ALL
    SELECT 'order', count(*) = count(DISTINCT o_orderkey) FROM orders""")
def _(t: Tables):
    lines = quality.unique_check(t.lineitem, ["l_orderkey", "l_linenumber"])
    orders = quality.unique_check(t.orders, ["o_orderkey"])
    return lines.withColumn("what", F.lit("line")).unionByName(
        orders.withColumn("what", F.lit("order"))
    )


@query("max_entries_check", """
    SELECT max(n) <= 3 AS within_limit, max(n) AS largest
    FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey, o_orderstatus)""")
def _(t: Tables):
    return quality.max_entries_check(t.orders, ["o_custkey", "o_orderstatus"], 3)


@query("count_by", """
    SELECT 'event_type' AS criterion, event_type AS value, count(*) AS rows FROM events GROUP BY 2
    UNION ALL
    SELECT 'user_id', CAST(user_id AS VARCHAR), count(*) FROM events GROUP BY 2""")
def _(t: Tables):
    return quality.count_by(t.events, ["event_type", "user_id"])


@query("metrics", """
    SELECT 'orders' AS stage, 'counts' AS category, criteria, value FROM (
        SELECT 'col_count' AS criteria, '6' AS value
        UNION ALL SELECT 'row_count', CAST(count(*) AS VARCHAR) FROM orders
        UNION ALL SELECT 'distinct_person_count', CAST(count(DISTINCT o_custkey) AS VARCHAR)
                  FROM orders
        UNION ALL SELECT 'with_price', CAST(count(o_totalprice) AS VARCHAR) FROM orders
        UNION ALL SELECT 'urgent', CAST(count(*) FILTER (o_orderpriority = '1-URGENT') AS VARCHAR)
                  FROM orders
        UNION ALL SELECT 'latest', CAST(max(o_orderdate) AS VARCHAR) FROM orders
        UNION ALL SELECT 'o_orderstatus_' || o_orderstatus, CAST(count(*) AS VARCHAR) FROM orders
                  GROUP BY o_orderstatus)""")
def _(t: Tables):
    return quality.metrics(
        t.orders, "orders", ["o_custkey"], {"with_price": "o_totalprice"},
        {"urgent": F.col("o_orderpriority") == "1-URGENT"}, {"latest": "o_orderdate"},
        ["o_orderstatus"],
    )


def _gappy(t: Tables):
    """Episodes with a column of nulls and a column with some."""
    return t.admitted_records.select("record_id", "lsoa", F.lit(None).cast("int").alias("empty"))


@query("all_null_columns", "SELECT 'empty' AS column_name FROM lineitem HAVING count(*) > 0")
def _(t: Tables):
    return quality.all_null_columns(_gappy(t))


@query("nulls_in_required", """
    SELECT 'lsoa' AS column_name, count(*) AS nulls FROM admitted_records WHERE lsoa IS NULL""")
def _(t: Tables):
    return quality.nulls_in_required(_gappy(t), ["record_id", "lsoa"])


@query("value_set_diff", """
    SELECT event_type AS value, 'extra' AS status FROM events
    WHERE event_type NOT IN ('click', 'view') GROUP BY 1
    UNION ALL SELECT 'refund', 'missing' FROM events HAVING count(*) > 0""")
def _(t: Tables):
    return quality.value_set_diff(t.events, "event_type", ["click", "view", "refund"])


@query("is_empty", """
    SELECT 'all' AS what, count(*) = 0 AS is_empty FROM orders
    UNION ALL SELECT 'none', count(*) = 0 FROM orders WHERE o_orderstatus = 'missing'""")
def _(t: Tables):
    everything = quality.is_empty(t.orders).withColumn("what", F.lit("all"))
    nothing = quality.is_empty(t.orders.where("o_orderstatus = 'missing'"))
    return everything.unionByName(nothing.withColumn("what", F.lit("none")))


@query("people_sketches", """
    SELECT event_type AS kind, count(DISTINCT user_id) AS exact, true AS close FROM events GROUP BY 1
    UNION ALL SELECT 'all', count(DISTINCT user_id), true FROM events
    UNION ALL SELECT 'not click', count(DISTINCT user_id), true FROM events WHERE event_type <> 'click'""")
def _(t: Tables):
    """Distinct users by sketches of each month and kind, put together, within 3 % of the exact counts."""
    month = F.trunc(F.col("ts").cast("date"), "month").alias("month")
    events = t.events.select("event_type", "user_id", month)
    sketches = hard_cache(quality.people_sketches(events, ["month", "event_type"], ["user_id"]), "sketches")
    kinds = [F.col("event_type"), F.lit("all"), F.when(F.col("event_type") != "click", "not click")]
    kinds = F.explode(F.array(*kinds)).alias("kind")
    about = quality.people_of(sketches.select(kinds, "people").where("kind is not null"), ["kind"])
    exact = events.select(kinds, "user_id").where("kind is not null").groupBy("kind")
    exact = exact.agg(F.count_distinct("user_id").alias("exact"))
    close = F.abs(F.col("people") - F.col("exact")) <= 0.03 * F.col("exact")
    return exact.join(about, "kind").select("kind", "exact", close.alias("close"))
