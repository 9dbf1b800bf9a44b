"""Joins between customers, orders, order lines and parts."""

from pyspark.sql import functions as F

from casebook.operators import links
from workload.registry import query
from workload.views import Tables, day

_SHIP, _ORDER = "CAST(l_shipdate AS DATE)", "CAST(o_orderdate AS DATE)"


@query("link_inner", """
    SELECT a.record_id, a.order_no, p.person_id, CAST(p.birth_date AS VARCHAR) AS birth_date
    FROM admitted_records a JOIN order_person p ON a.order_no = p.o_orderkey""")
def _(t: Tables):
    people = t.order_person.withColumnRenamed("o_orderkey", "order_no")
    return links.link_inner(
        t.admitted_records, people, ["order_no"], ["record_id", "order_no"],
        ["order_no", "person_id", "birth_date"],
    )


@query("link_left_checked", """
    SELECT o.o_orderkey, a.record_id, k.duplicate_keys FROM orders o
    LEFT JOIN admitted_records a ON o.o_orderkey = a.order_no
    CROSS JOIN (SELECT count(*) AS duplicate_keys FROM (
        SELECT order_no FROM admitted_records GROUP BY order_no HAVING count(*) > 1)) k""")
def _(t: Tables):
    rows = t.admitted_records.select(F.col("order_no").alias("o_orderkey"), "record_id")
    repeated = links.duplicate_keys(rows, ["o_orderkey"]).agg(F.count("*").alias("n"))
    linked = links.link_left(t.orders.select("o_orderkey"), rows, ["o_orderkey"])
    return linked.withColumn("duplicate_keys", repeated.scalar())


# A part name stands for several brands: the lookup fans out.
_REF = "SELECT DISTINCT p_name, p_brand FROM part WHERE p_size > 25"


@query("ref_lookup", f"""
    SELECT p.p_partkey, p.p_name, r.p_brand AS cluster FROM part p
    LEFT JOIN ({_REF}) r ON p.p_name = r.p_name""")
def _(t: Tables):
    active = F.when(F.col("p_size") > 25, 1).otherwise(0).alias("active")
    ref = t.part.select("p_name", F.col("p_brand").alias("cluster"), active).distinct()
    rows = t.part.select("p_partkey", "p_name")
    return links.ref_lookup(
        rows, ref.withColumnRenamed("p_name", "ref_code"), "p_name", "ref_code", "active"
    )


@query("ref_map_inner", """
    SELECT p.p_partkey, r.p_brand
    FROM part p JOIN (SELECT DISTINCT p_name, p_brand FROM part) r ON p.p_name = r.p_name""")
def _(t: Tables):
    ref = t.part.select(F.col("p_name").alias("ref_code"), "p_brand")
    rows = t.part.select("p_partkey", "p_name")
    return links.ref_map_inner(rows, ref, "p_name", "ref_code").drop("p_name")


@query("filter_by_frame", """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def _(t: Tables):
    wanted = t.customer.where("c_mktsegment = 'BUILDING'")
    rows = t.orders.select("o_orderkey", "o_custkey")
    return links.filter_by_frame(rows, wanted, {"c_custkey": "o_custkey"})


@query("eligible_only", """
    SELECT o_orderkey, person_id FROM order_person WHERE (person_id, birth_date) IN (
        SELECT person_id, birth_date FROM person WHERE lsoa LIKE 'E%' AND sex = '2')""")
def _(t: Tables):
    people = t.person.where("lsoa like 'E%' and sex = '2'")
    rows = t.order_person.select("o_orderkey", "person_id", "birth_date")
    return links.eligible_only(rows, people).drop("birth_date")


_CUTOFF = "SELECT o_custkey, max(CAST(o_orderdate AS DATE)) AS cutoff FROM orders " \
          "WHERE o_orderstatus = 'F' GROUP BY o_custkey"


@query("before_cutoff", f"""
    SELECT o_orderkey, CAST({_ORDER} AS VARCHAR) AS ordered, CAST(cutoff AS VARCHAR) AS cutoff,
        'strict' AS mode
    FROM orders LEFT JOIN ({_CUTOFF}) USING (o_custkey) WHERE {_ORDER} < cutoff
    UNION ALL
    SELECT o_orderkey, CAST({_ORDER} AS VARCHAR), CAST(cutoff AS VARCHAR), 'open'
    FROM orders LEFT JOIN ({_CUTOFF}) USING (o_custkey)
    WHERE {_ORDER} <= cutoff OR cutoff IS NULL""")
def _(t: Tables):
    rows = t.orders.select("o_custkey", "o_orderkey", day("o_orderdate").alias("ordered"))
    cutoffs = (
        t.orders.where("o_orderstatus = 'F'").groupBy("o_custkey")
        .agg(F.max(day("o_orderdate")).alias("cutoff"))
    )
    on = ["o_custkey"]
    strict = links.before_cutoff(rows, cutoffs, "ordered", "cutoff", on)
    loose = links.before_cutoff(rows, cutoffs, "ordered", "cutoff", on, True, True)
    both = strict.withColumn("mode", F.lit("strict")).unionByName(
        loose.withColumn("mode", F.lit("open"))
    )
    return both.drop("o_custkey")


@query("enrich_left", """
    SELECT c_custkey, n_orders, first_urgent FROM customer
    LEFT JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1) a
        ON c_custkey = a.o_custkey
    LEFT JOIN (SELECT o_custkey, min(o_orderkey) AS first_urgent FROM orders
               WHERE o_orderpriority = '1-URGENT' GROUP BY 1) b ON c_custkey = b.o_custkey""")
def _(t: Tables):
    orders = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    counts = orders.groupBy("c_custkey").agg(F.count("*").alias("n_orders"))
    urgent = orders.where("o_orderpriority = '1-URGENT'").groupBy("c_custkey")
    first = urgent.agg(F.min("o_orderkey").alias("first_urgent"))
    return links.enrich_left(t.customer.select("c_custkey"), counts, first, on=["c_custkey"])


_ANCHOR = f"SELECT o_custkey, max({_ORDER}) AS anchor FROM orders GROUP BY o_custkey"


def _lines_and_anchors(t: Tables):
    lines = t.line_person.select("o_custkey", "line_key", day("l_shipdate").alias("shipped"))
    anchors = t.orders.groupBy("o_custkey").agg(F.max(day("o_orderdate")).alias("anchor"))
    return lines, anchors


@query("window_within_months", f"""
    SELECT line_key, CAST(ship AS VARCHAR) AS shipped, CAST(anchor AS VARCHAR) AS anchor
    FROM line_person JOIN ({_ANCHOR}) USING (o_custkey)
    WHERE ship <= anchor AND ship >= anchor - INTERVAL 12 MONTH""")
def _(t: Tables):
    lines, anchors = _lines_and_anchors(t)
    return links.within_months(lines, anchors, "shipped", "anchor", ["o_custkey"]).drop("o_custkey")


@query("within_days_before", f"""
    SELECT line_key, CAST(ship AS VARCHAR) AS shipped, CAST(anchor AS VARCHAR) AS anchor
    FROM line_person JOIN ({_ANCHOR}) USING (o_custkey)
    WHERE ship >= anchor - 30 AND ship < anchor""")
def _(t: Tables):
    lines, anchors = _lines_and_anchors(t)
    return links.within_days(lines, anchors, "shipped", "anchor", ["o_custkey"]).drop("o_custkey")


