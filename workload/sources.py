"""Reading, writing, yearly tables, snapshots."""

from datetime import date

from pyspark.sql import functions as F

from casebook.operators import shaping
from casebook.session import shared_dir
from casebook.sources import readers, writers
from casebook.sources.published import Published
from workload.registry import query
from workload.views import Tables, day


def _order_years(t: Tables):
    """Orders per year in an old store and a new one, which has other names and covers less."""
    # Moved 20 years on so that both stores are used.
    year = F.year("o_orderdate") + 20
    suffix = F.format_string("%02d%02d", year % 100, (year + 1) % 100)
    rows = t.orders.select("o_orderkey", "o_custkey", day("o_orderdate").alias("ordered"), suffix.alias("orders"))
    old, new = shared_dir(t.spark, "old-store"), shared_dir(t.spark, "new-store")
    rows.withColumn("store", F.lit("old")).write.partitionBy("orders").parquet(old)
    moved = rows.where("orders >= '1920'").withColumnRenamed("o_custkey", "customer")
    moved.withColumn("store", F.lit("new")).write.partitionBy("orders").parquet(new)
    return readers.yearly_paths(t.spark, old, "orders"), readers.yearly_paths(t.spark, new, "orders")


@query("union_yearly", """
    SELECT o_orderkey, o_custkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS ordered,
        CASE WHEN year(o_orderdate) < 2001 THEN 'old' ELSE 'new' END AS store
    FROM orders WHERE year(o_orderdate) >= 1997""")
def _(t: Tables):
    old, new = _order_years(t)
    return readers.scan_yearly(t.spark, old, new, 17, 99, renames={"customer": "o_custkey"})


@query("union_all", """
    SELECT o_orderkey AS id, 'order' AS kind FROM orders
    UNION ALL SELECT l_orderkey, 'line' FROM lineitem
    UNION ALL SELECT event_id, 'event' FROM events""")
def _(t: Tables):
    return shaping.union_all(
        [
            t.orders.select(F.col("o_orderkey").alias("id"), F.lit("order").alias("kind")),
            t.lineitem.select(F.col("l_orderkey").alias("id"), F.lit("line").alias("kind")),
            t.events.select(F.lit("event").alias("kind"), F.col("event_id").alias("id")),
        ]
    )


@query("union_by_name", """
    SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier""")
def _(t: Tables):
    customers = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
    )
    suppliers = t.supplier.select(
        F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"),
        F.col("s_suppkey").alias("id"),
    )
    return shaping.union_all([customers, suppliers])


@query("latest_year", "SELECT CAST(max(year(o_orderdate)) AS INTEGER) AS latest_year FROM orders")
def _(t: Tables):
    return readers.latest_year(t.orders, F.year("o_orderdate"))


@query("latest_snapshot", """
    SELECT o_orderkey, CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS snapshot
    FROM orders
    WHERE date_trunc('month', o_orderdate) = (SELECT max(date_trunc('month', o_orderdate))
                                              FROM orders)""")
def _(t: Tables):
    name = F.concat(F.lit("extract_"), F.date_format(F.trunc("o_orderdate", "month"), "yyyy_MM_dd"))
    rows = t.orders.select("o_orderkey", readers.snapshot_date(name).alias("snapshot"))
    path = shared_dir(t.spark, "snapshots")
    rows.write.partitionBy("snapshot").parquet(path)
    return readers.newest_partition(t.spark, path, "snapshot")


@query("upsert", """
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN 'changed' ELSE o_orderstatus
        END AS o_orderstatus FROM orders
    UNION ALL
    SELECT -1 - o_orderkey, o_custkey, 'new' FROM orders WHERE o_orderstatus = 'O'
    UNION ALL
    SELECT NULL, o_custkey, 'unkeyed' FROM orders WHERE o_orderstatus = 'P'""")
def _(t: Tables):
    target = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    status, key = F.col("o_orderstatus"), F.col("o_orderkey")
    source = target.select(
        F.when(status == "F", key).when(status == "O", -1 - key).alias("o_orderkey"),
        "o_custkey",
        F.when(status == "F", "changed").when(status == "O", "new").otherwise("unkeyed")
        .alias("o_orderstatus"),
    )
    table = Published(t.spark, shared_dir(t.spark, "merged"))
    table.overwrite(target)
    return table.merge(source, ["o_orderkey"])


@query("sorted_arrays", """
    SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS kinds
    FROM events GROUP BY user_id""")
def _(t: Tables):
    kinds = F.array_sort(F.collect_set("event_type"))
    return t.events.groupBy("user_id").agg(kinds.alias("kinds"))


_PICKED = """SELECT o_custkey, d FROM (
    SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders)
    ORDER BY sha256(concat_ws('||', o_custkey, d)), o_custkey, d LIMIT {n}"""


@query("sample_cohort", f"""
    SELECT o_orderkey, o_custkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS d FROM orders
    WHERE (o_custkey, CAST(o_orderdate AS DATE)) IN ({_PICKED.format(n=1000)})""")
def _(t: Tables):
    rows = t.orders.select("o_orderkey", "o_custkey", day("o_orderdate").alias("d"))
    return readers.sample_cohort(rows, ["o_custkey", "d"], 1000)


@query("limit_n", """
    SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""")
def _(t: Tables):
    rows = t.orders.select("o_orderkey", "o_totalprice")
    return rows.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(100)


_ORDERS = """SELECT o_orderkey, o_custkey, o_orderstatus,
    CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS ordered FROM orders"""


def _orders(t: Tables):
    return t.orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", day("o_orderdate").alias("ordered")
    )


@query("read_source", "SELECT o_orderkey, o_custkey FROM orders")
def _(t: Tables):
    return readers.read_source(t.spark, f"{t.sf_dir}/orders.parquet", ["o_orderkey", "o_custkey"])


@query("read_csv_nulls", """
    SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name,
        CASE WHEN p_size > 25 THEN p_brand END AS p_brand FROM part""")
def _(t: Tables):
    brand = F.when(F.col("p_size") > 25, F.col("p_brand")).otherwise("")
    path = shared_dir(t.spark, "csv")
    rows = t.part.select("p_partkey", "p_name", brand.alias("p_brand"))
    rows.write.csv(path, header=True, emptyValue="")
    return readers.read_csv_nulls(t.spark, path, rows.columns)


@query("read_csv_rejects", """
    SELECT CAST(p_partkey AS VARCHAR) || ',' || p_brand || CASE WHEN p_size > 40 THEN ',x,y' ELSE '' END AS line,
        CASE WHEN p_size > 40 THEN 'more fields' ELSE 'fewer fields' END AS reason
    FROM part WHERE p_size > 25
    UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'row' FROM part WHERE p_size <= 25""")
def _(t: Tables):
    """Lines with two or four fields among those with three: rejects with their reasons, and rows."""
    key, size = F.col("p_partkey").cast("string"), F.col("p_size")
    fields = F.when(size > 40, F.array(key, "p_brand", F.lit("x"), F.lit("y"))).when(size > 25, F.array(key, "p_brand"))
    path = shared_dir(t.spark, "csv")
    lines = F.array_join(F.coalesce(fields, F.array(key, "p_brand", F.lit(""))), ",")
    t.part.select(lines.alias("line")).write.text(path)
    good, rejected = readers.read_csv_checked(t.spark, path, ["p_partkey", "p_brand", "rest"], header=False)
    return rejected.select("line", "reason").unionByName(good.select(F.col("p_partkey").alias("line"), F.lit("row").alias("reason")))


@query("write_table", _ORDERS)
def _(t: Tables):
    path = shared_dir(t.spark, "orders")
    return writers.write_table(_orders(t), path, partition_by=["o_orderstatus"])


@query("hard_cache", _ORDERS)
def _(t: Tables):
    return writers.hard_cache(_orders(t), "orders")


@query("compact", _ORDERS)
def _(t: Tables):
    table = Published(t.spark, shared_dir(t.spark, "compact"))
    table.overwrite(_orders(t).repartition(7), ["o_orderstatus"])
    return table.compact()


@query("merge_month", """
    SELECT o_orderkey, o_custkey, CASE WHEN month(o_orderdate) = 3 THEN 'changed' ELSE o_orderstatus END
        AS o_orderstatus, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders""")
def _(t: Tables):
    """Orders by month, into which changes of one month are merged: only its files are written anew."""
    month = F.month("o_orderdate").alias("month")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", month)
    table = Published(t.spark, shared_dir(t.spark, "by-month"))
    table.overwrite(orders, ["month"])
    changes = orders.where("month = 3").select("o_orderkey", "month", F.lit("changed").alias("o_orderstatus"))
    return table.merge(changes, ["o_orderkey", "month"])


@query("clone_table", _ORDERS)
def _(t: Tables):
    """A copy that shares the files of the table it was made from, whatever is written there later."""
    table = Published(t.spark, shared_dir(t.spark, "original"))
    table.overwrite(_orders(t), ["o_orderstatus"])
    copy = table.clone(shared_dir(t.spark, "copy"), deep=False)
    table.overwrite(_orders(t).limit(0), ["o_orderstatus"])
    return copy.read()


@query("archive_snapshot", _ORDERS)
def _(t: Tables):
    root = shared_dir(t.spark, "archive")
    path = writers.archive_path(root, "orders", date(2024, 1, 31), "1", "2")
    writers.archive_snapshot(_orders(t), path)
    return writers.archive_snapshot(_orders(t).limit(0), path)


@query("export_csv_ready", """
    SELECT record_id, replace(diag || ', ' || diag_2, ' ', '') AS codes, lsoa
    FROM admitted_records""")
def _(t: Tables):
    codes = F.split(F.regexp_replace("DIAG_4_CONCAT", " ", ""), ",").alias("codes")
    return writers.export_csv_ready(t.admitted_records.select("record_id", codes, "lsoa"))


@query("add_audit", """
    SELECT o_orderkey, '1.0' AS version, '2024-01-31' AS date, 3 AS stage_index,
        '{"limit": 5}' AS params, true AS in_range FROM orders""")
def _(t: Tables):
    rows = writers.add_audit(
        t.orders.select("o_orderkey"), "1.0", "7", date(2024, 1, 31), "db", 3, {"limit": 5}, ["a"]
    )
    sampling = F.col("META.sampling")
    return rows.select(
        "o_orderkey", "META.version", "META.date", "META.stage_index", "META.params",
        ((sampling >= 0) & (sampling < 1)).alias("in_range"),
    )
