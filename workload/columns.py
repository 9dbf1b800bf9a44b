"""Renaming, typing, keys, codes and flags."""

from pyspark.sql import functions as F

from casebook.constants import CONDITIONS, OUTCOME_CODES, PLACEHOLDER_DATES
from casebook.functions import codes, dates, readings, values
from casebook.operators import history, shaping
from casebook.plans import deaths as deaths_plan
from casebook.plans import journal as journal_plan
from workload.registry import query
from workload.views import SMOKING, Tables, day, whole
from workload.views_sql import _assoc, _flags, age, age_at, risk_band, sql_list


@query("rename_map", "SELECT c_custkey AS person_no, c_name AS full_name FROM customer")
def _(t: Tables):
    rows = t.customer.select("c_custkey", "c_name")
    return shaping.rename_map(
        rows, {"c_custkey": "person_no", "c_name": "full_name", "absent": "ignored"}
    )


@query("add_source_label", "SELECT c_custkey, 'customer' AS dataset FROM customer")
def _(t: Tables):
    return shaping.add_source_label(t.customer.select("c_custkey"), "customer")


@query("unify_schema", """
    SELECT CAST(o_custkey AS VARCHAR) AS person_id, CAST(NULL AS VARCHAR) AS birth_date,
        CAST(NULL AS INTEGER) AS age, CAST(NULL AS VARCHAR) AS sex,
        'orders' AS dataset, o_orderstatus AS category, CAST(o_orderkey AS VARCHAR) AS record_id,
        CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS record_start_date,
        CAST(NULL AS VARCHAR) AS record_end_date, CAST(NULL AS VARCHAR) AS lsoa,
        CAST(NULL AS VARCHAR) AS ethnicity, o_orderpriority AS code, CAST(NULL AS VARCHAR) AS flag,
        replace(o_orderpriority, '-', ',') AS code_array, CAST(NULL AS VARCHAR) AS flag_assoc,
        CAST(NULL AS VARCHAR) AS record_id_assoc
    FROM orders""")
def _(t: Tables):
    return shaping.unify_schema(
        t.orders,
        {
            "person_id": "o_custkey",
            "dataset": F.lit("orders"),
            "category": "o_orderstatus",
            "record_id": "o_orderkey",
            "record_start_date": "o_orderdate",
            "record_end_date": None,
            "code": "o_orderpriority",
            "code_array": F.split("o_orderpriority", "-"),
        },
    )


@query("ensure_types", """
    SELECT event_id, CAST(user_id AS SMALLINT) AS user_id,
        TRY_CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k,
        CAST(NULL AS INTEGER) AS event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS ts FROM events""")
def _(t: Tables):
    rows = t.events.select(
        "event_id", "user_id", F.regexp_extract("props", "[0-9]+", 0).alias("k"), "event_type", "ts"
    )
    return shaping.ensure_types(
        rows, {"user_id": "short", "k": "int", "event_type": "int", "ts": "date"}
    )


_TEXT_DATE = """CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y%m%d')
        WHEN 'O' THEN strftime(o_orderdate, '%Y-%m-%d') ELSE 'not a date' END"""


@query("parse_date", f"""
    SELECT o_orderkey, text, CASE WHEN text <> 'not a date'
        THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS parsed,
        CASE WHEN text <> 'not a date' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS cut
    FROM (SELECT *, {_TEXT_DATE} AS text FROM orders)""")
def _(t: Tables):
    status, at = F.col("o_orderstatus"), F.col("o_orderdate")
    text = (
        F.when(status == "F", F.date_format(at, "yyyyMMdd"))
        .when(status == "O", F.date_format(at, "yyyy-MM-dd"))
        .otherwise("not a date")
    )
    rows = t.orders.select("o_orderkey", text.alias("text"))
    return rows.withColumns(
        {
            "parsed": dates.parse_date(F.col("text")),
            "cut": dates.parse_date(F.concat("text", F.lit("+01")), end_trim=3),
        }
    )


@query("null_if_in", """
    SELECT record_id,
        CASE WHEN year(admission_date) > 1801 THEN CAST(admission_date AS VARCHAR) END
            AS admission_date,
        CASE WHEN year(discharge_date) > 1801 THEN CAST(discharge_date AS VARCHAR) END
            AS discharge_date
    FROM admitted_records""")
def _(t: Tables):
    rows = t.admitted_records.select("record_id", "admission_date", "discharge_date")
    return shaping.null_if_in(rows, ["admission_date", "discharge_date"], [*PLACEHOLDER_DATES])


@query("null_if_blank", """
    SELECT o_orderkey, CASE WHEN o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW')
        THEN o_orderpriority END AS note FROM orders""")
def _(t: Tables):
    priority = F.col("o_orderpriority")
    note = (
        F.when(priority == "1-URGENT", "").when(priority == "2-HIGH", "Null")
        .when(priority == "3-MEDIUM", "NULL").otherwise(priority)
    )
    return t.orders.select("o_orderkey", values.null_if_blank(note).alias("note"))


@query("coalesce_id", """
    SELECT death_id, coalesce(confirmed_id, unconfirmed_id) AS person_id FROM deaths_raw
    WHERE confirmed_id IS NOT NULL OR unconfirmed_id IS NOT NULL""")
def _(t: Tables):
    rows = t.deaths_raw.select("death_id", "confirmed_id", "unconfirmed_id")
    return shaping.coalesce_id(rows, "person_id", "confirmed_id", "unconfirmed_id")


@query("hash_key", """
    SELECT record_id, sha256(concat_ws('||', record_id, record_start_date, lsoa, admission_method))
        AS key,
        sha256(concat_ws('||', record_id, coalesce(lsoa, '?'))) AS strict_key
    FROM admitted_records""")
def _(t: Tables):
    key = values.hash_key(
        "record_id", "record_start_date", "lsoa", F.split("admission_method", "\\|\\|")
    )
    strict = values.hash_key("record_id", "lsoa", null_token="?")
    return t.admitted_records.select("record_id", key.alias("key"), strict.alias("strict_key"))


@query("make_array", """
    SELECT o_orderkey, o_orderstatus || ',' || o_orderpriority AS labels FROM orders""")
def _(t: Tables):
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return shaping.make_array(rows, "labels", ["o_orderstatus", "o_orderpriority"])


@query("split_to_array", """
    SELECT record_id, len(string_split(admission_method, ',')) AS methods,
        replace(diag || ', ' || diag_2, ' ', '') AS codes FROM admitted_records""")
def _(t: Tables):
    rows = t.admitted_records.select("record_id", "admission_method", "DIAG_4_CONCAT")
    split = shaping.split_to_array(rows, "admission_method")
    return split.select(
        "record_id", F.size("admission_method").alias("methods"),
        values.split_codes(F.col("DIAG_4_CONCAT")).alias("codes"),
    )


@query("concat_code_columns", """
    SELECT p_partkey, concat_ws(',', p_type, CASE WHEN p_size > 25 THEN p_brand END, p_name)
        AS codes FROM part""")
def _(t: Tables):
    numbered = {f"DIAG{i:02d}": F.lit(None).cast("string") for i in range(1, 13)}
    numbered["DIAG01"] = F.col("p_type")
    numbered["DIAG02"] = F.when(F.col("p_size") > 25, F.col("p_brand"))
    numbered["DIAG12"] = F.col("p_name")
    wide = t.part.select("p_partkey", *(c.alias(n) for n, c in numbered.items()))
    return shaping.concat_code_columns(wide, "codes", "DIAG").select("p_partkey", "codes")


@query("code_map", """
    SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'cheap' WHEN 'PROMO' THEN 'special'
        WHEN 'SMALL' THEN 'special' END AS flag FROM part""")
def _(t: Tables):
    flags = {"cheap": ["ECONOMY", "PROMO"], "special": ["PROMO", "SMALL"]}
    return t.part.select("p_partkey", codes.code_map(F.col("p_type"), flags).alias("flag"))


@query("normalise_code", """
    SELECT record_id, substr(replace(diag, ' ', ''), 1, 3) AS code,
        substr(replace(diag, ' ', ''), 1, 4) AS code_full
    FROM admitted_records WHERE replace(diag, ' ', '') <> 'R69X'""")
def _(t: Tables):
    rows = t.admitted_records.select("record_id", "DIAG_4_01")
    clean = shaping.normalise_code(rows, "DIAG_4_01", "R69X")
    return clean.withColumnsRenamed({"DIAG_4_01": "code", "DIAG_4_01_full": "code_full"})


@query("generalise_date", """
    SELECT person_no, CAST(year(birth_date) AS VARCHAR) AS birth_year FROM person""")
def _(t: Tables):
    return shaping.generalise_birth_date(t.person.select("person_no", "birth_date"))


@query("fill_missing_columns", """
    SELECT o_custkey, CAST(NULL AS VARCHAR) AS "AAA_on",
        CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS "AF_on",
        CAST(NULL AS VARCHAR) AS "CKD_on" FROM orders GROUP BY o_custkey""")
def _(t: Tables):
    newest = t.orders.groupBy("o_custkey").agg(F.max(day("o_orderdate")).alias("AF"))
    return shaping.fill_missing_columns(newest, CONDITIONS[:3], "_on")


@query("age_at", f"""
    SELECT line_key, {age('birth_date', 'ship')} AS years,
        {age_at('birth_date', "CAST(ship + INTERVAL 60 YEAR AS DATE)")} AS later,
        {age('ship', 'birth_date')} AS backwards
    FROM line_person""")
def _(t: Tables):
    birth, ship = F.col("birth_date"), day("l_shipdate")
    return t.line_person.select(
        "line_key", dates.age_years(birth, ship).alias("years"),
        dates.age_at(birth, F.add_months(ship, 720)).alias("later"),
        dates.age_years(ship, birth).alias("backwards"),
    )


@query("under_age_flag", f"""
    SELECT o_orderkey, CASE WHEN {age('birth_date', 'CAST(o_orderdate AS DATE)')} < 75
            THEN 'UNDER' END AS flag,
        CASE WHEN {age('birth_date', 'CAST(o_orderdate AS DATE)')} < 75 AND o_orderstatus <> 'P'
            THEN 'UNDER' END AS checked_flag
    FROM order_person""")
def _(t: Tables):
    birth, at = F.col("birth_date"), day("o_orderdate")
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    return t.order_person.select(
        "o_orderkey", dates.under_age_label(birth, at, 75, "UNDER").alias("flag"),
        dates.under_age_label(birth, at, 75, "UNDER", status).alias("checked_flag"),
    )


# Flags.
@query("flag_by_primary_or_any", "SELECT record_id, flag FROM episodes_all")
def _(t: Tables):
    rows = shaping.normalise_code(t.admitted_records, "DIAG_4_01", "R69X")
    listed = values.split_codes(F.col("DIAG_4_CONCAT"))
    flag = codes.flag_by_primary_or_any(F.col("DIAG_4_01"), listed)
    return rows.select("record_id", flag.alias("flag"))


@query("flag_by_prefix", f"""
    SELECT death_id, CASE {_flags} ELSE 'NON_CVD' END AS flag FROM deaths_raw""")
def _(t: Tables):
    flag = codes.flag_by_prefix(F.col("code"), OUTCOME_CODES)
    return t.deaths_raw.select("death_id", flag.alias("flag"))


@query("assoc_flags", f"""
    SELECT death_id, {_assoc} FROM (
        SELECT *, CASE {_flags} ELSE 'NON_CVD' END AS flag,
            concat_ws(',', code, CASE WHEN with_stroke THEN 'I634' END,
                      CASE WHEN with_other THEN 'E119' END) AS code_array FROM deaths_raw)""")
def _(t: Tables):
    flagged = deaths_plan.cause_flags(t.deaths_raw)
    return flagged.select("death_id", *(f"flag_assoc_{f.lower()}" for f in OUTCOME_CODES))


def _entries(t: Tables):
    """Journal entries with their value array."""
    rows = t.extracts.select("meta_practice", F.explode("journal").alias("e")).select(
        F.col("meta_practice").alias("line_key"), "e.*"
    )
    return shaping.make_array(rows, "code_array", ["value1", "value2"])


@query("bp_split_single", f"""
    SELECT line_key, CAST(journal_date AS VARCHAR) AS journal_date, code,
        CASE WHEN code = '271649006' THEN CAST(value1 AS DOUBLE) END AS systolic,
        CASE WHEN code <> '271649006' THEN CAST(value1 AS DOUBLE) END AS diastolic
    FROM entries WHERE code IN {sql_list(['271649006', '271650006'])} AND value1 IS NOT NULL""")
def _(t: Tables):
    rows = _entries(t).withColumn("cluster", F.lit(None).cast("string"))
    columns = ["line_key", "journal_date", "code", "systolic", "diastolic"]
    return journal_plan.split_readings(rows).select(*columns)


@query("bp_split_pair", """
    SELECT line_key, CAST(journal_date AS VARCHAR) AS journal_date,
        CAST(value1 AS DOUBLE) AS systolic, CAST(value2 AS DOUBLE) AS diastolic
    FROM entries WHERE code = '75367002' AND value1 IS NOT NULL AND value2 IS NOT NULL""")
def _(t: Tables):
    cluster = F.when(F.col("code") == "75367002", "BP_COD")
    rows = _entries(t).withColumn("cluster", cluster)
    pairs = journal_plan.split_readings(rows, systolic_codes=[], diastolic_codes=[])
    return pairs.select("line_key", "journal_date", "systolic", "diastolic")


_BAND = risk_band(age("birth_date", "ship"), "(60 + 3 * qty)", "(40 + 2 * qty)")


@query("risk_band", f"SELECT line_key, {_BAND} AS band FROM line_person")
def _(t: Tables):
    quantity, years = whole("l_quantity"), dates.age_years(F.col("birth_date"), day("l_shipdate"))
    band = readings.risk_band(years, 60 + 3 * quantity, 40 + 2 * quantity)
    return t.line_person.select("line_key", band.alias("band"))


@query("risk_default", f"""
    SELECT line_key, CASE WHEN l_returnflag = 'N' THEN '-1' ELSE coalesce({_BAND}, '1e') END
        AS band FROM line_person""")
def _(t: Tables):
    quantity, years = whole("l_quantity"), dates.age_years(F.col("birth_date"), day("l_shipdate"))
    band = readings.risk_band(years, 60 + 3 * quantity, 40 + 2 * quantity)
    diagnosed = F.when(F.col("l_returnflag") != "N", day("l_shipdate"))
    return t.line_person.select("line_key", readings.risk_default(diagnosed, band).alias("band"))


@query("smoking_status", """
    SELECT line_key, CAST(journal_date AS VARCHAR) AS journal_date, code,
        CASE code WHEN '77176002' THEN 'current' WHEN '8517006' THEN 'ex'
            WHEN '266919005' THEN 'never' END AS status
    FROM entries""")
def _(t: Tables):
    status = readings.smoking_status(F.col("code"), SMOKING)
    return _entries(t).select("line_key", "journal_date", "code", status.alias("status"))


@query("priority_rank", """
    SELECT event_id, CASE event_type WHEN 'purchase' THEN 1 WHEN 'click' THEN 2 WHEN 'view' THEN 3
        ELSE 4 END AS place FROM events""")
def _(t: Tables):
    place = readings.priority_rank(F.col("event_type"), ["purchase", "click", "view"])
    return t.events.select("event_id", place.alias("place"))


# Per-person readings and diagnoses over events.
@query("min_pair", """
    SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
        min(value) FILTER (event_type = 'click') AS systolic,
        min(value) FILTER (event_type = 'view') AS diastolic
    FROM events GROUP BY user_id, CAST(ts AS DATE)
    HAVING count(*) FILTER (event_type = 'click') > 0 AND count(*) FILTER (event_type = 'view') > 0
    """)
def _(t: Tables):
    kind = F.col("event_type")
    rows = t.events.select(
        "user_id", day("ts").alias("day"), F.when(kind == "click", F.col("value")).alias("systolic"),
        F.when(kind == "view", F.col("value")).alias("diastolic"),
    )
    return history.min_pair(rows, ["user_id", "day"], "systolic", "diastolic")


