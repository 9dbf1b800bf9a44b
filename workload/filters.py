"""Row filters over customers, orders, order lines and events."""

from datetime import date

from pyspark.sql import functions as F

from casebook.constants import OUTCOME_CODES
from casebook.operators import filters
from workload.registry import query
from workload.views import SMOKING, Tables, day, whole
from workload.views_sql import age, check_digit, sql_list, valid_id

_SMOKING_CODES = [code for codes in SMOKING.values() for code in codes]


@query("filter_values", """
    SELECT o_orderkey, o_orderpriority, 'kept' AS mode FROM orders
    WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
    UNION ALL
    SELECT o_orderkey, o_orderpriority, 'dropped' FROM orders WHERE o_orderpriority <> '5-LOW'""")
def _(t: Tables):
    rows = t.orders.select("o_orderkey", "o_orderpriority")
    kept = filters.filter_values(rows, "o_orderpriority", ["1-URGENT", "2-HIGH"])
    rest = filters.filter_values(rows, "o_orderpriority", "5-LOW", keep=False)
    return kept.withColumn("mode", F.lit("kept")).unionByName(
        rest.withColumn("mode", F.lit("dropped"))
    )


@query("filter_months", """
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS shipped
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE CAST(l_shipdate AS DATE) > CAST(o_orderdate AS DATE) + INTERVAL 3 MONTH""")
def _(t: Tables):
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", day("l_shipdate").alias("shipped"),
        day("o_orderdate").alias("ordered"),
    )
    return filters.filter_months(rows, "ordered", "shipped", 3, before=False).drop("ordered")


@query("valid_id", f"SELECT person_no, person_id FROM person WHERE {valid_id('person_id')}")
def _(t: Tables):
    return filters.keep_valid_ids(t.person.select("person_no", "person_id"), "person_id")


@query("drop_null_rows", """
    SELECT record_id, lsoa FROM admitted_records WHERE lsoa IS NOT NULL""")
def _(t: Tables):
    return filters.drop_null_rows(t.admitted_records.select("record_id", "lsoa"), "lsoa")


_BLANKED = """
    SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN '' WHEN '2-HIGH' THEN 'null'
        WHEN '3-MEDIUM' THEN NULL ELSE o_orderpriority END AS note FROM orders"""


def _blanked(t: Tables):
    priority = F.col("o_orderpriority")
    note = (
        F.when(priority == "1-URGENT", "").when(priority == "2-HIGH", "null")
        .when(priority != "3-MEDIUM", priority)
    )
    return t.orders.select("o_orderkey", note.alias("note"))


@query("drop_blank_rows", f"SELECT * FROM ({_BLANKED}) WHERE note NOT IN ('', 'null')")
def _(t: Tables):
    return filters.drop_blank_rows(_blanked(t), ["note"])


@query("clean_dataset", f"""
    SELECT person_no, person_id, sex, nullif(ethnicity, '') AS ethnicity FROM (
        SELECT *  REPLACE (CASE WHEN ethnicity = 'Z' THEN '' ELSE ethnicity END AS ethnicity,
                           CASE WHEN lsoa LIKE 'W%' THEN 'null' ELSE lsoa END AS lsoa)
        FROM person)
    WHERE lsoa <> 'null' AND {check_digit('person_id')}""")
def _(t: Tables):
    def blank(df):
        unknown = F.when(F.col("ethnicity") == "Z", "").otherwise(F.col("ethnicity"))
        area = F.when(F.col("lsoa").startswith("W"), "null").otherwise(F.col("lsoa"))
        return df.withColumns({"ethnicity": unknown, "lsoa": area})

    clean = filters.clean_dataset(t.person, ["person_id"], ["lsoa"], ["ethnicity"], blank)
    return clean.select("person_no", "person_id", "sex", "ethnicity")


@query("current_not_cancelled", """
    SELECT death_id FROM deaths_raw WHERE current_mark = 'True' AND cancelled = 'N'""")
def _(t: Tables):
    return filters.current_not_cancelled(t.deaths_raw, "current", "cancelled").select("death_id")


@query("region_filter", """
    SELECT death_id, residence, location FROM deaths_raw
    WHERE residence LIKE 'E%' OR (residence IS NULL AND location LIKE 'E%')""")
def _(t: Tables):
    kept = filters.region_filter(t.deaths_raw, "residence", "location")
    return kept.select("death_id", "residence", "location")


@query("plausible_dates", """
    SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS died FROM order_person
    WHERE o_orderdate >= birth_date + 20000
        AND CAST(o_orderdate AS DATE) BETWEEN DATE '1996-02-01' AND DATE '2000-11-30'""")
def _(t: Tables):
    rows = t.order_person.select(
        "o_orderkey", day("o_orderdate").alias("died"),
        F.date_add("birth_date", 20000).alias("born"),
    )
    kept = filters.plausible_dates(rows, "born", "died", date(1996, 2, 1), date(2000, 11, 30))
    return kept.drop("born")


@query("age_between", f"""
    SELECT o_orderkey FROM order_person
    WHERE {age('birth_date', 'CAST(o_orderdate AS DATE)')} BETWEEN 16 AND 120""")
def _(t: Tables):
    rows = t.order_person.select("o_orderkey", "birth_date", day("o_orderdate").alias("d"))
    return filters.age_between(rows, "birth_date", "d").select("o_orderkey")


@query("plausible_readings", f"""
    SELECT line_key, age, systolic, diastolic FROM (
        SELECT line_key, {age('birth_date', 'ship')} AS age, 60 + qty AS systolic,
            CASE WHEN l_linestatus = 'F' THEN 30 + qty END AS diastolic FROM line_person)
    WHERE age BETWEEN 18 AND 80 AND systolic >= 70 AND (diastolic IS NULL OR diastolic >= 50)""")
def _(t: Tables):
    quantity = whole("l_quantity")
    rows = t.line_person.select(
        "line_key", "birth_date", day("l_shipdate").alias("d"),
        (60 + quantity).alias("systolic"),
        F.when(F.col("l_linestatus") == "F", 30 + quantity).alias("diastolic"),
    )
    kept = filters.plausible_readings(
        rows, "birth_date", "d", "systolic", "diastolic",
        max_age=80, min_systolic=70, min_diastolic=50,
    )
    return kept.select("line_key", "age", "systolic", "diastolic")


@query("from_year", "SELECT o_orderkey FROM orders WHERE year(o_orderdate) >= 2000")
def _(t: Tables):
    rows = t.orders.select("o_orderkey", day("o_orderdate").alias("d"))
    return filters.from_year(rows, "d", 0).select("o_orderkey")


@query("prefix_region", "SELECT person_no, lsoa FROM person WHERE lsoa LIKE 'E%'")
def _(t: Tables):
    return filters.prefix_region(t.person.select("person_no", "lsoa"), "lsoa")


@query("array_code_filter", """
    SELECT record_id FROM (
        SELECT record_id, string_split(replace(diag || ', ' || diag_2, ' ', ''), ',') AS codes
        FROM admitted_records)
    WHERE len(list_filter(codes, lambda x: regexp_full_match(x, '(I21|I63|Z50)[0-9]?'))) > 0""")
def _(t: Tables):
    codes = F.split(F.regexp_replace("DIAG_4_CONCAT", " ", ""), ",").alias("codes")
    rows = t.admitted_records.select("record_id", codes)
    return filters.array_code_filter(rows, "codes", ["I21", "I63", "Z50"]).select("record_id")


_LISTED = [c for codes in OUTCOME_CODES.values() for c in codes]


@query("primary_code_filter", f"""
    SELECT record_id, substr(replace(diag, ' ', ''), 1, 3) AS code FROM admitted_records
    WHERE substr(replace(diag, ' ', ''), 1, 3) IN {sql_list(_LISTED)}""")
def _(t: Tables):
    code = F.substring(F.regexp_replace("DIAG_4_01", " ", ""), 1, 3).alias("code")
    return filters.primary_code_filter(t.admitted_records.select("record_id", code), "code")


@query("events_of", """
    SELECT event_id, user_id FROM events WHERE event_type = 'purchase'""")
def _(t: Tables):
    rows = t.events.select(
        "event_id", "user_id", F.lit("web").alias("dataset"), F.col("event_type").alias("category")
    )
    return filters.events_of(rows, "web", "purchase").select("event_id", "user_id")


@query("filter_by_codes", f"""
    SELECT line_key, code FROM entries WHERE code IN {sql_list(_SMOKING_CODES)}""")
def _(t: Tables):
    entries = t.extracts.select("meta_practice", F.explode("journal").alias("e"))
    rows = entries.select(F.col("meta_practice").alias("line_key"), "e.code")
    return filters.filter_values(rows, "code", _SMOKING_CODES)


@query("curate_events", """
    SELECT record_id, dataset, category, flag FROM (
        SELECT record_id, flag, dataset, CASE WHEN admission_method = '21' THEN 'episode'
            ELSE 'spell' END AS category FROM episodes_all WHERE flag <> 'NO_CVD'
        UNION ALL
        SELECT CAST(event_id AS VARCHAR), NULL, 'readings', 'bp' FROM events
        WHERE event_type = 'view')""")
def _(t: Tables):
    from casebook.plans.hospital import hospital_prep

    episodes = hospital_prep(t.admitted, "admitted", "DIAG_4_01", "DIAG_4_CONCAT", admitted=True)
    category = F.when(F.col("admission_method") == "21", "episode").otherwise("spell")
    hospital = episodes.select("record_id", "birth_date", "flag", "dataset", category.alias("category"))
    kind = F.col("event_type")
    web = t.events.select(
        F.col("event_id").cast("string").alias("record_id"),
        day("ts").alias("birth_date"), F.lit(None).cast("string").alias("flag"),
        F.when(kind == "error", "junk").otherwise("readings").alias("dataset"),
        F.when(kind == "view", "bp").otherwise("other").alias("category"),
    )
    return filters.curate_events(
        hospital.unionByName(web), ["admitted", "readings"], ["episode", "spell", "bp"], "admitted"
    )


