"""The views of ``views`` as SQL, by name, and a helper that puts the needed ones before a query."""

import re

from casebook.constants import (
    CARDIOVASCULAR_CODES,
    DIASTOLIC_CODES,
    OUTCOME_CODES,
    SYSTOLIC_CODES,
)
from workload.views import CLUSTER_ROWS, ETHNICITY_ROWS


def sql_list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


_digits = " + ".join(f"(ascii(substr(base, {i}, 1)) - 48) * {11 - i}" for i in range(1, 10))

# Age in whole years as the library counts it, and the valid-id rule on ten digits.
_id_sum = " + ".join(f"(ascii(substr({{0}}, {i}, 1)) - 48) * {11 - i}" for i in range(1, 10))


def age(birth: str, at: str) -> str:
    return (
        f"CASE WHEN {birth} <= {at} "
        f"THEN CAST(trunc(date_diff('day', {birth}, {at}) / 365.25) AS BIGINT) END"
    )


def age_at(birth: str, at: str) -> str:
    years = f"date_diff('day', {birth}, {at}) / 365.25"
    return f"CASE WHEN {birth} <= {at} AND {years} <= 130 THEN CAST(trunc({years}) AS BIGINT) END"


def check_digit(column: str) -> str:
    total = f"({_id_sum.format(column)}) % 11"
    return (
        f"(regexp_full_match({column}, '[0-9]{{10}}') AND "
        f"(CASE WHEN {total} = 0 THEN 0 ELSE 11 - {total} END) = ascii(substr({column}, 10, 1)) - 48)"
    )


def valid_id(column: str) -> str:
    same = " AND ".join(f"{column} <> '{str(d) * 10}'" for d in range(9))
    return f"({check_digit(column)} AND {same} AND {column} NOT LIKE '999%')"


def risk_band(age: str, sys: str, dia: str) -> str:
    return f"""CASE WHEN {sys} IS NULL OR {dia} IS NULL THEN NULL
        WHEN {age} < 80 AND {sys} BETWEEN 50 AND 140 AND {dia} BETWEEN 20 AND 90 THEN '0.1'
        WHEN {age} >= 80 AND {sys} BETWEEN 50 AND 150 AND {dia} BETWEEN 20 AND 90 THEN '0.2'
        WHEN {sys} > 180 OR {dia} > 120 THEN '1d'
        WHEN ({sys} > 160 AND {sys} <= 180) OR ({dia} > 100 AND {dia} <= 120) THEN '1c'
        WHEN {age} < 80 AND (({sys} > 140 AND {sys} <= 160) OR ({dia} > 90 AND {dia} <= 100)) THEN '1a'
        WHEN {age} >= 80 AND (({sys} > 150 AND {sys} <= 160) OR ({dia} > 90 AND {dia} <= 100)) THEN '1b'
        END"""


def outcome(code: str, default: str = "NULL") -> str:
    whens = " ".join(f"WHEN {code} IN {sql_list(c)} THEN '{f}'" for f, c in OUTCOME_CODES.items())
    return f"CASE {whens} ELSE {default} END"


VIEWS: dict[str, str] = {}

VIEWS["person_base"] = """
    SELECT *, CAST((CASE WHEN c_nationkey = 24 THEN 999000000 ELSE 400000000 END) + c_custkey
                   AS VARCHAR) AS base
    FROM customer"""
VIEWS["person"] = f"""
    SELECT c_custkey AS person_no,
        base || CAST(CASE WHEN ({_digits}) % 11 IN (0, 1) THEN 0 ELSE 11 - ({_digits}) % 11 END
                     AS VARCHAR) AS person_id,
        DATE '1905-01-01' + CAST(c_custkey * 37 % 32850 AS INTEGER) AS birth_date,
        CASE WHEN c_acctbal < 4500 THEN '1' ELSE '2' END AS sex,
        (CASE WHEN c_nationkey >= 20 THEN 'W' ELSE 'E' END)
            || lpad(CAST(c_nationkey AS VARCHAR), 8, '0') AS lsoa,
        CASE WHEN c_mktsegment LIKE 'F%' THEN 'Z' ELSE substr(c_mktsegment, 1, 1) END AS ethnicity
    FROM person_base"""
VIEWS["order_person"] = "SELECT * FROM orders JOIN person ON o_custkey = person_no"
VIEWS["line_person"] = """
    SELECT *, concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber,
                        CAST(l_quantity AS INTEGER), CAST(l_shipdate AS DATE)) AS line_key,
        CAST(l_quantity AS INTEGER) AS qty, CAST(l_shipdate AS DATE) AS ship
    FROM lineitem JOIN order_person ON l_orderkey = o_orderkey"""
VIEWS["entries"] = """
    SELECT line_key, ship AS journal_date,
        CASE l_linenumber WHEN 1 THEN '271649006' WHEN 2 THEN '271650006' WHEN 3 THEN '75367002'
            WHEN 4 THEN CASE l_returnflag WHEN 'A' THEN '49436004' WHEN 'N' THEN '196371000000102'
                        ELSE '398036000' END
            WHEN 5 THEN CASE l_returnflag WHEN 'A' THEN '38341003' WHEN 'N' THEN '162659009'
                        ELSE '431855005' END
            WHEN 6 THEN CASE l_returnflag WHEN 'A' THEN '230690007' WHEN 'N' THEN '44054006'
                        ELSE CASE WHEN l_linestatus = 'F' THEN '77176002' ELSE '8517006' END END
            ELSE CASE WHEN l_linestatus = 'F' THEN CASE l_returnflag WHEN 'A' THEN '92391000000108'
                      WHEN 'N' THEN '92411000000108' ELSE '92461000000105' END
                 ELSE '266919005' END END AS code,
        CAST(CASE l_linenumber WHEN 1 THEN CASE WHEN qty <= 2 THEN 40 ELSE 90 + 2 * qty END
            WHEN 2 THEN 50 + qty WHEN 3 THEN 100 + 2 * qty END AS VARCHAR) AS value1,
        CAST(CASE WHEN l_linenumber = 3 AND l_tax < 0.07 THEN 60 + qty END AS VARCHAR) AS value2
    FROM line_person WHERE l_tax > 0
    UNION ALL
    SELECT line_key, ship - qty, '75367002', CAST(110 + qty AS VARCHAR), CAST(70 + qty AS VARCHAR)
    FROM line_person WHERE l_returnflag <> 'N'
    UNION ALL
    SELECT line_key, ship - 30, '38341003', NULL, NULL
    FROM line_person WHERE l_linestatus = 'F' AND qty > 25"""
VIEWS["extract_rows"] = f"""
    SELECT p.person_id, p.birth_date, p.sex, p.lsoa, p.ethnicity, p.line_key AS meta_practice,
        CAST(date_trunc('quarter', p.ship + INTERVAL 3 MONTH) AS DATE) AS extract_date,
        CASE o_orderstatus WHEN 'F' THEN 'C01' WHEN 'O' THEN 'C02' ELSE 'C03' END AS cohort,
        o_orderpriority AS practice, CAST(p.ship AS VARCHAR) AS time_stamp,
        CAST(floor(date_diff('day', p.birth_date, p.ship) / 365.25) AS INTEGER) AS age,
        month(p.ship) AS ship_month, e.newest_entry, coalesce(e.n_entries, 0) AS n_entries
    FROM line_person p LEFT JOIN (
        SELECT line_key, max(journal_date) AS newest_entry, count(*) AS n_entries
        FROM entries GROUP BY line_key) e ON p.line_key = e.line_key"""
VIEWS["extract"] = """
    SELECT *, sha256(concat_ws('||', person_id, birth_date, extract_date, sex, practice, time_stamp,
                               meta_practice)) AS extract_id
    FROM extract_rows WHERE cohort IN ('C01', 'C02')"""
VIEWS["clean_extract"] = f"""
    SELECT * EXCLUDE (place) FROM (
        SELECT *, row_number() OVER (PARTITION BY person_id, birth_date, extract_date
            ORDER BY newest_entry DESC NULLS LAST, n_entries DESC, practice, sex, lsoa, ethnicity,
                     time_stamp, meta_practice) AS place
        FROM extract WHERE {valid_id('person_id')})
    WHERE place = 1 AND newest_entry IS NOT NULL"""
VIEWS["cluster_ref"] = f"SELECT * FROM (VALUES {CLUSTER_ROWS}) AS t(ref_code, cluster, active)"
VIEWS["ethnicity_ref"] = f"SELECT * FROM (VALUES {ETHNICITY_ROWS}) AS t(ref_code, ethnicity)"
VIEWS["journal_rows"] = """
    SELECT c.person_id, c.birth_date, c.cohort, c.extract_date, c.sex, c.lsoa, c.ethnicity,
        c.extract_id, e.journal_date, e.code, e.value1, e.value2
    FROM clean_extract c JOIN entries e ON c.meta_practice = e.line_key"""
VIEWS["journal"] = """
    SELECT j.* EXCLUDE (place), r.cluster,
        sha256(concat_ws('||', cohort, extract_date, code, journal_date, value1, value2, cluster,
                         extract_id)) AS journal_id
    FROM (SELECT *, row_number() OVER (
              PARTITION BY person_id, birth_date, journal_date, code, value1, value2
              ORDER BY extract_date DESC, extract_id) AS place FROM journal_rows) j
    LEFT JOIN (SELECT * FROM cluster_ref WHERE active = 1) r ON j.code = r.ref_code
    WHERE place = 1"""
VIEWS["admitted_records"] = """
    SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber,
                     CAST(l_quantity AS INTEGER), CAST(l_shipdate AS DATE)) AS record_id,
        l_orderkey AS order_no, CAST(l_shipdate AS DATE) AS record_start_date,
        CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) AS record_end_date,
        CASE p_type WHEN 'ECONOMY' THEN 'I21 9' WHEN 'LARGE' THEN 'I639' WHEN 'MEDIUM' THEN 'I50 0'
            WHEN 'PROMO' THEN 'J189' WHEN 'SMALL' THEN 'R69X' ELSE 'K52 ' END AS diag,
        CASE l_returnflag WHEN 'A' THEN 'I10X, E119' WHEN 'N' THEN 'Z501' ELSE 'I61' END AS diag_2,
        CASE WHEN p_size = 1 THEN DATE '1800-01-01' ELSE CAST(l_shipdate AS DATE) END
            AS admission_date,
        CASE WHEN p_size = 2 THEN DATE '1801-01-01'
            ELSE CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) END AS discharge_date,
        CASE WHEN l_linestatus = 'F' THEN '21' ELSE '11,2A' END AS admission_method,
        CASE WHEN p_size < 45 THEN 'E' || lpad(CAST(p_size AS VARCHAR), 8, '0') END AS lsoa,
        CASE WHEN l_returnflag = 'N' THEN 'Z' ELSE l_returnflag END AS ethnicity,
        CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN '-1'
            ELSE CAST(l_orderkey AS VARCHAR) END AS spell_id,
        p_size AS part_size, year(l_shipdate) + 20 AS fyear
    FROM lineitem JOIN part ON l_partkey = p_partkey"""
VIEWS["admitted"] = """
    SELECT a.* EXCLUDE (part_size, fyear, order_no),
        CASE WHEN part_size = 4 THEN '0000000000' ELSE p.person_id END AS person_id,
        CASE WHEN part_size = 3 THEN DATE '1801-01-01' ELSE p.birth_date END AS birth_date, p.sex
    FROM admitted_records a JOIN order_person p ON a.order_no = p.o_orderkey"""
VIEWS["episodes_all"] = f"""
    SELECT * EXCLUDE (diag, diag_2, admission_date, discharge_date, spell_id),
        substr(replace(diag, ' ', ''), 1, 4) AS code,
        string_split(replace(diag || ', ' || diag_2, ' ', ''), ',') AS code_array,
        coalesce({outcome("substr(replace(diag, ' ', ''), 1, 3)")},
            CASE WHEN len(list_filter(string_split(replace(diag || ', ' || diag_2, ' ', ''), ','),
                      lambda x: substr(x, 1, 3) IN {sql_list(CARDIOVASCULAR_CODES)})) > 0
                 THEN 'CVD_NON_PRIMARY' END, 'NO_CVD') AS flag,
        nullif(spell_id, '-1') AS spell_id,
        CASE WHEN year(admission_date) > 1801 THEN admission_date END AS admission_date,
        CASE WHEN year(discharge_date) > 1801 THEN discharge_date END AS discharge_date,
        'admitted' AS dataset
    FROM admitted WHERE replace(diag, ' ', '') <> 'R69X'"""
VIEWS["spell_dates"] = """
    SELECT spell_id, min(admission_date) AS spell_start, max(discharge_date) AS spell_end
    FROM episodes_all WHERE spell_id IS NOT NULL GROUP BY spell_id"""
VIEWS["people"] = "SELECT DISTINCT person_id, birth_date FROM clean_extract"
VIEWS["episodes"] = """
    SELECT e.*, d.spell_start, d.spell_end
    FROM episodes_all e LEFT JOIN spell_dates d ON e.spell_id = d.spell_id
    SEMI JOIN people p ON e.person_id = p.person_id AND e.birth_date = p.birth_date"""
VIEWS["spell_episodes"] = """
    SELECT * FROM episodes
    WHERE spell_id IS NOT NULL AND spell_start IS NOT NULL AND spell_end IS NOT NULL"""


def _modal(source: str, column: str, unwanted: str) -> str:
    return f"""
    SELECT spell_id, {column} FROM (
        SELECT spell_id, {column}, row_number() OVER (PARTITION BY spell_id
            ORDER BY count(*) DESC, min(record_start_date), {column} DESC) AS place
        FROM {source} WHERE {column} IS NOT NULL AND CAST({column} AS VARCHAR) NOT IN {unwanted}
        GROUP BY spell_id, {column}) WHERE place = 1"""


_UNKNOWN = "('Z', 'z', 'X', 'x', '99', '9', '', ' ')"
_BAD_IDS = sql_list(str(d) * 10 for d in range(9))
_BAD_DATES = "('1800-01-01', '1801-01-01', '9999-01-01')"


def spell_views(prefix: str, source: str) -> None:
    """Views that collapse the episodes of ``source`` to spells, named with ``prefix``."""
    VIEWS[f"{prefix}_person"] = _modal(source, "person_id", _BAD_IDS)
    VIEWS[f"{prefix}_birth"] = _modal(source, "birth_date", _BAD_DATES)
    VIEWS[f"{prefix}_ethnicity"] = _modal(source, "ethnicity", _UNKNOWN)
    VIEWS[f"{prefix}_lsoa"] = f"""
    SELECT spell_id, lsoa FROM (
        SELECT spell_id, lsoa, row_number() OVER (PARTITION BY spell_id
            ORDER BY record_start_date DESC, lsoa) AS place
        FROM {source} WHERE lsoa IS NOT NULL) WHERE place = 1"""
    VIEWS[f"{prefix}_sets"] = f"""
    SELECT spell_id, min(spell_start) AS spell_start, max(spell_end) AS spell_end,
        list_sort(list(DISTINCT record_id)) AS record_ids, list_sort(list(DISTINCT code)) AS codes,
        list_sort(list(DISTINCT flag)) AS flags,
        list_sort(list_distinct(flatten(list(code_array)))) AS all_codes,
        arg_min(sex, record_start_date::VARCHAR || record_id) AS sex,
        arg_min(dataset, record_start_date::VARCHAR || record_id) AS dataset
    FROM {source} GROUP BY spell_id"""
    VIEWS[f"{prefix}_wide"] = f"""
    SELECT s.*, l.lsoa, p.person_id, b.birth_date, e.ethnicity
    FROM {prefix}_sets s LEFT JOIN {prefix}_lsoa l USING (spell_id)
    LEFT JOIN {prefix}_person p USING (spell_id) LEFT JOIN {prefix}_birth b USING (spell_id)
    LEFT JOIN {prefix}_ethnicity e USING (spell_id)"""
    VIEWS[f"{prefix}_summary"] = f"""
    SELECT spell_id, spell_start, spell_end, record_ids, all_codes, sex, dataset, lsoa, person_id,
        birth_date, ethnicity,
        CASE WHEN len(codes) > 1 THEN codes END AS code_array,
        CASE WHEN len(flags) > 1 THEN flags END AS flag_assoc,
        CASE WHEN len(list_filter(codes, lambda x: x <> 'NO_CVD')) > 1 THEN 'MULTIPLE'
             ELSE coalesce(list_filter(codes, lambda x: x <> 'NO_CVD')[1], 'NO_CVD') END AS code,
        CASE WHEN len(list_filter(flags, lambda x: x <> 'NO_CVD')) > 1 THEN 'MULTIPLE'
             ELSE coalesce(list_filter(flags, lambda x: x <> 'NO_CVD')[1], 'NO_CVD') END AS flag
    FROM {prefix}_wide"""


spell_views("spell", "spell_episodes")

VIEWS["deaths_raw"] = """
    SELECT CAST(o_orderkey AS VARCHAR) AS death_id,
        CASE WHEN o_totalprice < 250000 THEN person_id END AS confirmed_id,
        CASE WHEN o_totalprice < 480000 THEN person_id END AS unconfirmed_id,
        birth_date, CAST(o_orderdate AS DATE) AS date_of_death,
        CAST(o_orderdate AS DATE) + CAST(floor(o_totalprice / 20000) AS INTEGER)
            AS registration_date, sex,
        CASE WHEN month(o_orderdate) <= 3 THEN 'I219' WHEN month(o_orderdate) <= 6 THEN 'I64'
             WHEN month(o_orderdate) <= 9 THEN 'I500' ELSE 'C349' END AS code,
        CASE WHEN o_totalprice > 60000 THEN lsoa END AS residence, lsoa AS location,
        o_totalprice > 100000 AS with_stroke, o_totalprice > 300000 AS with_other,
        CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' AND o_totalprice <= 450000
             THEN 'True' ELSE 'False' END AS current_mark,
        CASE WHEN o_totalprice < 20000 THEN 'Y' ELSE 'N' END AS cancelled
    FROM order_person"""


def _regex(codes) -> str:
    return "|".join(codes)


_flags = " ".join(
    f"WHEN regexp_matches(code, '^({_regex(c)})') THEN '{f}'"
    for f, c in reversed(list(OUTCOME_CODES.items()))
)
_assoc = ", ".join(
    f"CASE WHEN flag <> '{f}' AND regexp_matches(code_array, '{_regex(c)}') THEN 1 ELSE 0 END "
    f"AS flag_assoc_{f.lower()}"
    for f, c in OUTCOME_CODES.items()
)
VIEWS["deaths_one"] = """
    SELECT * EXCLUDE (place) FROM (
        SELECT *, coalesce(confirmed_id, unconfirmed_id) AS person_id,
            concat_ws(',', code, CASE WHEN with_stroke THEN 'I634' END,
                      CASE WHEN with_other THEN 'E119' END) AS code_array,
            row_number() OVER (PARTITION BY coalesce(confirmed_id, unconfirmed_id), birth_date
                ORDER BY date_of_death, registration_date DESC, death_id) AS place
        FROM deaths_raw
        WHERE coalesce(residence, location) LIKE 'E%' AND current_mark = 'True' AND cancelled = 'N'
            AND date_of_death >= birth_date
            AND date_of_death BETWEEN DATE '1990-01-01' AND DATE '2001-06-30'
            AND coalesce(confirmed_id, unconfirmed_id) IS NOT NULL) WHERE place = 1"""
VIEWS["deaths_all"] = f"""
    SELECT *, {_assoc} FROM (
        SELECT person_id, birth_date, 'deaths' AS dataset, sex, date_of_death,
            CASE {_flags} ELSE 'NON_CVD' END AS flag, code, code_array, residence, location,
            sha256(concat_ws('||', person_id, birth_date)) AS record_id,
            death_id AS record_id_assoc
        FROM deaths_one)"""
VIEWS["deaths"] = """
    SELECT * FROM deaths_all d
    SEMI JOIN people p ON d.person_id = p.person_id AND d.birth_date = p.birth_date"""
VIEWS["split_readings"] = f"""
    SELECT *, CASE WHEN pair OR code IN {sql_list(SYSTOLIC_CODES)} THEN CAST(value1 AS DOUBLE) END
            AS systolic,
        CASE WHEN pair THEN CAST(value2 AS DOUBLE)
             WHEN code IN {sql_list(DIASTOLIC_CODES)} THEN CAST(value1 AS DOUBLE) END AS diastolic
    FROM (SELECT *, cluster = 'BP_COD' AND value1 IS NOT NULL AND value2 IS NOT NULL AS pair
          FROM journal)
    WHERE pair OR (code IN {sql_list(SYSTOLIC_CODES + DIASTOLIC_CODES)}
                   AND value1 IS NOT NULL AND value2 IS NULL)"""
VIEWS["lowest_readings"] = f"""
    SELECT person_id, birth_date, extract_date, journal_date, min(systolic) AS systolic,
        min(diastolic) AS diastolic, min(age) AS age, min(cohort) AS cohort, min(sex) AS sex,
        min(lsoa) AS lsoa, min(ethnicity) AS ethnicity
    FROM (SELECT *, {age('birth_date', 'journal_date')} AS age FROM split_readings)
    WHERE age BETWEEN 18 AND 120 AND journal_date >= DATE '1997-01-01'
        AND (systolic IS NOT NULL OR diastolic IS NOT NULL)
        AND (systolic IS NULL OR systolic >= 50) AND (diastolic IS NULL OR diastolic >= 20)
    GROUP BY ALL HAVING min(systolic) IS NOT NULL AND min(diastolic) IS NOT NULL"""
VIEWS["readings"] = f"""
    SELECT * EXCLUDE (place), {risk_band('age', 'systolic', 'diastolic')} AS flag,
        sha256(concat_ws('||', person_id, birth_date, journal_date)) AS record_id,
        'readings' AS dataset
    FROM (SELECT *, rank() OVER (PARTITION BY person_id, birth_date, journal_date
                                 ORDER BY extract_date DESC) AS place FROM lowest_readings)
    WHERE place = 1"""
_CONDITION = """CASE cluster WHEN 'AFIB_COD' THEN 'AF' WHEN 'HYP_COD' THEN 'HTN'
        WHEN 'CKD_COD' THEN 'CKD' WHEN 'STRK_COD' THEN 'STROKE'
        WHEN 'DMTYPE2AUDIT_COD' THEN 'DIABETES'
        ELSE CASE WHEN code = '398036000' THEN 'FH' END END"""
VIEWS["mapped"] = f"""
    SELECT person_id, birth_date, journal_date, cluster, {_CONDITION} AS found,
        CASE cluster WHEN 'AFIBRES_COD' THEN 'AF' WHEN 'HYPRES_COD' THEN 'HTN' END AS ended
    FROM journal WHERE {age('birth_date', 'journal_date')} BETWEEN 16 AND 120"""
VIEWS["standing"] = """
    SELECT f.person_id, f.birth_date, f.diagnosis, f.journal_date
    FROM (SELECT person_id, birth_date, found AS diagnosis, max(journal_date) AS journal_date
          FROM mapped WHERE found IS NOT NULL GROUP BY ALL) f
    LEFT JOIN (SELECT person_id, birth_date, ended AS diagnosis, max(journal_date) AS ended_on
               FROM mapped WHERE ended IS NOT NULL GROUP BY ALL) r
        USING (person_id, birth_date, diagnosis)
    WHERE ended_on IS NULL OR journal_date >= ended_on"""
_PIVOT = ", ".join(
    f"max(CASE WHEN diagnosis = '{c}' THEN journal_date END) AS {c}_diagnosis_date"
    for c in ("AAA", "AF", "CKD", "STROKE", "DIABETES", "PAD", "FH", "CHD", "HTN", "HF", "TIA",
              "FHSCREEN", "NDH")
)
VIEWS["diagnoses"] = f"""
    SELECT * FROM (SELECT DISTINCT person_id, birth_date FROM journal)
    LEFT JOIN (SELECT person_id, birth_date, {_PIVOT} FROM standing GROUP BY ALL)
        USING (person_id, birth_date)"""
VIEWS["all_events"] = f"""
    SELECT person_id, birth_date, age, sex, 'cohort' AS dataset, 'cohort_extract' AS category,
        extract_id AS record_id, extract_date AS record_start_date,
        CAST(NULL AS DATE) AS record_end_date, lsoa, ethnicity, cohort AS code,
        CAST(NULL AS VARCHAR) AS flag, string_split(practice, ',') AS code_array,
        CAST(NULL AS VARCHAR[]) AS flag_assoc, CAST(NULL AS VARCHAR[]) AS record_id_assoc
    FROM clean_extract
    UNION ALL
    SELECT person_id, birth_date, {age_at('birth_date', 'record_start_date')}, sex, dataset,
        'episode', record_id, record_start_date, record_end_date, lsoa, ethnicity, code, flag,
        code_array, string_split(admission_method, ','), NULL
    FROM episodes
    UNION ALL
    SELECT person_id, birth_date, {age_at('birth_date', 'spell_start')}, sex, dataset, 'spell',
        'S_' || spell_id, spell_start, spell_end, lsoa, ethnicity, code, flag, code_array,
        flag_assoc, record_ids
    FROM spell_summary
    UNION ALL
    SELECT person_id, birth_date, {age_at('birth_date', 'date_of_death')}, sex, dataset, 'death',
        record_id, date_of_death, NULL, location, NULL, code, flag, string_split(code_array, ','),
        NULL, [record_id_assoc]
    FROM deaths
    UNION ALL
    SELECT person_id, birth_date, age, sex, dataset, 'bp', record_id, journal_date, extract_date,
        lsoa, ethnicity, CAST(CAST(systolic AS BIGINT) AS VARCHAR) || '/'
            || CAST(CAST(diastolic AS BIGINT) AS VARCHAR), flag,
        [CAST(CAST(systolic AS BIGINT) AS VARCHAR), CAST(CAST(diastolic AS BIGINT) AS VARCHAR)],
        NULL, NULL
    FROM readings"""
VIEWS["outpatient"] = """
    SELECT person_id, birth_date, 'outpatient' AS dataset,
        CAST(o_orderdate AS DATE) AS record_start_date,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'A' WHEN '2-HIGH' THEN 'B'
            WHEN '3-MEDIUM' THEN 'Z' WHEN '4-NOT SPECIFIED' THEN 'M' END AS ethnicity
    FROM order_person"""
VIEWS["emergency"] = """
    SELECT person_id, birth_date, 'emergency' AS dataset, CAST(ts AS DATE) AS record_start_date,
        CASE event_type WHEN 'click' THEN 'H' WHEN 'view' THEN '9' WHEN 'purchase' THEN 'B'
            WHEN 'signup' THEN 'A' ELSE '' END AS ethnicity
    FROM events JOIN person ON user_id = person_no"""
VIEWS["own_values"] = f"""
    SELECT person_id, birth_date, dataset, record_start_date,
        CASE WHEN count(DISTINCT ethnicity) = 1 THEN max(ethnicity) END AS ethnicity
    FROM (SELECT *, rank() OVER (PARTITION BY person_id, birth_date
                                 ORDER BY ethnicity IS NULL, record_start_date DESC) AS place
          FROM (SELECT * REPLACE (CASE WHEN ethnicity NOT IN {_UNKNOWN} THEN ethnicity END
                                  AS ethnicity)
                FROM all_events WHERE dataset = 'cohort'))
    WHERE place = 1 GROUP BY person_id, birth_date, dataset, record_start_date"""
VIEWS["candidates"] = f"""
    SELECT *, CASE dataset WHEN 'journal' THEN 1 WHEN 'admitted' THEN 2 WHEN 'emergency' THEN 3
        ELSE 4 END AS priority
    FROM (
        SELECT person_id, birth_date, 'journal' AS dataset, journal_date AS record_start_date,
            e.ethnicity
        FROM journal j JOIN ethnicity_ref e ON j.code = e.ref_code
        UNION ALL
        SELECT person_id, birth_date, dataset, record_start_date, ethnicity FROM episodes
        UNION ALL
        SELECT person_id, birth_date, dataset, record_start_date, ethnicity FROM emergency
        WHERE year(record_start_date) >= 2020
        UNION ALL
        SELECT person_id, birth_date, dataset, record_start_date, ethnicity FROM outpatient)
    WHERE ethnicity NOT IN {_UNKNOWN}"""
VIEWS["best_values"] = """
    SELECT person_id, birth_date, min(dataset) AS dataset, record_start_date,
        min(ethnicity) AS ethnicity
    FROM (SELECT *, rank() OVER (PARTITION BY person_id, birth_date
              ORDER BY record_start_date DESC, priority) AS place FROM candidates)
    WHERE place = 1 GROUP BY person_id, birth_date, record_start_date
    HAVING count(DISTINCT ethnicity) = 1"""
VIEWS["demographic"] = """
    SELECT *, 0 AS enhanced_ethnicity_flag FROM own_values WHERE ethnicity IS NOT NULL
    UNION ALL
    SELECT o.person_id, o.birth_date, b.dataset, b.record_start_date, b.ethnicity, 1
    FROM own_values o LEFT JOIN best_values b USING (person_id, birth_date)
    WHERE o.ethnicity IS NULL"""
VIEWS["patient_base"] = """
    SELECT person_id, birth_date, record_start_date AS latest_extract_date,
        array_to_string(code_array, '') AS latest_practice_identifier, sex, lsoa, code AS cohort
    FROM (SELECT *, rank() OVER (PARTITION BY person_id, birth_date
                                 ORDER BY record_start_date DESC) AS place
          FROM all_events WHERE dataset = 'cohort') WHERE place = 1"""
VIEWS["history"] = """
    SELECT e.person_id, e.birth_date,
        count(*) FILTER (stroke) AS stroke_count,
        max(record_start_date) FILTER (stroke) AS max_stroke_date,
        count(*) FILTER (mi) AS mi_count, max(record_start_date) FILTER (mi) AS max_mi_date
    FROM (SELECT *, flag = 'STROKE' OR coalesce(list_contains(flag_assoc, 'STROKE'), false)
                AS stroke,
              flag = 'HEARTATTACK' OR coalesce(list_contains(flag_assoc, 'HEARTATTACK'), false)
                AS mi
          FROM all_events WHERE category = 'spell') e
    LEFT JOIN deaths d USING (person_id, birth_date)
    WHERE date_of_death IS NULL OR record_start_date <= date_of_death
    GROUP BY e.person_id, e.birth_date"""
VIEWS["last_days"] = """
    SELECT person_id, birth_date,
        list_sort(list(DISTINCT e.flag) FILTER (e.flag IS NOT NULL)) AS flags
    FROM all_events e JOIN deaths d USING (person_id, birth_date)
    WHERE e.category = 'episode' AND e.record_start_date >= d.date_of_death - 30
        AND e.record_start_date < d.date_of_death
    GROUP BY person_id, birth_date"""
VIEWS["recent_risk"] = """
    SELECT person_id, birth_date, band FROM (
        SELECT e.person_id, e.birth_date, e.flag AS band,
            rank() OVER (PARTITION BY e.person_id, e.birth_date
                         ORDER BY record_start_date DESC) AS place
        FROM all_events e JOIN patient_base b USING (person_id, birth_date)
        WHERE e.category = 'bp' AND record_start_date <= latest_extract_date
            AND record_start_date >= latest_extract_date - INTERVAL 12 MONTH) WHERE place = 1"""
VIEWS["patients"] = f"""
    SELECT b.person_id, b.birth_date, latest_extract_date, latest_practice_identifier, b.sex,
        b.lsoa, b.cohort, m.ethnicity, g.* EXCLUDE (person_id, birth_date), d.date_of_death,
        d.flag AS death_flag,
        CASE WHEN {age('b.birth_date', 'd.date_of_death')} < 75 THEN 'DIED_UNDER_75' END
            AS death_age_flag,
        coalesce(stroke_count, 0) AS stroke_count, max_stroke_date,
        coalesce(mi_count, 0) AS mi_count, max_mi_date,
        l.flags AS died_within_30_days_hospitalisation_flags,
        CASE WHEN "HTN_diagnosis_date" IS NULL THEN '-1' ELSE coalesce(band, '1e') END
            AS hyp_risk_group
    FROM patient_base b
    LEFT JOIN demographic m USING (person_id, birth_date)
    LEFT JOIN deaths d USING (person_id, birth_date)
    LEFT JOIN diagnoses g USING (person_id, birth_date)
    LEFT JOIN history h USING (person_id, birth_date)
    LEFT JOIN last_days l USING (person_id, birth_date)
    LEFT JOIN recent_risk r USING (person_id, birth_date)"""


def with_views(query: str) -> str:
    """The query, preceded by the views it needs (and those they need) as CTEs."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in re.findall(r"\b(?:FROM|JOIN)\s+\(?\s*(\w+)", text):
            if name in VIEWS and name not in needed:
                needed.add(name)
                visit(VIEWS[name])

    visit(query)
    if not needed:
        return query
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({VIEWS[n]})" for n in VIEWS if n in needed)
    return f"WITH {ctes}\n{query}"
