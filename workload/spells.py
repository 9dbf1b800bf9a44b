"""Episodes (order lines) to spells (orders)."""

from pyspark.sql import functions as F

from casebook.constants import UNKNOWN_ETHNICITY
from casebook.operators import spells
from casebook.plans.events import episode_events
from casebook.plans.hospital import hospital_prep
from workload.registry import query
from workload.views import Tables
from workload.views_sql import VIEWS, _modal, age_at, spell_views, _UNKNOWN

# All prepared episodes, of eligible people or not.
VIEWS["bounded_episodes"] = """
    SELECT e.*, d.spell_start, d.spell_end
    FROM episodes_all e LEFT JOIN spell_dates d ON e.spell_id = d.spell_id"""
VIEWS["whole_spells"] = """
    SELECT * FROM bounded_episodes
    WHERE spell_id IS NOT NULL AND spell_start IS NOT NULL AND spell_end IS NOT NULL"""
spell_views("whole", "whole_spells")


def episodes(t: Tables):
    """Prepared episodes."""
    return hospital_prep(t.admitted, "admitted", "DIAG_4_01", "DIAG_4_CONCAT", admitted=True)


@query("spell_bounds", """
    SELECT a.record_id, nullif(a.spell_id, '-1') AS spell_id,
        CASE WHEN year(admission_date) > 1801 THEN CAST(admission_date AS VARCHAR) END
            AS admission_date,
        CASE WHEN year(discharge_date) > 1801 THEN CAST(discharge_date AS VARCHAR) END
            AS discharge_date,
        CAST(spell_start AS VARCHAR) AS spell_start, CAST(spell_end AS VARCHAR) AS spell_end
    FROM admitted_records a LEFT JOIN (
        SELECT spell_id, min(admission_date) FILTER (year(admission_date) > 1801) AS spell_start,
            max(discharge_date) FILTER (year(discharge_date) > 1801) AS spell_end
        FROM admitted_records WHERE spell_id <> '-1' GROUP BY spell_id) b
        ON a.spell_id = b.spell_id""")
def _(t: Tables):
    rows = t.admitted_records.select("record_id", "spell_id", "admission_date", "discharge_date")
    return spells.spell_bounds(rows)


@query("latest_value", """
    SELECT a.record_id, b.lsoa FROM admitted_records a LEFT JOIN (
        SELECT order_no, lsoa FROM (
            SELECT order_no, lsoa, row_number() OVER (PARTITION BY order_no
                ORDER BY record_start_date DESC, lsoa) AS place
            FROM admitted_records WHERE lsoa IS NOT NULL) WHERE place = 1) b
        ON a.order_no = b.order_no""")
def _(t: Tables):
    rows = t.admitted_records.select("record_id", "order_no", "record_start_date", "lsoa")
    latest = spells.latest_value(rows, ["order_no"], "lsoa", "record_start_date")
    return latest.select("record_id", "lsoa")


_BY_ORDER = """(SELECT order_no AS spell_id, record_id, record_start_date, ethnicity
    FROM admitted_records) AS by_order"""


@query("modal_value", f"""
    SELECT a.record_id, m.ethnicity FROM (SELECT record_id, order_no FROM admitted_records) a
    LEFT JOIN ({_modal(_BY_ORDER, 'ethnicity', _UNKNOWN)}) m ON a.order_no = m.spell_id""")
def _(t: Tables):
    rows = t.admitted_records.select("record_id", "order_no", "record_start_date", "ethnicity")
    modal = spells.modal_value(
        rows, ["order_no"], "ethnicity", "record_start_date", UNKNOWN_ETHNICITY
    )
    return modal.select("record_id", "ethnicity")


_WIDE = """spell_id, CAST(spell_start AS VARCHAR) AS spell_start,
    CAST(spell_end AS VARCHAR) AS spell_end, array_to_string(record_ids, ',') AS {ids},
    array_to_string(all_codes, ',') AS all_codes, lsoa, sex, dataset, person_id,
    CAST(birth_date AS VARCHAR) AS birth_date, ethnicity"""


@query("collapse_spell", f"""
    SELECT {_WIDE.format(ids='record_id')}, array_to_string(codes, ',') AS code,
        array_to_string(flags, ',') AS flag FROM whole_wide""")
def _(t: Tables):
    dated = episodes(t).na.drop(subset=["spell_id", "spell_start", "spell_end"])
    return spells.collapse_spell(dated)


@query("spell_members", """
    SELECT DISTINCT spell_id, record_id FROM episodes_all WHERE spell_id IS NOT NULL""")
def _(t: Tables):
    return spells.spell_members(episodes(t))


@query("summarise_multi", """
    SELECT user_id,
        CASE WHEN len(list_filter(kinds, lambda x: x <> 'NO_CVD')) > 1 THEN 'MULTIPLE'
             ELSE coalesce(list_filter(kinds, lambda x: x <> 'NO_CVD')[1], 'NO_CVD') END AS code,
        CASE WHEN len(days) > 1 THEN 'MULTIPLE' ELSE days[1] END AS flag,
        CASE WHEN len(kinds) > 1 THEN array_to_string(kinds, ',') END AS code_array,
        CASE WHEN len(days) > 1 THEN array_to_string(days, ',') END AS flag_assoc
    FROM (SELECT user_id, ts::DATE::VARCHAR AS day,
              list_sort(list(DISTINCT CASE event_type WHEN 'error' THEN 'NO_CVD'
                                      ELSE event_type END)) AS kinds,
              list_sort(list(DISTINCT hour(ts)::VARCHAR)) AS days
          FROM events GROUP BY ALL)""")
def _(t: Tables):
    kind = F.when(F.col("event_type") == "error", "NO_CVD").otherwise(F.col("event_type"))
    sets = t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.array_sort(F.collect_set(kind)).alias("code"),
        F.array_sort(F.collect_set(F.hour("ts").cast("string"))).alias("flag"),
    )
    return spells.summarise_multi(sets).drop("day")


@query("spell_pipeline", f"""
    SELECT {_WIDE.format(ids='record_id_assoc')}, code, flag,
        array_to_string(code_array, ',') AS code_array,
        array_to_string(flag_assoc, ',') AS flag_assoc
    FROM whole_summary""")
def _(t: Tables):
    return spells.spell_pipeline(episodes(t))


@query("job_episodes", f"""
    SELECT person_id, CAST(birth_date AS VARCHAR) AS birth_date,
        {age_at('birth_date', 'record_start_date')} AS age, sex, dataset, 'episode' AS category,
        record_id, CAST(record_start_date AS VARCHAR) AS record_start_date,
        CAST(record_end_date AS VARCHAR) AS record_end_date, lsoa, ethnicity, code, flag,
        array_to_string(code_array, ',') AS code_array, admission_method AS flag_assoc,
        CAST(NULL AS VARCHAR) AS record_id_assoc
    FROM episodes_all""")
def _(t: Tables):
    return episode_events(episodes(t))
