"""The composite jobs over the given tables."""

from pyspark.sql import functions as F

from casebook.constants import CONDITIONS, LINK
from casebook.plans import cohort, curation, deaths, demographic, events, journal, patient, report
from casebook.plans.hospital import hospital_extract, hospital_prep
from casebook.plans.labels import LABELS
from casebook.plans.patient import PATIENT_SCHEMA
from casebook.plans.run import Run
from casebook.sources.readers import by_year
from casebook.sources.writers import hard_cache
from workload.registry import query
from workload.views import (
    COHORTS,
    EXTRACT_KEY,
    FIRST_READING,
    LAST_DEATH,
    SMOKING,
    TIE_COLUMNS,
    Tables,
)
from workload.views_sql import age

EMERGENCY_FROM = 20


def run(t: Tables) -> Run:
    """A run over the given tables; a product is written when it is asked for."""
    return Run(
        t.sources, COHORTS, EXTRACT_KEY, LAST_DEATH, EMERGENCY_FROM, FIRST_READING, TIE_COLUMNS
    )


@query("job_extract", """
    SELECT person_id, CAST(birth_date AS VARCHAR) AS birth_date, cohort,
        CAST(extract_date AS VARCHAR) AS extract_date, practice, extract_id,
        n_entries AS entries FROM extract""")
def _(t: Tables):
    rows = cohort.extract(t.annual, t.quarterly, COHORTS, EXTRACT_KEY)
    return rows.select(
        *LINK, "cohort", "extract_date", "practice", "extract_id", F.size("journal").alias("entries")
    )


@query("job_cohort", """
    SELECT person_id, CAST(birth_date AS VARCHAR) AS birth_date, practice, cohort,
        CAST(extract_date AS VARCHAR) AS extract_date, age, sex, lsoa, ethnicity,
        extract_id AS cohort_id FROM clean_extract""")
def _(t: Tables):
    clean = cohort.clean_extract(run(t).extract, tie_columns=TIE_COLUMNS, key_columns=EXTRACT_KEY)
    return cohort.cohort_table(clean)


@query("job_journal", """
    SELECT person_id, CAST(birth_date AS VARCHAR) AS birth_date, cohort,
        CAST(extract_date AS VARCHAR) AS extract_date, code,
        CAST(journal_date AS VARCHAR) AS journal_date, sex, lsoa, ethnicity,
        concat_ws(',', value1, value2) AS code_array, cluster, journal_id FROM journal""")
def _(t: Tables):
    return cohort.journal_table(run(t).clean_extract, t.cluster_ref, hashed=True)


def _years(df, column: str = "fyear"):
    """``{YYZZ: rows}`` of a table with a year column, stored by year."""
    return {f"{y % 100:02}{(y + 1) % 100:02}": rows for y, rows in by_year(df, column).items()}


@query("job_hospital_extract", """
    SELECT a.record_id, a.order_no, CAST(a.record_start_date AS VARCHAR) AS record_start_date,
        p.person_id, CAST(p.birth_date AS VARCHAR) AS birth_date, a.spell_id
    FROM admitted_records a JOIN order_person p ON a.order_no = p.o_orderkey
    WHERE a.fyear >= 2016 AND year(p.o_orderdate) + 20 >= 2016""")
def _(t: Tables):
    records = t.admitted_records.select("record_id", "order_no", "record_start_date", "fyear")
    people = t.order_person.select(
        F.col("o_orderkey").alias("order_no"), "person_id", "birth_date",
        (F.year("o_orderdate") + 20).alias("fyear"),
    )
    spells = t.admitted_records.select("record_id", "spell_id", "fyear")
    of_records, of_people, of_spells = _years(records), _years(people), _years(spells)
    new_people = {k: v.withColumnRenamed("person_id", "pseudo_id") for k, v in of_people.items() if k >= "2021"}
    return hospital_extract(
        (of_records, of_records),
        (of_people, new_people),
        16, 99, "order_no",
        columns=["record_id", "order_no", "record_start_date"],
        spells=(of_spells, of_spells),
        spell_columns=("record_id", "spell_id"),
        renames={"pseudo_id": "person_id"},
    )


@query("job_hospital_prep", """
    SELECT record_id, person_id, CAST(birth_date AS VARCHAR) AS birth_date, code, flag, dataset,
        array_to_string(code_array, ',') AS code_array, spell_id,
        CAST(spell_start AS VARCHAR) AS spell_start, CAST(spell_end AS VARCHAR) AS spell_end
    FROM episodes""")
def _(t: Tables):
    episodes = hospital_prep(
        t.admitted, LABELS.admitted, "DIAG_4_01", "DIAG_4_CONCAT", admitted=True,
        eligible=run(t).people,
    )
    return episodes.select(
        "record_id", *LINK, "code", "flag", "dataset", "code_array", "spell_id", "spell_start",
        "spell_end",
    )


@query("job_deaths", """
    SELECT * REPLACE (CAST(birth_date AS VARCHAR) AS birth_date,
                      CAST(date_of_death AS VARCHAR) AS date_of_death) FROM deaths""")
def _(t: Tables):
    return deaths.deaths(t.deaths_raw, LABELS.deaths, LAST_DEATH, eligible=run(t).people)


_DIAGNOSES = ", ".join(
    f'CAST("{c}_diagnosis_date" AS VARCHAR) AS "{c}_diagnosis_date"' for c in CONDITIONS
)


@query("job_diagnosis", f"""
    SELECT person_id, CAST(birth_date AS VARCHAR) AS birth_date, {_DIAGNOSES} FROM diagnoses""")
def _(t: Tables):
    return journal.diagnosis(run(t).entries)


@query("job_bp", """
    SELECT * REPLACE (CAST(birth_date AS VARCHAR) AS birth_date,
                      CAST(extract_date AS VARCHAR) AS extract_date,
                      CAST(journal_date AS VARCHAR) AS journal_date) FROM readings""")
def _(t: Tables):
    return journal.blood_pressure(run(t).entries, LABELS.readings, FIRST_READING)


@query("job_smoking", f"""
    SELECT person_id, CAST(birth_date AS VARCHAR) AS birth_date, flag,
        CAST(max(journal_date) AS VARCHAR) AS journal_date,
        arg_max({age('birth_date', 'journal_date')}, journal_date) AS age,
        CAST(min(journal_date) AS VARCHAR) AS record_start_date
    FROM (SELECT *, CASE code WHEN '77176002' THEN 'current' WHEN '8517006' THEN 'ex'
              WHEN '266919005' THEN 'never' END AS flag FROM journal)
    WHERE flag IS NOT NULL GROUP BY person_id, birth_date, flag""")
def _(t: Tables):
    status = journal.smoking(run(t).entries, SMOKING)
    rows = status.select(*LINK, "journal_date", "flag", "age")
    return journal.checked_periods(hard_cache(journal.smoking_periods(rows), "smoking"))


_EVENT = """person_id, CAST(birth_date AS VARCHAR) AS birth_date, age, sex, dataset, category,
    record_id, CAST(record_start_date AS VARCHAR) AS record_start_date,
    CAST(record_end_date AS VARCHAR) AS record_end_date, lsoa, ethnicity, code, flag"""
_LISTS = ", ".join(
    f"array_to_string({c}, ',') AS {c}" for c in ("code_array", "flag_assoc", "record_id_assoc")
)


@query("job_events", f"SELECT {_EVENT}, {_LISTS} FROM all_events")
def _(t: Tables):
    r = run(t)
    return events.events(r.cohort_rows, r.episodes, r.deaths, r.readings)


@query("job_demographic", """
    SELECT person_id, CAST(birth_date AS VARCHAR) AS birth_date, dataset,
        CAST(record_start_date AS VARCHAR) AS record_start_date, ethnicity,
        enhanced_ethnicity_flag FROM demographic""")
def _(t: Tables):
    r = run(t)
    return demographic.demographic(
        r.events, r.entries, t.outpatient, t.emergency, t.ethnicity_ref, EMERGENCY_FROM
    )


_PATIENT = f"""person_id, CAST(birth_date AS VARCHAR) AS birth_date,
    CAST(latest_extract_date AS VARCHAR) AS latest_extract_date, latest_practice_identifier, sex,
    lsoa, cohort, ethnicity, {_DIAGNOSES}, CAST(date_of_death AS VARCHAR) AS date_of_death,
    death_flag, death_age_flag, stroke_count, CAST(max_stroke_date AS VARCHAR) AS max_stroke_date,
    mi_count, CAST(max_mi_date AS VARCHAR) AS max_mi_date,
    coalesce(array_to_string(died_within_30_days_hospitalisation_flags, ','),
             CASE WHEN died_within_30_days_hospitalisation_flags IS NOT NULL THEN '' END)
        AS died_within_30_days_hospitalisation_flags, hyp_risk_group"""


@query("job_patient", f"SELECT {_PATIENT} FROM patients")
def _(t: Tables):
    r = run(t)
    return patient.patient(r.events, r.diagnoses, r.demographic, first=r.patient_base)


@query("job_curate", """
    SELECT age, sex, dataset, category, record_id,
        CAST(record_start_date AS VARCHAR) AS record_start_date,
        CAST(record_end_date AS VARCHAR) AS record_end_date, lsoa, ethnicity, code, flag,
        person_id, coalesce(array_to_string(code_array, ','), '') AS code_array,
        coalesce(array_to_string(flag_assoc, ','), '') AS flag_assoc,
        coalesce(array_to_string(record_id_assoc, ','), '') AS record_id_assoc
    FROM all_events WHERE dataset <> 'admitted' OR flag <> 'NO_CVD'""")
def _(t: Tables):
    return curation.curated_events(run(t).events)


_LEVEL = "CASE WHEN {0} THEN 'warning' ELSE 'pass' END"
_NULL_PATIENT = ", ".join(
    f"CASE WHEN count(\"{c}\") = 0 THEN '{c}' END" for c in PATIENT_SCHEMA.names
)


@query("job_report", f"""
    SELECT 'pass' AS level, 'events_datasets_present' AS check, NULL AS message FROM all_events
        HAVING count(DISTINCT dataset) = 4
    UNION ALL SELECT 'pass', 'events_datasets_present', NULL FROM all_events
        HAVING count(*) FILTER (dataset NOT IN ('cohort', 'readings', 'admitted', 'deaths')) = 0
    UNION ALL SELECT 'pass', 'events_not_empty', NULL FROM all_events HAVING count(*) > 0
    UNION ALL SELECT 'pass', 'events_fields_all_null', NULL FROM all_events
        HAVING count(flag_assoc) > 0
    UNION ALL SELECT CASE WHEN count(*) > count(person_id) THEN 'warning' ELSE 'pass' END,
        'events_required_fields',
        CASE WHEN count(*) > count(person_id) THEN 'nulls: person_id' END FROM all_events
    UNION ALL SELECT 'pass', 'events_schema', NULL FROM all_events HAVING count(*) > 0
    UNION ALL SELECT 'pass', 'patients_cohorts_present', NULL FROM patients
        HAVING count(DISTINCT cohort) = 2
    UNION ALL SELECT 'pass', 'patients_cohorts_present', NULL FROM patients
        HAVING count(*) FILTER (cohort NOT IN ('C01', 'C02')) = 0
    UNION ALL SELECT 'pass', 'patients_not_empty', NULL FROM patients HAVING count(*) > 0
    UNION ALL SELECT CASE WHEN len(names) > 0 THEN 'warning' ELSE 'pass' END,
        'patients_fields_all_null',
        CASE WHEN len(names) > 0 THEN 'only nulls: ' || array_to_string(list_sort(names), ', ') END
        FROM (SELECT list_filter([{_NULL_PATIENT}], lambda x: x IS NOT NULL) AS names FROM patients)
    UNION ALL SELECT 'pass', 'patients_required_fields', NULL FROM patients
        HAVING count(*) = count(latest_extract_date)
    UNION ALL SELECT 'pass', 'patients_schema', NULL FROM patients HAVING count(*) > 0""")
def _(t: Tables):
    r = run(t)
    return report.report(r.events, r.patient, COHORTS)


_DIAGNOSIS_COUNTS = " ".join(
    f"""UNION ALL SELECT 'patient_table', '{c}_diagnoses',
    CAST(count("{c}_diagnosis_date") AS VARCHAR) FROM patients"""
    for c in CONDITIONS
)


# The products that the metrics need.
_WRITTEN = (
    "extract", "clean_extract", "cohort", "journal", "people", "episodes", "deaths", "readings",
    "diagnoses", "events", "demographic", "patient_base", "patient",
)


@query("job_metrics", f"""
    SELECT *, 'counts' AS category FROM (
    SELECT 'events_table' AS stage, 'col_count' AS criteria, '16' AS value
    UNION ALL SELECT 'events_table', 'row_count', CAST(count(*) AS VARCHAR) FROM all_events
    UNION ALL SELECT 'events_table', 'distinct_person_count', CAST(count(*) AS VARCHAR)
        FROM (SELECT DISTINCT person_id, birth_date FROM all_events)
    UNION ALL SELECT 'events_table', 'latest_record_start_date',
        CAST(max(record_start_date) AS VARCHAR) FROM all_events
    UNION ALL SELECT 'events_table', 'category_' || category, CAST(count(*) AS VARCHAR)
        FROM all_events GROUP BY category
    UNION ALL SELECT 'events_table', 'dataset_' || dataset, CAST(count(*) AS VARCHAR)
        FROM all_events GROUP BY dataset
    UNION ALL SELECT 'patient_table', 'col_count', '30'
    UNION ALL SELECT 'patient_table', 'row_count', CAST(count(*) AS VARCHAR) FROM patients
    UNION ALL SELECT 'patient_table', 'distinct_person_count', CAST(count(*) AS VARCHAR)
        FROM (SELECT DISTINCT person_id, birth_date FROM patients)
    UNION ALL SELECT 'patient_table', 'total_deaths', CAST(count(date_of_death) AS VARCHAR)
        FROM patients
    UNION ALL SELECT 'patient_table', 'latest_extract', CAST(max(latest_extract_date) AS VARCHAR)
        FROM patients
    UNION ALL SELECT 'patient_table', 'death_' || death_flag, CAST(count(*) AS VARCHAR)
        FROM patients WHERE death_flag IS NOT NULL GROUP BY death_flag
    {_DIAGNOSIS_COUNTS}
    UNION ALL SELECT 'demographic_table', 'col_count', '6'
    UNION ALL SELECT 'demographic_table', 'row_count', CAST(count(*) AS VARCHAR) FROM demographic
    UNION ALL SELECT 'demographic_table', 'distinct_person_count', CAST(count(*) AS VARCHAR)
        FROM (SELECT DISTINCT person_id, birth_date FROM demographic)
    UNION ALL SELECT 'demographic_table', 'enhanced_ethnicity',
        CAST(count(*) FILTER (enhanced_ethnicity_flag = 1) AS VARCHAR) FROM demographic)
    UNION ALL SELECT unnest([{', '.join(f"'{s}'" for s in _WRITTEN)}]), 'total_time', NULL, 'timing'
    UNION ALL VALUES ('pipeline', 'total_time', NULL, 'pipeline_stats'),
        ('pipeline', 'stages', '{len(_WRITTEN)}', 'pipeline_stats')""")
def _(t: Tables):
    # Times differ from run to run, so they are compared by their presence.
    timed = F.col("criteria") == "total_time"
    return run(t).metrics.withColumn("value", F.when(~timed, F.col("value")))


