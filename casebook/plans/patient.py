"""The patient table: one wide row per person."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebook.constants import CONDITIONS, DIED_UNDER_75, LINK
from casebook.functions.dates import under_age_label
from casebook.functions.readings import risk_default
from casebook.operators.filters import events_of
from casebook.operators.history import history, last_flags
from casebook.operators.latest import keep_latest
from casebook.operators.links import enrich_left, within_months
from casebook.operators.shaping import unify_schema
from casebook.plans.labels import LABELS, Labels

_S, _D, _I = T.StringType(), T.DateType(), T.IntegerType()
PATIENT_SCHEMA = T.StructType(
    [
        T.StructField(name, kind)
        for name, kind in [
            ("person_id", _S),
            ("birth_date", _D),
            ("latest_extract_date", _D),
            ("latest_practice_identifier", _S),
            ("sex", _S),
            ("lsoa", _S),
            ("cohort", _S),
            ("ethnicity", _S),
            *((f"{c}_diagnosis_date", _D) for c in CONDITIONS),
            ("date_of_death", _D),
            ("death_flag", _S),
            ("death_age_flag", _S),
            ("stroke_count", _I),
            ("max_stroke_date", _D),
            ("mi_count", _I),
            ("max_mi_date", _D),
            ("died_within_30_days_hospitalisation_flags", T.ArrayType(_S)),
            ("hyp_risk_group", _S),
        ]
    ]
)
REQUIRED = ("person_id", "birth_date", "latest_extract_date")
HISTORY_FLAGS = {"stroke": "STROKE", "mi": "HEARTATTACK"}


def base(events: DataFrame, labels: Labels = LABELS) -> DataFrame:
    """The newest cohort event of each person (ties stay, as they are a fault to be seen)."""
    rows = events_of(events, labels.cohort, labels.cohort_category)
    newest = keep_latest(rows, LINK, "record_start_date", "latest_extract_date")
    practice = F.concat_ws("", "code_array").alias("latest_practice_identifier")
    return newest.select(
        *LINK, "latest_extract_date", practice, "sex", "lsoa", F.col("code").alias("cohort")
    )


def risk_bands(
    readings: DataFrame,
    people: DataFrame,
    extract_day: str = "latest_extract_date",
    out: str = "hyp_risk_group",
    months: int = 12,
) -> DataFrame:
    """Band of each person's newest reading in the year before their extract.

    There is one reading per person and day, so the newest is a single row.
    """
    recent = within_months(readings, people, "record_start_date", extract_day, LINK, months)
    dated = recent.where(F.col("record_start_date").isNotNull())
    return dated.groupBy(*LINK).agg(F.max_by("flag", "record_start_date").alias(out))


def assign_risk(
    people: DataFrame,
    readings: DataFrame,
    extract_day: str = "latest_extract_date",
    diagnosed: str = "HTN_diagnosis_date",
    out: str = "hyp_risk_group",
    months: int = 12,
) -> DataFrame:
    """People with the band of :func:`risk_bands`, or a default."""
    bands = risk_bands(readings, people, extract_day, out, months)
    joined = people.join(bands, list(LINK), "left")
    return joined.withColumn(out, risk_default(F.col(diagnosed), F.col(out)))


def patient(
    events: DataFrame,
    diagnoses: DataFrame,
    demographics: DataFrame,
    labels: Labels = LABELS,
    first: DataFrame | None = None,
) -> DataFrame:
    """The patient table, from one aggregate per person and kind of event.

    Each aggregate meets narrow cut-offs (keys with the date of death, or of the extract), and all
    are joined once at the end, on the person key. ``first`` is a stored :func:`base`.
    """
    first = base(events, labels) if first is None else first
    died = events_of(events, labels.deaths, labels.deaths_category).select(
        *LINK,
        F.col("record_start_date").alias("date_of_death"),
        F.col("flag").alias("death_flag"),
    )
    ethnicity = demographics.select(*LINK, "ethnicity")
    spells = events_of(events, labels.admitted, labels.spell_category)
    episodes = events_of(events, labels.admitted, labels.episode_category)
    readings = events_of(events, labels.readings, labels.readings_category)
    people = enrich_left(
        first, ethnicity, died, diagnoses,
        history(spells, died, HISTORY_FLAGS), last_flags(episodes, died),
        risk_bands(readings, first.select(*LINK, "latest_extract_date")),
        on=LINK,
    )
    young = under_age_label(
        F.col("birth_date"), F.col("date_of_death"), 75, DIED_UNDER_75, F.col("death_flag")
    )
    band = risk_default(F.col("HTN_diagnosis_date"), F.col("hyp_risk_group"))
    people = people.withColumns({"death_age_flag": young, "hyp_risk_group": band})
    people = people.fillna({f"{name}_count": 0 for name in HISTORY_FLAGS})
    return unify_schema(people, {n: n for n in PATIENT_SCHEMA.names}, PATIENT_SCHEMA)
