"""The events table: every source in one schema."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.constants import SPELL_PREFIX
from casebook.functions.dates import age_at
from casebook.operators.shaping import EVENT_SCHEMA, union_all, unify_schema
from casebook.operators.spells import episodes_with_methods, spell_pipeline
from casebook.plans.labels import LABELS, Labels

REQUIRED = ("person_id", "dataset", "category", "record_id", "record_start_date")


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


def cohort_events(cohort: DataFrame, labels: Labels = LABELS) -> DataFrame:
    """Extract rows as events."""
    return unify_schema(
        cohort,
        {
            **_same("person_id", "birth_date", "age", "sex", "lsoa", "ethnicity"),
            "dataset": F.lit(labels.cohort),
            "category": F.lit(labels.cohort_category),
            "record_id": "cohort_id",
            "record_start_date": "extract_date",
            "code": "cohort",
            "code_array": F.split("practice", ","),
        },
    )


def episode_events(episodes: DataFrame, labels: Labels = LABELS) -> DataFrame:
    """Hospital episodes as events."""
    return unify_schema(
        episodes_with_methods(episodes),
        {
            **_same(
                "person_id", "birth_date", "sex", "dataset", "record_id", "record_start_date",
                "record_end_date", "lsoa", "ethnicity", "code", "flag", "code_array", "flag_assoc",
            ),
            "age": age_at(F.col("birth_date"), F.col("record_start_date")),
            "category": F.lit(labels.episode_category),
        },
    )


def spell_events(episodes: DataFrame, labels: Labels = LABELS, **options) -> DataFrame:
    """Hospital spells as events."""
    return unify_schema(
        spell_pipeline(episodes, **options),
        {
            **_same(
                "person_id", "birth_date", "sex", "dataset", "lsoa", "ethnicity", "code", "flag",
                "code_array", "flag_assoc", "record_id_assoc",
            ),
            "age": age_at(F.col("birth_date"), F.col("spell_start")),
            "category": F.lit(labels.spell_category),
            "record_id": F.concat(F.lit(SPELL_PREFIX), "spell_id"),
            "record_start_date": "spell_start",
            "record_end_date": "spell_end",
        },
    )


def death_events(deaths: DataFrame, labels: Labels = LABELS) -> DataFrame:
    """Deaths as events."""
    return unify_schema(
        deaths,
        {
            **_same("person_id", "birth_date", "sex", "dataset", "record_id", "code", "flag"),
            "age": age_at(F.col("birth_date"), F.col("date_of_death")),
            "category": F.lit(labels.deaths_category),
            "record_start_date": "date_of_death",
            "lsoa": "location",
            "code_array": F.split("code_array", ","),
            "record_id_assoc": F.array("record_id_assoc"),
        },
    )


def _number_text(column: str) -> Column:
    """A number as text, without a decimal point where it is whole."""
    number = F.col(column)
    whole = number.cast("bigint")
    return F.when(number == whole, whole.cast("string")).otherwise(number.cast("string"))


def reading_events(readings: DataFrame, labels: Labels = LABELS) -> DataFrame:
    """Blood-pressure readings as events."""
    systolic, diastolic = _number_text("systolic"), _number_text("diastolic")
    return unify_schema(
        readings,
        {
            **_same(
                "person_id", "birth_date", "age", "sex", "dataset", "record_id", "lsoa",
                "ethnicity", "flag",
            ),
            "category": F.lit(labels.readings_category),
            "record_start_date": "journal_date",
            "record_end_date": "extract_date",
            "code": F.concat_ws("/", systolic, diastolic),
            "code_array": F.array(systolic, diastolic),
        },
    )


def events(
    cohort: DataFrame,
    episodes: DataFrame,
    deaths: DataFrame,
    readings: DataFrame,
    labels: Labels = LABELS,
) -> DataFrame:
    """The events table. Filters on dataset and category drop whole branches of the union."""
    return union_all(
        [
            cohort_events(cohort, labels),
            episode_events(episodes, labels),
            spell_events(episodes, labels, gather=True),
            death_events(deaths, labels),
            reading_events(readings, labels),
        ]
    ).select(*EVENT_SCHEMA.names)
