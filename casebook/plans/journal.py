"""What the journal says: diagnoses, blood pressure, smoking."""

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.constants import (
    CONDITIONS,
    DIASTOLIC_CODES,
    FIRST_READING_DATE,
    LINK,
    PAIR_CLUSTERS,
    SYSTOLIC_CODES,
)
from casebook.functions.dates import age_years
from casebook.functions.readings import (
    is_pair,
    is_single,
    reading,
    risk_band,
    single_reading,
    smoking_status,
)
from casebook.functions.values import hash_key
from casebook.operators.filters import age_between, plausible_readings
from casebook.operators.history import initial_people, min_pair, pivot_latest, resolved_latest
from casebook.operators.latest import latest_with_start
from casebook.operators.quality import require_at_most
from casebook.operators.shaping import add_source_label, fill_missing_columns


def diagnosis(journal: DataFrame) -> DataFrame:
    """One row per person with a date column per condition; people without any stay."""
    standing = resolved_latest(age_between(journal, "birth_date", "journal_date"))
    wide = pivot_latest(standing, LINK, "diagnosis", "journal_date")
    wide = fill_missing_columns(wide, CONDITIONS, "_diagnosis_date")
    return initial_people(journal).join(wide, list(LINK), "left")


def split_readings(
    journal: DataFrame,
    systolic_codes: Iterable[str] = SYSTOLIC_CODES,
    diastolic_codes: Iterable[str] = DIASTOLIC_CODES,
    pair_clusters: Iterable[str] = PAIR_CLUSTERS,
    legacy: bool = False,
) -> DataFrame:
    """Journal rows that are readings, with ``systolic`` and ``diastolic``.

    A row is a single reading or a pair by its number of values, never both, so one pass finds
    both kinds. A pair under a systolic or diastolic code cannot occur in both either.
    """
    code, cluster, values = F.col("code"), F.col("cluster"), F.col("code_array")
    pair = is_pair(cluster, values, pair_clusters, legacy)
    single = is_single(code, values, systolic_codes, diastolic_codes, legacy)

    def side(codes: Iterable[str], place: int) -> Column:
        return F.when(pair, reading(values, place)).otherwise(single_reading(code, values, codes))

    return journal.where(pair | single).withColumns(
        {"systolic": side(systolic_codes, 0), "diastolic": side(diastolic_codes, 1)}
    )


def blood_pressure(
    journal: DataFrame,
    dataset: str,
    first_date=FIRST_READING_DATE,
    others: Sequence[str] = ("age", "cohort", "sex", "lsoa", "ethnicity"),
    legacy: bool = False,
    **bounds,
) -> DataFrame:
    """One reading pair per person and day, from the newest extract, with its risk band."""
    recent = journal.where(F.col("journal_date") >= F.lit(first_date))
    plausible = plausible_readings(
        split_readings(recent, legacy=legacy),
        "birth_date", "journal_date", "systolic", "diastolic", **bounds,
    )
    # Dealt by person and day, which serves both aggregates; an entry is there once, so few share a day.
    plausible = plausible.repartition(*LINK, "journal_date")
    keys = [*LINK, "extract_date", "journal_date"]
    lowest = min_pair(plausible, keys, "systolic", "diastolic", others)
    # One pair per person, extract and day, so the newest extract of a day is a single row.
    rest = [c for c in lowest.columns if c not in (*LINK, "journal_date", "extract_date")]
    newest = (
        lowest.groupBy(*LINK, "journal_date")
        .agg(F.max(F.struct("extract_date", *rest)).alias("_newest"))
        .select(*LINK, "journal_date", "_newest.*")
        .select(*lowest.columns)
    )
    band = risk_band(F.col("age"), F.col("systolic"), F.col("diastolic"))
    return add_source_label(newest.withColumns({"flag": band, "record_id": reading_id()}), dataset)


def reading_id() -> Column:
    """The hashed key of a reading: its person and day."""
    return hash_key(*LINK, "journal_date")


def smoking(journal: DataFrame, statuses: Mapping[str, Iterable[str]]) -> DataFrame:
    """Journal rows that state a smoking status, with the age then."""
    rows = journal.withColumn("flag", smoking_status(F.col("code"), statuses))
    age = age_years(F.col("birth_date"), F.col("journal_date"))
    return rows.where(F.col("flag").isNotNull()).withColumn("age", age)


def smoking_periods(status: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """The last row of each person and status, with the date the status was first seen."""
    return latest_with_start(status, [*LINK, "flag"], "journal_date", "record_start_date", ties)


def checked_periods(periods: DataFrame, most: int = 3) -> DataFrame:
    """The (stored) periods, if no person has more than ``most``; else an error. Runs a job."""
    return require_at_most(periods, LINK, most, "smoking periods")
