"""Row filters."""

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebook.constants import (
    EPISODE,
    MAX_AGE,
    MIN_AGE_DIAGNOSIS,
    NO_MATCH,
    OUTCOME_CODES,
    SPELL,
)
from casebook.functions import codes, dates, readings, values
from casebook.operators.shaping import check_type


def filter_values(
    df: DataFrame, column: str, wanted: str | Iterable, keep: bool = True
) -> DataFrame:
    """Keep, or drop, the rows with listed values. Null rows go in both modes."""
    listed = F.col(column).isin([wanted] if isinstance(wanted, str) else list(wanted))
    return df.where(listed if keep else ~listed)


def filter_months(
    df: DataFrame, start: str, day: str, months: int = 12, before: bool = True
) -> DataFrame:
    """Rows later than ``months`` before (or after) ``start``."""
    return df.where(dates.later_than_months(F.col(day), F.col(start), months, before))


def keep_valid_ids(df: DataFrame, column: str, **rules) -> DataFrame:
    """Rows with a valid identifier; see :func:`casebook.functions.values.valid_id`."""
    return df.where(values.valid_id(F.col(column), **rules))


def drop_null_rows(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Drop rows with a null in any of the columns."""
    return df.na.drop(subset=[columns] if isinstance(columns, str) else list(columns))


def drop_blank_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows where any of the columns is null, empty or a spelling of "null"."""
    for c in columns:
        df = df.where(values.has_text(F.col(c)))
    return df


def clean_dataset(
    df: DataFrame,
    id_columns: Sequence[str],
    required: Sequence[str],
    blank_to_null: Sequence[str] = (),
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    check_ids: bool = True,
) -> DataFrame:
    """Prepare, drop rows with blanks, drop invalid ids, turn other blanks into nulls."""
    if prepare:
        df = df.transform(prepare)
    df = drop_blank_rows(df, required)
    if check_ids:
        for c in id_columns:
            df = df.where(values.check_digit_ok(F.col(c)))
    return df.withColumns({c: values.null_if_blank(F.col(c)) for c in blank_to_null})


def current_not_cancelled(df: DataFrame, current: str, cancelled: str) -> DataFrame:
    """Rows marked current and not cancelled; both marks are dropped."""
    good = (F.col(current) == "True") & (F.col(cancelled) == "N")
    return df.where(good).drop(current, cancelled)


def region_filter(df: DataFrame, primary: str, fallback: str, prefix: str = "E") -> DataFrame:
    """Rows of a region by the primary place, or by the fallback place where there is none."""
    return df.where(F.coalesce(F.col(primary), F.col(fallback)).startswith(prefix))


def plausible_dates(df: DataFrame, birth: str, death: str, first, last) -> DataFrame:
    """Death not before birth and between the two bounds, both included."""
    day = F.col(death)
    return df.where((day >= F.col(birth)) & day.between(F.lit(first), F.lit(last)))


def age_between(
    df: DataFrame, birth: str, day: str, low: int = MIN_AGE_DIAGNOSIS, high: int = MAX_AGE
) -> DataFrame:
    """Rows dated when the person's age was within the bounds."""
    return df.where(dates.age_years(F.col(birth), F.col(day)).between(low, high))


def plausible_readings(
    df: DataFrame, birth: str, day: str, systolic: str, diastolic: str, age: str = "age", **bounds
) -> DataFrame:
    """Add the age at the reading and keep plausible readings."""
    aged = df.withColumn(age, dates.age_years(F.col(birth), F.col(day)))
    return aged.where(
        readings.is_plausible(F.col(age), F.col(systolic), F.col(diastolic), **bounds)
    )


def from_year(df: DataFrame, day: str, year: int) -> DataFrame:
    """Rows dated in or after a year; a two-digit year counts from 2000."""
    return df.where(dates.on_or_after_year(F.col(day), year))


def prefix_region(df: DataFrame, column: str, prefix: str = "E") -> DataFrame:
    """Rows whose area code starts with the prefix; the column must be text, nulls go."""
    check_type(df, column, T.StringType)
    return df.where(F.col(column).startswith(prefix))


def array_code_filter(df: DataFrame, column: str, wanted: Iterable[str]) -> DataFrame:
    """Rows with a wanted code, or one extended by a digit, in an array column."""
    return df.where(codes.any_code_matches(F.col(column), wanted))


def primary_code_filter(df: DataFrame, column: str, flags=OUTCOME_CODES) -> DataFrame:
    """Rows whose primary code belongs to any of the flags' lists."""
    return filter_values(df, column, codes.invert(flags))


def events_of(df: DataFrame, dataset: str, category: str) -> DataFrame:
    """Events of one dataset and category; prunes partitions or union branches."""
    return df.where((F.col("dataset") == dataset) & (F.col("category") == category))


def curate_events(
    df: DataFrame,
    datasets: Iterable[str],
    categories: Iterable[str],
    hospital: str,
    drop: Sequence[str] = ("birth_date",),
    flag_removed: str = NO_MATCH,
) -> DataFrame:
    """Events fit for sharing.

    Listed datasets and categories only; hospital events need a flag other than ``flag_removed``
    and are episodes or spells.
    """
    relevant = F.col("category").isin(EPISODE, SPELL) & (F.col("flag") != flag_removed)
    wanted = F.col("dataset").isin(list(datasets)) & F.col("category").isin(list(categories))
    return df.where(wanted & ((F.col("dataset") != hospital) | relevant)).drop(*drop)
