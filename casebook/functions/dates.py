"""Dates and ages."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from casebook.constants import DAYS_PER_YEAR, MAX_AGE_BIRTH_DATE

DATE_FORMATS = (
    "yyyyMMdd",
    "yyyy-MM-dd",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "dd/MM/yyyy",
)


def parse_date(text: Column, formats: Sequence[str] = DATE_FORMATS, end_trim: int = 0) -> Column:
    """Text to date by the first format that fits; text that fits none becomes null.

    ``end_trim`` cuts that many characters off the end first (a zone suffix, say). The formats are
    explicit, so a partial date is null instead of being filled in from today's date.
    """
    if end_trim:
        text = F.substring(text, F.lit(1), F.length(text) - end_trim)
    return F.coalesce(*(F.try_to_date(text, f) for f in formats))


def age_years(birth: Column, at: Column) -> Column:
    """Whole years as days / 365.25, truncated; null when either date is null or birth is later.

    This is one day short of the calendar age on most birthdays, on purpose.
    """
    return F.when(birth <= at, (F.datediff(at, birth) / DAYS_PER_YEAR).cast("bigint"))


def valid_birth_date(birth: Column, at: Column, max_years: int = MAX_AGE_BIRTH_DATE) -> Column:
    """The birth date, or null when it is later than ``at`` or more than ``max_years`` before it."""
    impossible = (birth > at) | (F.datediff(at, birth) / DAYS_PER_YEAR > max_years)
    return F.when(impossible, None).otherwise(birth)


def valid_age(age: Column) -> Column:
    """An age as a short; text that is no number and negative ages become null."""
    number = age.try_cast("short")
    return F.when(number >= 0, number)


def age_at(birth: Column, at: Column, max_years: int = MAX_AGE_BIRTH_DATE) -> Column:
    """Age in whole years as a short, null for impossible birth dates."""
    return age_years(valid_birth_date(birth, at, max_years), at).cast("short")


def under_age_label(
    start: Column, end: Column, max_age: int, label: str, required: Column | None = None
) -> Column:
    """``label`` where the age at ``end`` is below ``max_age`` (and ``required`` is not null)."""
    young = age_years(start, end) < max_age
    if required is not None:
        young = young & required.isNotNull()
    return F.when(young, F.lit(label))


def birth_year(birth: Column) -> Column:
    """The year of a date as text."""
    return F.date_format(birth, "y")


def later_than_months(day: Column, start: Column, months: int = 12, before: bool = True) -> Column:
    """``day`` lies after ``start`` moved ``months`` back (or forward); there is no upper bound."""
    return day > F.add_months(start, -months if before else months)


def within_months_before(day: Column, anchor: Column, months: int = 12) -> Column:
    """``day`` lies 0 to ``months`` months before ``anchor``, both ends included."""
    return F.months_between(anchor, day).between(0, months)


def within_days_before(day: Column, anchor: Column, days: int = 30) -> Column:
    """``day`` lies at most ``days`` before ``anchor`` and strictly before it."""
    return (day >= F.date_add(anchor, -days)) & (day < anchor)


def on_or_after_year(day: Column, year: int) -> Column:
    """Dates from the first of January of a year on.

    A two-digit year counts from 2000. It is a range on the bare column, so that row groups and
    partitions can be skipped.
    """
    full = year + 2000 if year < 100 else year
    return day >= F.lit(f"{full:04d}-01-01").cast("date")
