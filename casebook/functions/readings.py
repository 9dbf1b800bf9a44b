"""Blood-pressure readings, risk bands, smoking status and source priority."""

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from casebook.constants import (
    DIASTOLIC_CODES,
    MAX_AGE,
    MIN_AGE_READING,
    MIN_DIASTOLIC,
    MIN_SYSTOLIC,
    PAIR_CLUSTERS,
    SYSTOLIC_CODES,
)
from casebook.functions.values import present


def value_count(values: Column, legacy: bool = False) -> Column:
    """Number of non-null values; ``legacy`` counts equal ones once."""
    found = present(values)
    return F.size(F.array_distinct(found) if legacy else found)


def is_single(
    code: Column,
    values: Column,
    systolic: Iterable[str] = SYSTOLIC_CODES,
    diastolic: Iterable[str] = DIASTOLIC_CODES,
    legacy: bool = False,
) -> Column:
    """One reading under a systolic or diastolic code, held in the first place."""
    coded = code.isin([*systolic, *diastolic])
    return coded & F.get(values, F.lit(0)).isNotNull() & (value_count(values, legacy) == 1)


def is_pair(
    cluster: Column,
    values: Column,
    clusters: Iterable[str] = PAIR_CLUSTERS,
    legacy: bool = False,
) -> Column:
    """Both readings in one row. ``legacy`` rejects two equal readings."""
    return cluster.isin(list(clusters)) & (value_count(values, legacy) == 2)


def reading(values: Column, place: int) -> Column:
    """A reading as a double, so that 99 is less than 140; text that is no number is null."""
    return F.get(values, F.lit(place)).try_cast("double")


def single_reading(code: Column, values: Column, codes: Iterable[str]) -> Column:
    """The first value where the code belongs to the list, else null."""
    return F.when(code.isin(list(codes)), reading(values, 0))


def is_plausible(
    age: Column,
    systolic: Column,
    diastolic: Column,
    min_age: int = MIN_AGE_READING,
    max_age: int = MAX_AGE,
    min_systolic: float = MIN_SYSTOLIC,
    min_diastolic: float = MIN_DIASTOLIC,
) -> Column:
    """Age within bounds, at least one reading, and no reading below its minimum."""
    any_reading = systolic.isNotNull() | diastolic.isNotNull()
    not_low = F.coalesce(systolic >= min_systolic, F.lit(True)) & F.coalesce(
        diastolic >= min_diastolic, F.lit(True)
    )
    return age.between(min_age, max_age) & any_reading & not_low


def risk_band(age: Column, systolic: Column, diastolic: Column) -> Column:
    """Risk band of a reading.

    ``0.1`` / ``0.2``: on target, below 80 / from 80 on. ``1d``, ``1c``: very high, high.
    ``1a`` / ``1b``: moderate, below 80 / from 80 on. Null: no band. The first that fits wins.
    """
    younger, older = age < 80, age >= 80

    def on_target(top: int) -> Column:
        return systolic.between(MIN_SYSTOLIC, top) & diastolic.between(MIN_DIASTOLIC, 90)

    moderate_diastolic = (diastolic > 90) & (diastolic <= 100)
    return (
        F.when(systolic.isNull() | diastolic.isNull(), None)
        .when(younger & on_target(140), "0.1")
        .when(older & on_target(150), "0.2")
        .when((systolic > 180) | (diastolic > 120), "1d")
        .when((systolic > 160) | (diastolic > 100), "1c")
        .when(younger & ((systolic > 140) | moderate_diastolic), "1a")
        .when(older & ((systolic > 150) | moderate_diastolic), "1b")
    )


def risk_default(diagnosed: Column, band: Column) -> Column:
    """``-1`` without a diagnosis, ``1e`` for a diagnosis without a band, else the band."""
    return F.when(diagnosed.isNull(), "-1").otherwise(F.coalesce(band, F.lit("1e")))


def smoking_status(code: Column, statuses: Mapping[str, Iterable[str]]) -> Column:
    """Status whose code list holds the code, in the order given; null for other codes."""
    return F.coalesce(*(F.when(code.isin(list(c)), F.lit(s)) for s, c in statuses.items()))


def priority_rank(source: Column, order: Sequence[str], legacy: bool = False) -> Column:
    """Place of a source in the priority order, from 1.

    Unknown sources come last; ``legacy`` gives them null, which sorts first.
    """
    known = F.coalesce(*(F.when(source == s, i) for i, s in enumerate(order, 1)))
    return known if legacy else F.coalesce(known, F.lit(len(order) + 1))
