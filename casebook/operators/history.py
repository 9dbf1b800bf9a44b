"""Per-person histories: counts, latest dates, diagnoses, readings."""

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.constants import CONDITION_CODES, CONDITIONS, LINK, RESOLUTION_CODES
from casebook.functions import codes
from casebook.operators.links import within_days


def has_flag(flag: Column, others: Column, value: str) -> Column:
    """The main flag is the value, or the associated flags hold it."""
    return F.coalesce(flag == value, F.lit(False)) | F.coalesce(
        F.array_contains(others, value), F.lit(False)
    )


def history(
    events: DataFrame,
    cutoffs: DataFrame,
    flags: Mapping[str, str],
    cutoff: str = "date_of_death",
    on: Sequence[str] = LINK,
    day: str = "record_start_date",
    keep_nulls: bool = True,
    inclusive: bool = True,
) -> DataFrame:
    """One row per person with, per entry ``name: flag``, ``<name>_count`` and ``max_<name>_date``.

    Events count up to the person's cut-off; those of people without one count with ``keep_nulls``.
    ``cutoffs`` holds keys and cut-offs, unique by key, and may leave people out. Events are first
    summed per person and day; a person then brings at most one row per day to the join, however
    many events there are.
    """
    found = {name: has_flag(F.col("flag"), F.col("flag_assoc"), f) for name, f in flags.items()}
    any_flag = F.lit(False)
    for condition in found.values():
        any_flag = any_flag | condition
    daily = (
        events.where(any_flag)
        .groupBy(*on, day)
        .agg(*(F.count_if(condition).alias(f"_{name}") for name, condition in found.items()))
    )
    dated = daily.join(cutoffs.select(*on, cutoff), list(on), "left")
    early = F.col(day) <= F.col(cutoff) if inclusive else F.col(day) < F.col(cutoff)
    totals = []
    for name in flags:
        totals.append(F.sum(f"_{name}").alias(f"{name}_count"))
        totals.append(F.max(F.when(F.col(f"_{name}") > 0, F.col(day))).alias(f"max_{name}_date"))
    kept = dated.where(early | F.col(cutoff).isNull() if keep_nulls else early)
    return kept.groupBy(*on).agg(*totals)


def conditional_history(
    people: DataFrame, events: DataFrame, flags: Mapping[str, str], cutoff: str = "date_of_death",
    on: Sequence[str] = LINK, **options,
) -> DataFrame:
    """People with their :func:`history`; their own column is the cut-off, no events count 0."""
    found = history(events, people, flags, cutoff, on, **options)
    return people.join(found, list(on), "left").fillna({f"{n}_count": 0 for n in flags})


def last_flags(
    events: DataFrame,
    deaths: DataFrame,
    out: str = "died_within_30_days_hospitalisation_flags",
    death: str = "date_of_death",
    on: Sequence[str] = LINK,
    day: str = "record_start_date",
    days: int = 30,
) -> DataFrame:
    """One row per person who died with events in the days before: their sorted distinct flags.

    The array is empty when all these flags are null. Events of the living fall out in the join,
    before anything is grouped; a set never holds more than the flag list.
    """
    dead = deaths.where(F.col(death).isNotNull())
    recent = within_days(events.select(*on, day, "flag"), dead, day, death, on, days)
    return recent.groupBy(*on).agg(F.sort_array(F.collect_set("flag")).alias(out))


def flags_before_death(
    people: DataFrame, events: DataFrame, out: str = "died_within_30_days_hospitalisation_flags",
    death: str = "date_of_death", on: Sequence[str] = LINK, **options,
) -> DataFrame:
    """People with their :func:`last_flags`, null for those without."""
    return people.join(last_flags(events, people, out, death, on, **options), list(on), "left")


def pivot_latest(
    df: DataFrame, keys: Sequence[str], column: str, day: str, names: Sequence[str] = CONDITIONS
) -> DataFrame:
    """One column per name with its newest date; the fixed list spares a job to find the names."""
    return df.groupBy(*keys).pivot(column, list(names)).agg(F.max(day))


def parent_max(
    df: DataFrame, keys: Sequence[str], parent: str, code: str, day: str, out: str
) -> DataFrame:
    """Newest date per code, and the newest of these per parent, one row per code."""
    per_code = df.groupBy(*keys, parent, code).agg(F.max(day).alias("max_date"))
    # One row per code remains, and a parent has few codes.
    window = Window.partitionBy(*keys, parent)
    return per_code.withColumn(out, F.max("max_date").over(window))


def resolved_latest(
    journal: DataFrame,
    keys: Sequence[str] = LINK,
    cluster: str = "cluster",
    code: str = "code",
    day: str = "journal_date",
    conditions: Mapping[str, Iterable[str]] = CONDITION_CODES,
    resolutions: Mapping[str, str] = RESOLUTION_CODES,
) -> DataFrame:
    """Newest date of each condition that no later resolution ends; a same-day tie keeps it.

    One aggregate over (person, condition) gives both dates. A row whose cluster resolves a
    condition counts as such whatever its code is, also when the code is null.
    """
    diagnosed = codes.diagnosis(F.col(cluster), F.col(code), conditions)
    resolved = codes.resolution(F.col(cluster), resolutions)
    rows = journal.select(
        *keys,
        F.coalesce(diagnosed, resolved).alias("diagnosis"),
        F.when(diagnosed.isNotNull(), F.col(day)).alias("_found"),
        F.when(diagnosed.isNull(), F.col(day)).alias("_resolved"),
    ).where(F.col("diagnosis").isNotNull())
    both = rows.groupBy(*keys, "diagnosis").agg(
        F.max("_found").alias(day), F.max("_resolved").alias("_resolved")
    )
    standing = F.col("_resolved").isNull() | (F.col(day) >= F.col("_resolved"))
    return both.where(F.col(day).isNotNull() & standing).drop("_resolved")


def initial_people(df: DataFrame, keys: Sequence[str] = LINK) -> DataFrame:
    """The distinct people of a table."""
    return df.select(*keys).distinct()


def min_pair(
    df: DataFrame, keys: Sequence[str], systolic: str, diastolic: str, others: Sequence[str] = ()
) -> DataFrame:
    """Lowest systolic and lowest diastolic reading per key, each for itself; both must exist.

    ``others`` are taken together from one row, the smallest in column order.
    """
    lowest = [F.min(systolic).alias(systolic), F.min(diastolic).alias(diastolic)]
    if others:
        lowest.append(F.min(F.struct(*others)).alias("_others"))
    pairs = df.groupBy(*keys).agg(*lowest)
    pairs = pairs.where(F.col(systolic).isNotNull() & F.col(diastolic).isNotNull())
    return pairs.select(*keys, systolic, diastolic, "_others.*") if others else pairs


def rolling_daily(df: DataFrame, day: str, out: str, days: int = 7) -> DataFrame:
    """Rows per day and their mean over that and the previous days that have rows.

    The window has no partitions: it sees one row per calendar day, whatever the table's size.
    """
    counts = df.groupBy(F.to_date(day).alias(day)).agg(F.count("*").alias("count"))
    window = Window.orderBy(F.datediff(F.col(day), F.lit("1970-01-01")))
    return counts.withColumn(out, F.avg("count").over(window.rangeBetween(1 - days, 0)))
