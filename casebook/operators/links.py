"""Joins between sources.

Reference tables are not hinted: Spark broadcasts a side only when its measured size is below
``spark.sql.autoBroadcastJoinThreshold`` and shuffles it otherwise.
"""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.functions import dates

def attach(df: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join with a side that is unique by key, for keys that may be null.

    Rows with a null key never match and would all meet in one task, so they take no part in the
    join: they get nulls and are not shuffled.
    """
    lacking = F.lit(False)
    for c in on:
        lacking = lacking | F.col(c).isNull()
    joined = df.where(~lacking).join(right, [*on], "left")
    added = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema if f.name not in on]
    rest = df.where(lacking).select("*", *added)
    return joined.unionByName(rest)


def link_inner(
    df: DataFrame,
    other: DataFrame,
    on: Sequence[str],
    columns: Sequence[str] | None = None,
    other_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Join the two halves of a record by its key, optionally cut to columns beforehand."""
    left = df.select(*columns) if columns else df
    right = other.select(*other_columns) if other_columns else other
    return left.join(right, list(on), "inner")


def duplicate_keys(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number."""
    counts = df.groupBy(*on).agg(F.count("*").alias("rows"))
    return counts.where("rows > 1")


def link_left(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join by record key. :func:`duplicate_keys` of ``other`` tells whether rows multiply."""
    return df.join(other, list(on), "left")


def ref_lookup(
    df: DataFrame, ref: DataFrame, code: str, ref_code: str, active: str | None = None
) -> DataFrame:
    """Left join a code table (active rows only). A code in several clusters fans out."""
    table = ref.where(F.col(active) == 1).drop(active) if active else ref
    table = table.withColumnRenamed(ref_code, "_ref")
    return df.join(table, F.col(code) == F.col("_ref"), "left").drop("_ref")


def ref_map_inner(df: DataFrame, ref: DataFrame, code: str, ref_code: str) -> DataFrame:
    """Rows whose code is in the (distinct) code table, with what the table says."""
    table = ref.distinct().withColumnRenamed(ref_code, "_ref")
    return df.join(table, F.col(code) == F.col("_ref"), "inner").drop("_ref")


def filter_by_frame(df: DataFrame, wanted: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rows whose columns occur together in another frame; ``names`` maps its columns to ours."""
    if not isinstance(names, Mapping):
        raise TypeError("names must map filter columns to input columns")
    keys = wanted.select(*(F.col(theirs).alias(ours) for theirs, ours in names.items()))
    return df.join(keys, list(names.values()), "left_semi")


def eligible_only(
    df: DataFrame, people: DataFrame, on: Sequence[str] = ("person_id", "birth_date")
) -> DataFrame:
    """Rows of eligible people."""
    return df.join(people.select(*on), list(on), "left_semi")


def before_cutoff(
    df: DataFrame,
    cutoffs: DataFrame,
    day: str,
    cutoff: str,
    on: Sequence[str],
    keep_nulls: bool = False,
    inclusive: bool = False,
) -> DataFrame:
    """Rows dated before (or also on) the person's cut-off, which stays as a column.

    ``keep_nulls`` keeps rows of people without a cut-off. The cut-offs must be unique by key.
    """
    dated = df.join(cutoffs.select(*on, cutoff), list(on), "left")
    early = F.col(day) <= F.col(cutoff) if inclusive else F.col(day) < F.col(cutoff)
    return dated.where(early | F.col(cutoff).isNull() if keep_nulls else early)


def enrich_left(df: DataFrame, *sides: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join several frames that are unique by the same key, each with columns of its own.

    The sides are put below each other and gathered by key in one aggregate, which meets the frame in one
    join: one exchange for all sides and one for the frame, however many sides there are.
    """
    if len(sides) < 2:
        return df.join(sides[0], list(on), "left") if sides else df
    names = [c for side in sides for c in side.columns if c not in on]
    if len(set(names)) < len(names):
        raise ValueError("sides share column names")
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sides)
    gathered = stacked.groupBy(*on).agg(*(F.first(F.col(f"`{c}`"), ignorenulls=True).alias(c) for c in names))
    return df.join(gathered, list(on), "left")


def near_before(
    events: DataFrame, anchors: DataFrame, day: str, anchor: str, on: Sequence[str], days: int
) -> DataFrame:
    """Pairs of events and anchors of a key, at least all those with the event 0 to ``days`` before.

    Days are cut into bins of that length. An event lies in one bin, an anchor asks for the two or so that
    its days reach, and both meet on key and bin: a key with very many events is spread over its bins, and
    an anchor meets no events of other times. The exact bounds are left to the caller.
    """
    number = lambda c: F.datediff(F.col(c), F.lit("1970-01-01").cast("date"))
    bin_of = lambda c: F.floor(c / days).cast("int")
    binned = events.withColumn("_bin", bin_of(number(day)))
    asked = F.sequence(bin_of(number(anchor) - days), bin_of(number(anchor)))
    asking = anchors.select(*on, anchor).withColumn("_bin", F.explode(asked))
    return binned.join(asking, [*on, "_bin"], "inner").drop("_bin")


def within_months(
    events: DataFrame, anchors: DataFrame, day: str, anchor: str, on: Sequence[str], months=12
) -> DataFrame:
    """Events 0 to ``months`` months before the person's anchor date."""
    dated = near_before(events, anchors, day, anchor, on, 31 * months + 1)
    return dated.where(dates.within_months_before(F.col(day), F.col(anchor), months))


def within_days(
    events: DataFrame, anchors: DataFrame, day: str, anchor: str, on: Sequence[str], days=30
) -> DataFrame:
    """Events at most ``days`` before, and strictly before, the person's anchor date."""
    dated = near_before(events, anchors, day, anchor, on, max(1, days))
    return dated.where(dates.within_days_before(F.col(day), F.col(anchor), days))
