"""Newest, first, best and unambiguous rows per key."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebook.functions.readings import priority_rank


def match_keys(left: DataFrame, right: DataFrame, pairs: dict[str, str]) -> Column:
    """Null-safe equality of left columns with right columns."""
    condition = None
    for l, r in pairs.items():
        same = left[l].eqNullSafe(right[r])
        condition = same if condition is None else condition & same
    return condition


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first by ``order``, which should be total to be repeatable."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(window)).where("_place = 1").drop("_place")


def rows_at_best(
    df: DataFrame, keys: Sequence[str], value: str, best: Column, keep_null: bool = True
) -> DataFrame:
    """All rows whose ``value`` equals the key's ``best`` aggregate, ties kept.

    With ``keep_null`` a key whose best is null keeps its null rows, as a rank would. The input is
    read twice, which suits a stored table: a derived one should be written first.
    """
    names = {k: f"_key_{i}" for i, k in enumerate(keys)}
    bests = df.groupBy(*keys).agg(best.alias("_best"))
    bests = bests.withColumnsRenamed(names)
    same = df[value].eqNullSafe(bests["_best"]) if keep_null else df[value] == bests["_best"]
    return df.join(bests, match_keys(df, bests, names) & same, "left_semi")


def keep_latest(
    df: DataFrame, keys: Sequence[str], day: str, rename: str | None = None
) -> DataFrame:
    """Rows on the key's newest date, all ties kept, null dates dropped."""
    dated = df.withColumn(day, F.to_date(day))
    latest = rows_at_best(dated, keys, day, F.max(day), keep_null=False)
    return latest.withColumnRenamed(day, rename) if rename else latest


def latest_version(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Rows of the key's highest version, ties kept."""
    return rows_at_best(df, keys, version, F.max(version))


def latest_non_null(df: DataFrame, keys: Sequence[str], day: str, value: str) -> DataFrame:
    """Of the rows with a value, those on the key's newest date, ties kept."""
    valued = df.where(F.col(value).isNotNull()).select(day, *keys, value)
    return rows_at_best(valued, keys, day, F.max(day))


def latest_prefer_non_null(df: DataFrame, keys: Sequence[str], day: str, value: str) -> DataFrame:
    """Rows on the newest date among those with a value; keys without any value keep their newest.

    One aggregate finds, per key, whether any value exists and the newest date of that kind.
    """
    rows = df.select(day, *keys, value, F.col(value).isNotNull().alias("_valued"))
    names = {k: f"_key_{i}" for i, k in enumerate(keys)}
    best = (
        rows.groupBy(*keys)
        .agg(
            F.max("_valued").alias("_any"),
            F.max(F.when(F.col("_valued"), F.col(day))).alias("_newest_valued"),
            F.max(day).alias("_newest"),
        )
        .withColumnsRenamed(names)
    )
    best = best.select(
        *names.values(),
        "_any",
        F.when(F.col("_any"), F.col("_newest_valued")).otherwise(F.col("_newest")).alias("_best"),
    )
    kept = match_keys(rows, best, {**names, "_valued": "_any", day: "_best"})
    return rows.join(best, kept, "left_semi").drop("_valued")


def priority_source(
    df: DataFrame,
    keys: Sequence[str],
    day: str,
    source: str,
    value: str,
    order: Sequence[str],
    legacy: bool = False,
) -> DataFrame:
    """One value per key: newest date, then best source, then only if that is a single value.

    Repeats of a value count once, also those of several sources that share a place (unknown ones
    do); the alphabetically last of these sources is named. ``legacy`` counts rows, so that a
    repeated value loses the key, and sorts unknown sources first. A key whose best place holds no value or several is absent.
    The rows are first counted per distinct value, which leaves little to compare even for a key
    with very many rows.
    """
    tally = df.groupBy(*keys, day, source, value).agg(F.count("*").alias("_rows"))
    held = F.col(value).isNotNull()
    place = priority_rank(F.col(source), order, legacy)
    count = F.sum(F.when(held, F.col("_rows"))) if legacy else F.count_distinct(value)
    places = (
        tally.where(F.col(day).isNotNull())
        .groupBy(*keys, day, place.alias("_place"))
        .agg(
            count.alias("_count"),
            F.max(F.when(held, F.col(source))).alias(source),
            F.max(value).alias(value),
        )
    )
    best = first_per_key(
        places, keys, [F.col(day).desc(), F.col("_place").asc_nulls_first()]
    )
    return best.where("_count = 1").select(*keys, source, day, value)


def _values_per_key(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count_distinct(value).alias("_values"),
        F.max(value).alias(value),
        F.max(F.col(value).isNull()).alias("_null"),
    )


def _with_null_row(value: str) -> Column:
    """The value, and a second, null row where the key has rows without a value."""
    lone = F.array(value)
    both = F.array(F.col(value), F.lit(None))
    return F.explode(F.when(F.col("_null"), both).otherwise(lone)).alias(value)


def drop_conflicts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Distinct (keys, value) rows of the keys that hold exactly one value."""
    single = _values_per_key(df, keys, value).where("_values = 1")
    return single.select(*keys, _with_null_row(value))


def null_conflicts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Distinct (keys, value) rows; keys with several values, or none, get a single null row."""
    values = _values_per_key(df, keys, value)
    single = F.col("_values") == 1
    values = values.withColumns(
        {value: F.when(single, F.col(value)), "_null": single & F.col("_null")}
    )
    return values.select(*keys, _with_null_row(value))


def dedup_ladder(
    df: DataFrame,
    keys: Sequence[str],
    extract_day: str,
    journal: str,
    journal_day: str,
    tie_columns: Sequence[str],
    no_nulls_in: Sequence[str] = (),
    derived: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One extract row per key, by a ladder of rules in one sort.

    Newest extract (unless it is a key); newest journal entry; no nulls in ``no_nulls_in``; longest
    journal; then ``tie_columns`` ascending with nulls last. Rows that share the first place after that are
    ordered by hashes of the whole row, the journal included, so that the result does not depend on the
    order of rows: only rows alike in everything are left to chance, and they are interchangeable. No hash
    is made of other rows. A rule that every remaining row
    of a key fails (a missing or empty journal, a null in ``no_nulls_in``) removes the key, so these
    are tested on the winner. ``derived`` tells how columns follow from the others, which spares them
    the shuffle: they are made again for the rows in first place.
    """
    derived = dict(derived or {})
    newest_entry = F.array_max(F.col(f"{journal}.{journal_day}"))
    incomplete = F.lit(False)
    for c in no_nulls_in:
        incomplete = incomplete | F.col(c).isNull()
    rows = df.drop(*derived).withColumns({"_newest_entry": newest_entry, "_incomplete": incomplete, "_length": F.size(journal)})
    ladder = [
        F.col("_newest_entry").desc_nulls_last(),
        F.col("_incomplete").asc(),
        F.col("_length").desc(),
        *(F.col(c).asc_nulls_last() for c in tie_columns),
    ]
    if extract_day not in keys:
        ladder.insert(0, F.col(extract_day).desc_nulls_last())
        rows = rows.where(F.col(extract_day).isNotNull())
    # Rows that share the first place; of every other key there is one.
    place = F.rank().over(Window.partitionBy(*keys).orderBy(*ladder))
    best = rows.withColumn("_rank", place).where("_rank = 1").drop("_rank")
    best = best.withColumns(derived) if derived else best
    winner = first_per_key(best, keys, [F.xxhash64(*df.columns), F.hash(*df.columns)])
    complete = F.col("_newest_entry").isNotNull() & ~F.col("_incomplete")
    return winner.where(complete).select(*df.columns)


def dedup_deaths(
    df: DataFrame, keys: Sequence[str], died: str, registered: str, record_id: str
) -> DataFrame:
    """One death per key: earliest death, newest registration, smallest record id."""
    order = [
        F.col(died).asc_nulls_first(),
        F.col(registered).desc_nulls_last(),
        F.col(record_id).asc_nulls_first(),
    ]
    return first_per_key(df, keys, order)


def dedup_latest_entry(
    df: DataFrame,
    keys: Sequence[str],
    extract_day: str,
    newest: bool = True,
    ties: Sequence[str] = (),
) -> DataFrame:
    """One row per key from the newest (or oldest) extract; ``keys`` may hold an array column.

    Equal dates are decided by ``ties``, then by the remaining columns; see :func:`rest_of`.
    """
    day = F.col(extract_day)
    order = [day.desc_nulls_last() if newest else day.asc_nulls_first()]
    order += [F.col(c).asc_nulls_last() for c in ties]
    return first_per_key(df, keys, order + rest_of(df, [*keys, extract_day, *ties]))


def rest_of(df: DataFrame, used: Sequence[str]) -> list[Column]:
    """The columns not used yet, as a last order that makes a choice repeatable.

    Columns that cannot be compared count by their hash.
    """
    left = [f for f in df.schema if f.name not in used]
    plain = [F.col(f.name).asc_nulls_last() for f in left if not isinstance(f.dataType, T.MapType)]
    hashed = [F.xxhash64(F.map_entries(f.name)).asc() for f in left if isinstance(f.dataType, T.MapType)]
    return plain + hashed


def first_or_last(
    df: DataFrame, keys: Sequence[str], day: str, last: bool = True, ties: Sequence[str] = ()
) -> DataFrame:
    """The first or the last row of each key by date; equal dates as in :func:`dedup_latest_entry`."""
    return dedup_latest_entry(df, keys, day, newest=last, ties=ties)


def latest_with_start(
    df: DataFrame, keys: Sequence[str], day: str, start: str, ties: Sequence[str] = ()
) -> DataFrame:
    """The last row of each key, together with the key's first date, in one aggregate.

    Equal dates are decided by the largest ``ties``, then by the largest remaining columns.
    """
    others = [c for c in df.columns if c not in keys]
    maps = [f.name for f in df.schema if isinstance(f.dataType, T.MapType)]
    rest = [c for c in others if c not in (day, *ties) and c not in maps]
    rank = F.struct(F.col(day), *(F.col(c) for c in [*ties, *rest]))
    both = df.groupBy(*keys).agg(
        F.max_by(F.struct(*others), rank).alias("_last"), F.min(day).alias(start)
    )
    return both.select(*keys, "_last.*", start)


def top_by_date(df: DataFrame, day: str, n: int = 1, ties: Sequence[str] = ()) -> DataFrame:
    """The ``n`` newest rows overall; every task keeps only its own ``n`` candidates."""
    return df.orderBy(F.col(day).desc_nulls_last(), *(F.col(c).asc() for c in ties)).limit(n)
