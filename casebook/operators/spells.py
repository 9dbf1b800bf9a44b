"""Episodes to spells. A spell is every episode with one spell id."""

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.constants import (
    INVALID_IDS,
    LINK,
    MULTIPLE,
    NO_MATCH,
    PLACEHOLDER_DATES,
    PLACEHOLDER_SPELL_ID,
    UNKNOWN_ETHNICITY,
)
from casebook.functions.values import null_if_in
from casebook.operators.latest import match_keys
from casebook.operators.links import attach, eligible_only
from casebook.operators.shaping import null_if_in as null_columns

def spell_bounds(
    df: DataFrame,
    spell_id: str = "spell_id",
    start: str = "admission_date",
    end: str = "discharge_date",
    out: tuple[str, str] = ("spell_start", "spell_end"),
    placeholders: Iterable[str] = PLACEHOLDER_DATES,
    bad_ids: Iterable[str] = (PLACEHOLDER_SPELL_ID,),
    people: DataFrame | None = None,
    on: Sequence[str] = LINK,
) -> DataFrame:
    """Add a spell's first start and last end to each of its episodes.

    Placeholder dates and placeholder spell ids become null before anything is compared, so they
    decide no date, and the many rows under a placeholder id form no group. The dates come from an
    aggregate that is joined back; rows without a spell id get none. ``people`` cuts the episodes that are
    returned to theirs; the dates still come from all of them. Who is among them is asked once per spell and
    person, and the join with the dates does the cut, so whole episodes are shuffled once.
    """
    clean = null_columns(df, [start, end], [*placeholders])
    clean = null_columns(clean, spell_id, [*bad_ids])
    held = clean.where(F.col(spell_id).isNotNull())
    bounds = held.groupBy(spell_id).agg(F.min(start).alias(out[0]), F.max(end).alias(out[1]))
    if people is None:
        return attach(clean, bounds, [spell_id])
    theirs = eligible_only(held.select(spell_id, *on).distinct(), people, on).join(bounds, [spell_id])
    columns = [spell_id, *(c for c in clean.columns if c != spell_id), *out]
    dated = held.join(theirs, [spell_id, *on]).select(*columns)
    lone = eligible_only(clean.where(F.col(spell_id).isNull()), people, on)
    none = {c: F.lit(None).cast(theirs.schema[c].dataType) for c in out}
    return dated.unionByName(lone.withColumns(none).select(*columns))


def _newest_first(day: str, *ties: str) -> Column:
    """A struct that is smallest for the newest date; null dates are last."""
    age = -F.datediff(F.col(day), F.lit("1970-01-01"))
    return F.struct(F.coalesce(age, F.lit(2**31 - 1)), *(F.col(t) for t in ties))


def latest_value(df: DataFrame, keys: Sequence[str], value: str, day: str) -> DataFrame:
    """Write the value of each key's newest row that has one to all its rows.

    Values of the same day are decided by the smallest.
    """
    held = df.where(F.col(value).isNotNull())
    newest = held.groupBy(*keys).agg(F.min_by(value, _newest_first(day, value)).alias("_value"))
    return _spread_value(df, newest, keys, value)


def _spread_value(df: DataFrame, found: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    names = {k: f"_key_{i}" for i, k in enumerate(keys)}
    found = found.withColumnsRenamed(names)
    joined = df.join(found, match_keys(df, found, names), "left")
    columns = [F.col("_value").alias(c) if c == value else df[c] for c in df.columns]
    return joined.select(*columns)


def modal_values(
    df: DataFrame, keys: Sequence[str], day: str, unwanted: Mapping[str, Iterable[str]]
) -> DataFrame:
    """Most frequent wanted value of several columns, one row per key.

    ``unwanted`` lists, per column, the values that do not count. Equal counts are decided by the
    earliest date, then by the largest value. Rows are counted per column (by its place) and value
    in the tasks that read them, which leaves few rows per key to shuffle; the best value per column
    is taken from the sums.
    """
    columns = list(unwanted)
    pairs = [
        F.struct(F.lit(i).alias("column"), null_if_in(F.col(c).cast("string"), bad).alias("text"))
        for i, (c, bad) in enumerate(unwanted.items())
    ]
    counts = (
        df.select(*keys, F.col(day).alias("_day"), F.explode(F.array(*pairs)).alias("_pair"))
        .where("_pair.text is not null")
        .groupBy(*keys, F.col("_pair.column").alias("_column"), F.col("_pair.text").alias("_text"))
        .agg(F.count("*").alias("_rows"), F.min("_day").alias("_first"))
    )
    since = F.datediff(F.col("_first"), F.lit("1970-01-01"))
    order = F.struct(F.col("_rows"), F.coalesce(-since, F.lit(2**31 - 1)), F.col("_text"))
    best = []
    for i, c in enumerate(columns):
        here = F.col("_column") == i
        value = F.max_by(F.when(here, F.col("_text")), F.when(here, order))
        best.append(value.cast(df.schema[c].dataType).alias(c))
    return counts.groupBy(*keys).agg(*best)


def modal_value(
    df: DataFrame, keys: Sequence[str], value: str, day: str, unwanted: Iterable[str] = ()
) -> DataFrame:
    """Write each key's most frequent valid value to all its rows; see :func:`modal_values`."""
    found = modal_values(df, keys, day, {value: list(unwanted)})
    return _spread_value(df, found.withColumnRenamed(value, "_value"), keys, value)


def spell_members(
    df: DataFrame, spell_id: str = "spell_id", record_id: str = "record_id"
) -> DataFrame:
    """The distinct (spell, episode) pairs: the long form of a spell's episode array."""
    return df.where(F.col(spell_id).isNotNull()).select(spell_id, record_id).distinct()


def collapse_spell(
    df: DataFrame,
    spell_id: str = "spell_id",
    record_id: str = "record_id",
    day: str = "record_start_date",
    start: str = "spell_start",
    end: str = "spell_end",
    first_row: Sequence[str] = ("sex", "dataset"),
    modal: Mapping[str, Iterable[str]] | None = None,
) -> DataFrame:
    """One row per spell.

    Sorted distinct episode ids, codes and flags; all diagnosis codes as ``all_codes``; newest area
    code; most frequent valid birth date, person and ethnicity; other columns from the first
    episode. Codes and flags come from fixed lists, so their sets stay small; of the code arrays each
    task keeps a spell's distinct ones, which are never more than its ids. The ids of a spell
    are the feature and are listed in full, whatever their number; :func:`spell_members` holds the
    same ids as rows.
    """
    if modal is None:
        modal = {
            "birth_date": PLACEHOLDER_DATES,
            "person_id": INVALID_IDS,
            "ethnicity": UNKNOWN_ETHNICITY,
        }
    episodes = df.withColumns({c: F.col(c).cast("string") for c in (spell_id, record_id)})
    every_code = F.array_distinct(F.flatten(F.collect_set("code_array")))
    earliest = F.struct(F.coalesce(F.col(day), F.lit("9999-12-31").cast("date")), record_id)
    spells = episodes.groupBy(spell_id).agg(
        F.min(start).alias(start),
        F.max(end).alias(end),
        F.array_sort(F.collect_set(record_id)).alias(record_id),
        F.array_sort(F.collect_set("code")).alias("code"),
        F.array_sort(F.collect_set("flag")).alias("flag"),
        F.min_by(
            "lsoa", F.when(F.col("lsoa").isNotNull(), _newest_first(day, "lsoa"))
        ).alias("lsoa"),
        F.array_sort(F.array_compact(every_code)).alias("all_codes"),
        F.min_by(F.struct(*first_row), earliest).alias("_first"),
    )
    people = modal_values(episodes, [spell_id], day, modal)
    whole = spells.join(people, [spell_id], "left")
    return whole.select(*(c for c in whole.columns if c != "_first"), "_first.*")


def summarise_multi(
    df: DataFrame, code: str = "code", flag: str = "flag", multiple: str = MULTIPLE
) -> DataFrame:
    """Turn the code and flag arrays into one value each.

    One value stays, several become ``multiple``, none becomes "no match"; the "no match" marker
    itself does not count. ``code_array`` and ``flag_assoc`` keep arrays of more than one entry as
    they were.
    """

    def single(column: str) -> Column:
        real = F.array_remove(column, NO_MATCH)
        value = (
            F.when(F.size(real) > 1, F.lit(multiple))
            .when(F.size(real) == 1, F.get(real, F.lit(0)))
            .otherwise(F.lit(NO_MATCH))
        )
        return null_if_in(value, [""])

    def several(column: str) -> Column:
        return F.when(F.size(column) > 1, F.col(column))

    return df.withColumns(
        {
            "code_array": several(code),
            "flag_assoc": several(flag),
            code: single(code),
            flag: single(flag),
        }
    )


def spell_pipeline(
    df: DataFrame,
    spell_id: str = "spell_id",
    record_id: str = "record_id",
    start: str = "spell_start",
    end: str = "spell_end",
    gather: bool = False,
    **options,
) -> DataFrame:
    """Spells of the episodes that have a spell id and spell dates, ready for the event schema.

    ``gather`` deals the episodes by spell before anything is summed, for those that are read from a table:
    no later step then shuffles. A spell's ids meet in one task in either case. Episodes that come from a join
    on the spell id lie so already.
    """
    usable = df.na.drop(subset=[spell_id, start, end])
    if gather:
        # As text, which is what they are grouped by.
        usable = usable.withColumn(spell_id, F.col(spell_id).cast("string")).repartition(spell_id)
    spells = collapse_spell(usable, spell_id, record_id, start=start, end=end, **options)
    return summarise_multi(spells).withColumnRenamed(record_id, "record_id_assoc")


def episodes_with_methods(df: DataFrame, method: str = "admission_method") -> DataFrame:
    """Episodes with the admission methods as associated flags."""
    return df.withColumn("flag_assoc", F.split(method, ",")).drop(method)
