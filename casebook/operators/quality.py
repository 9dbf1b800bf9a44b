"""Checks and counts. Each is one pass over its table, whatever the number of columns."""

from collections.abc import Mapping, Sequence
from itertools import zip_longest

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebook.operators.links import duplicate_keys

PASS, WARNING, FAIL = "pass", "warning", "fail"


def unique_check(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row, ``is_unique``. Null keys are equal to each other."""
    return duplicate_keys(df, columns).agg((F.count("*") == 0).alias("is_unique"))


def require_unique(df: DataFrame, columns: Sequence[str], what: str) -> DataFrame:
    """Raise if a key occurs twice, else return the frame. This runs a job.

    What is shuffled are 8-byte hashes of the keys: equal keys have equal hashes. Only where hashes
    repeat are the keys themselves compared, by a second pass over those rows.
    """
    mark = F.xxhash64(*columns)
    repeated = duplicate_keys(df.select(mark.alias("_mark")), ["_mark"])
    if repeated.isEmpty():
        return df
    suspects = df.withColumn("_mark", mark).join(repeated, "_mark", "left_semi")
    if not duplicate_keys(suspects, columns).isEmpty():
        raise ValueError(f"{what}: {', '.join(columns)} is not unique")
    return df


def max_entries_check(df: DataFrame, keys: Sequence[str], most: int = 3) -> DataFrame:
    """One row: does any key have more than ``most`` rows, and how many rows has the largest?"""
    counts = df.groupBy(*keys).agg(F.count("*").alias("rows"))
    largest = F.coalesce(F.max("rows"), F.lit(0))
    return counts.agg((largest <= most).alias("within_limit"), largest.alias("largest"))


def require_at_most(df: DataFrame, keys: Sequence[str], most: int, what: str) -> DataFrame:
    """Raise if a key has more than ``most`` rows, else return the frame. This runs a job."""
    if not df.groupBy(*keys).count().where(F.col("count") > most).isEmpty():
        raise ValueError(f"{what}: more than {most} rows for one {', '.join(keys)}")
    return df


def count_by(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per value of each column, as (criterion, value, rows), from one pass.

    The rows are counted per combination of values, and those few sums are split by column.
    """
    combined = df.groupBy(*columns).agg(F.count("*").alias("_rows"))
    pairs = F.array(
        *(F.struct(F.lit(c).alias("criterion"), F.col(c).cast("string").alias("value"))
          for c in columns)
    )
    return (
        combined.select(F.explode(pairs).alias("_pair"), "_rows")
        .groupBy("_pair.criterion", "_pair.value")
        .agg(F.sum("_rows").alias("rows"))
    )


def to_long(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """Aggregate to one row and turn it into (criterion, value) rows, values as text."""
    names = list(values)
    row = df.agg(*(v.cast("string").alias(f"_{i}") for i, v in enumerate(values.values())))
    pairs = F.array(
        *(F.struct(F.lit(n).alias("criterion"), F.col(f"_{i}").alias("value"))
          for i, n in enumerate(names))
    )
    return row.select(F.explode(pairs).alias("_pair")).select("_pair.*")


def non_null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, non_null, rows) for each column."""
    columns = list(columns or df.columns)
    row = df.agg(
        F.count("*").alias("_rows"), *(F.count(c).alias(f"_{i}") for i, c in enumerate(columns))
    )
    pairs = F.array(
        *(F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("non_null"))
          for i, c in enumerate(columns))
    )
    return row.select(F.explode(pairs).alias("_pair"), "_rows").select(
        "_pair.*", F.col("_rows").alias("rows")
    )


def all_null_columns(df: DataFrame) -> DataFrame:
    """Names of the columns that hold nothing but nulls."""
    return non_null_counts(df).where("non_null = 0").select("column_name")


def nulls_in_required(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, nulls) of the required columns that hold nulls."""
    counts = non_null_counts(df, columns).where("non_null < rows")
    return counts.select("column_name", (F.col("rows") - F.col("non_null")).alias("nulls"))


def value_set_diff(df: DataFrame, column: str, expected: Sequence[str]) -> DataFrame:
    """(value, status): expected values that are missing, present values that are extra."""
    found = df.groupBy(F.col(column).alias("value")).agg(F.lit(True).alias("_found"))
    rows = [(v, True) for v in expected]
    wanted = df.sparkSession.createDataFrame(rows, "value string, _wanted boolean")
    both = found.join(wanted, "value", "full")
    status = F.when(F.col("_found").isNull(), "missing").when(F.col("_wanted").isNull(), "extra")
    return both.select("value", status.alias("status")).where(F.col("status").isNotNull())


def is_empty(df: DataFrame) -> DataFrame:
    """One row, ``is_empty``; looks at one row of the table at most."""
    return df.limit(1).agg((F.count("*") == 0).alias("is_empty"))


def schema_differences(found: T.StructType, expected: T.StructType) -> list[str]:
    """Place-by-place differences of two schemas in name and type."""

    def describe(field: T.StructField | None) -> str:
        return f"{field.name} {field.dataType.simpleString()}" if field else "nothing"

    return [
        f"{describe(f)} instead of {describe(e)}"
        for f, e in zip_longest(found, expected)
        if describe(f) != describe(e)
    ]


def metrics(
    df: DataFrame,
    stage: str,
    person: Sequence[str],
    non_null: Mapping[str, str] | None = None,
    true_counts: Mapping[str, Column] | None = None,
    latest: Mapping[str, str] | None = None,
    count_columns: Sequence[str] = (),
) -> DataFrame:
    """(stage, criteria, value, category) rows about a table.

    Always the numbers of columns, rows and distinct people; then non-null counts, counts of true
    conditions and latest dates, each as ``{criterion: column}``; then rows per value of
    ``count_columns`` as ``<column>_<value>``.
    """
    people = F.count_distinct(F.struct(*person))
    values = {
        "col_count": F.lit(len(df.columns)),
        "row_count": F.count("*"),
        "distinct_person_count": people,
        **{name: F.count(c) for name, c in (non_null or {}).items()},
        **{name: F.count_if(c) for name, c in (true_counts or {}).items()},
        **{name: F.max(c) for name, c in (latest or {}).items()},
    }
    rows = to_long(df, values).withColumnRenamed("criterion", "criteria")
    if count_columns:
        per_value = count_by(df, count_columns).where(F.col("value").isNotNull())
        name = F.concat_ws("_", "criterion", "value")
        rows = rows.unionByName(
            per_value.select(name.alias("criteria"), F.col("rows").cast("string").alias("value"))
        )
    category = F.when(F.col("criteria").contains("time"), "timing").otherwise("counts")
    return rows.select(F.lit(stage).alias("stage"), "criteria", "value", category.alias("category"))


#: Registers of a sketch, as a power of two: a standard error of 0.65 %.
SKETCH = 14


def people_sketches(df: DataFrame, by: Sequence[str], person: Sequence[str]) -> DataFrame:
    """(by…, people): a mergeable sketch of the distinct people of each group, a few kilobytes each.

    Kept as a product, the sketches of any groups (snapshots, datasets) can be put together later without
    their rows. Rows without any part of the person count as one person, as in an exact count.
    """
    one = F.xxhash64(F.struct(*person))
    return df.groupBy(*by).agg(F.hll_sketch_agg(one, F.lit(SKETCH)).alias("people"))


def people_of(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by…, people): about how many distinct people the sketches hold together, by group or in all."""
    together = F.hll_sketch_estimate(F.hll_union_agg("people", F.lit(False)))
    return sketches.groupBy(*by).agg(together.alias("people"))
