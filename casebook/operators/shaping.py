"""Renaming, typing, schema unification, unions."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebook.functions import codes, values

# The long table: one row per event, in this order.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("person_id", T.StringType()),
        T.StructField("birth_date", T.DateType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("sex", T.StringType()),
        T.StructField("dataset", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("record_start_date", T.DateType()),
        T.StructField("record_end_date", T.DateType()),
        T.StructField("lsoa", T.StringType()),
        T.StructField("ethnicity", T.StringType()),
        T.StructField("code", T.StringType()),
        T.StructField("flag", T.StringType()),
        T.StructField("code_array", T.ArrayType(T.StringType())),
        T.StructField("flag_assoc", T.ArrayType(T.StringType())),
        T.StructField("record_id_assoc", T.ArrayType(T.StringType())),
    ]
)


def column_type(df: DataFrame, name: str) -> type[T.DataType]:
    """Type class of a column; dotted names reach into structs."""
    if name.endswith("."):
        raise ValueError(f"not a column name: {name}")
    return type(df.select(name).schema[0].dataType)


def check_type(df: DataFrame, name: str, *expected: type[T.DataType]) -> None:
    """Raise TypeError unless the column has one of the expected type classes."""
    found = column_type(df, name)
    if found not in expected:
        wanted = ", ".join(t.__name__ for t in expected)
        raise TypeError(f"column {name} is {found.__name__}, expected {wanted}")


# What each target type may be cast from.
_CASTABLE = {
    "short": (T.ShortType, T.IntegerType, T.LongType, T.StringType),
    "int": (T.ShortType, T.IntegerType, T.LongType, T.DoubleType, T.StringType),
    "date": (T.DateType, T.TimestampType, T.TimestampNTZType),
    "string": None,
}


def ensure_types(df: DataFrame, targets: Mapping[str, str]) -> DataFrame:
    """Cast columns to short, int, date or string after a check of what they are.

    A value that does not fit the target becomes null.
    """
    for name, target in targets.items():
        if _CASTABLE[target]:
            check_type(df, name, *_CASTABLE[target])
    return df.withColumns({name: F.col(name).try_cast(t) for name, t in targets.items()})


def rename_map(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns; absent ones are ignored, which also repairs schema drift."""
    return df.withColumnsRenamed(dict(names))


def add_source_label(df: DataFrame, name: str, column: str = "dataset") -> DataFrame:
    """Add the name of the dataset as a constant column."""
    return df.withColumn(column, F.lit(name))


def unify_schema(
    df: DataFrame,
    mapping: Mapping[str, Column | str | None],
    schema: T.StructType = EVENT_SCHEMA,
) -> DataFrame:
    """Project a source onto a common schema in one select.

    Each target column is fed by a source column name, an expression, or None for null; targets
    that are not mentioned are null, and so are values that do not fit the target's type. A target
    that is no column of the schema is an error.
    """
    unknown = set(mapping) - set(schema.names)
    if unknown:
        raise ValueError(f"not in the schema: {sorted(unknown)}")
    feeds = []
    for field in schema:
        feed = mapping.get(field.name)
        source = F.col(feed) if isinstance(feed, str) else F.lit(None) if feed is None else feed
        feeds.append(source.try_cast(field.dataType).alias(field.name))
    return df.select(*feeds)


def null_if_in(df: DataFrame, columns: str | Sequence[str], unwanted) -> DataFrame:
    """Null out the listed values in one or many columns."""
    columns = [columns] if isinstance(columns, str) else columns
    unwanted = [unwanted] if isinstance(unwanted, str) else unwanted
    return df.withColumns({c: values.null_if_in(F.col(c), unwanted) for c in columns})


def coalesce_id(df: DataFrame, out: str, confirmed: str, unconfirmed: str) -> DataFrame:
    """The confirmed id, else the unconfirmed one; rows with neither go, and both sources."""
    found = F.coalesce(confirmed, unconfirmed)
    return df.withColumn(out, found).where(F.col(out).isNotNull()).drop(confirmed, unconfirmed)


def add_hash_key(
    df: DataFrame, out: str, columns: Sequence[str], null_token: str | None = None
) -> DataFrame:
    """Add a SHA-256 key over columns; see :func:`casebook.functions.values.hash_key`."""
    return df.withColumn(out, values.hash_key(*columns, null_token=null_token))


def make_array(df: DataFrame, out: str, columns: Sequence[str], drop: bool = True) -> DataFrame:
    """Pack columns of one type into an array, nulls kept in place."""
    kinds = {df.schema[c].dataType for c in columns}
    if len(kinds) > 1:
        raise TypeError(f"columns of different types: {', '.join(map(str, kinds))}")
    packed = df.withColumn(out, F.array(*columns))
    return packed.drop(*columns) if drop else packed


def split_to_array(df: DataFrame, column: str, delimiter: str = ",") -> DataFrame:
    """Split delimited text into an array; the column must be text."""
    check_type(df, column, T.StringType)
    return df.withColumn(column, F.split(column, delimiter))


def concat_code_columns(df: DataFrame, out: str, prefix: str, count: int = 12) -> DataFrame:
    """Numbered code columns ``PREFIX01..`` as comma text, nulls skipped."""
    return df.withColumn(out, F.concat_ws(",", *(f"{prefix}{i:02d}" for i in range(1, count + 1))))


def normalise_code(df: DataFrame, column: str, invalid: str | None = None) -> DataFrame:
    """Cut codes to the level in the column's name and drop rows without a code.

    At level 4 the four-character code stays in ``<column>_full`` and rows with the ``invalid`` code
    are dropped.
    """
    level = codes.code_level(column)
    bare = F.translate(F.col(column), " ", "")
    if level == 4:
        df = df.withColumn(f"{column}_full", F.substring(bare, 1, 4))
        if invalid is not None:
            df = df.where(bare != invalid)
    return df.withColumn(column, codes.normalise_code(F.col(column), level)).where(
        F.col(column).isNotNull()
    )


def restore_full_code(df: DataFrame, column: str) -> DataFrame:
    """Put the four-character code kept by :func:`normalise_code` back, where there is one."""
    full = f"{column}_full"
    return df.withColumn(column, F.col(full)).drop(full) if full in df.columns else df


def fill_missing_columns(df: DataFrame, names: Sequence[str], suffix: str = "") -> DataFrame:
    """Add absent columns as null dates, then append the suffix to all of the names."""
    absent = {n: F.lit(None).cast("date") for n in names if n not in df.columns}
    return df.withColumns(absent).withColumnsRenamed({n: f"{n}{suffix}" for n in names})


def generalise_birth_date(df: DataFrame, birth: str = "birth_date", out: str = "birth_year"):
    """Replace a birth date by its year."""
    return df.withColumn(birth, F.date_format(birth, "y")).withColumnRenamed(birth, out)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; frames must have the same columns. Duplicates stay."""
    return reduce(DataFrame.unionByName, frames)
