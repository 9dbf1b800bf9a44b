"""Reading tables, families of yearly tables, snapshots and CSV files."""

import re
from collections.abc import Iterable, Mapping, Sequence
from datetime import date
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebook.operators.shaping import rename_map, union_all
from casebook.sources.published import Published
from casebook.sources.writers import hard_cache

# Yearly tables starting before this two-digit year come from the old store.
NEW_STORE_YEAR = 21
SNAPSHOT_DATE = r"\d{4}_\d{2}_\d{2}"


def read_source(spark: SparkSession, source: str, columns: Sequence[str] | None = None):
    """A table of the catalog, the newest version of a published table, or the Parquet files below a path."""
    if "/" not in source:
        df = spark.table(source)
    else:
        table = Published(spark, source)
        df = table.read() if table.exists() else spark.read.parquet(source)
    return df.select(*columns) if columns else df


def read_csv_nulls(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """A CSV file with a header; every column is text, empty text is null."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.csv(path, header=True, schema=schema, nullValue="", enforceSchema=False)


def table_names(spark: SparkSession, database: str) -> list[str]:
    """Names of the tables of a database."""
    return [t.name for t in spark.catalog.listTables(database)]


def yearly_tables(spark: SparkSession, database: str, prefix: str) -> dict[str, DataFrame]:
    """``{YYZZ: table}`` of the tables named ``prefix_YYZZ``."""
    pattern = re.compile(rf"{re.escape(prefix.rstrip('_'))}_(\d{{4}})")
    found = {n: pattern.fullmatch(n) for n in table_names(spark, database)}
    return {m.group(1): spark.table(f"{database}.{n}") for n, m in found.items() if m}


def read_csv_checked(
    spark: SparkSession, path: str, columns: Sequence[str], separator: str = ",", header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """The good rows of CSV files, and the lines that are none: (file, line, reason).

    Good rows are as from :func:`read_csv_nulls`. A line is rejected if it has fewer or more fields than
    there are columns, or quotes that do not match; each line is either a row or a reject. Empty lines
    are neither. What was read is stored once, so that both come from the same reading.
    """
    whole = "_line"
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, whole]])
    read = spark.read.csv(
        path, header=header, schema=schema, nullValue="", sep=separator, mode="PERMISSIVE", columnNameOfCorruptRecord=whole,
    )
    read = hard_cache(read.select(*columns, whole, F.col("_metadata.file_path").alias("_file")), "csv-lines")
    line = F.col(whole)
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    # Separators within quotes part no fields.
    bare = F.regexp_replace(line, '"[^"]*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(separator), F.lit(""))) + 1
    reason = (
        F.when(quotes % 2 == 1, "quotes do not match")
        .when(fields < len(columns), "fewer fields")
        .when(fields > len(columns), "more fields")
        .otherwise("not readable")
    )
    rejected = read.where(line.isNotNull()).select(
        F.col("_file").alias("file"), line.alias("line"), reason.alias("reason")
    )
    return read.where(line.isNull()).select(*columns), rejected


def by_year(df: DataFrame, column: str) -> dict[int | None, DataFrame]:
    """The rows of each year that occurs, from a copy stored by year: a year reads only its own.

    Rows without a year are kept under None.
    """
    kept = hard_cache(df, "years", [column])
    years = [r[0] for r in kept.select(column).distinct().collect()]
    ordered = sorted((y for y in years if y is not None), key=int) + [None] * (None in years)
    return {
        y if y is None else int(y): kept.where(F.col(column).eqNullSafe(F.lit(y))).select(*df.columns)
        for y in ordered
    }


def yearly_paths(spark: SparkSession, root: str, prefix: str) -> dict[str, str]:
    """``{YYZZ: path}`` of the folders named ``prefix_YYZZ`` or ``prefix=YYZZ`` below a folder, by their names alone."""
    pattern = re.compile(rf"{re.escape(prefix.rstrip('_'))}[_=](\d{{4}})")
    found = {n: pattern.fullmatch(n) for n in folder_names(spark, root)}
    return {m.group(1): f"{root.rstrip('/')}/{n}" for n, m in found.items() if m}


def folder_names(spark: SparkSession, root: str) -> list[str]:
    """Names of the folders right below a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in files.listStatus(path) if s.isDirectory())


def scan_yearly(
    spark: SparkSession,
    old: Mapping[str, str],
    new: Mapping[str, str],
    start: int,
    end: int,
    columns: Sequence[str] | None = None,
    renames: Mapping[str, str] | None = None,
    drop: Sequence[str] = (),
    year: str | None = None,
) -> DataFrame:
    """The yearly tables from ``start`` to ``end`` (two-digit years), as :func:`union_yearly`, in one scan.

    Both stores are ``{YYZZ: path}``; only folders of the years asked for are read. Columns that are named
    otherwise in some years (``renames``) are read under all their names and put together, so the plan
    stays the same however many years there are. Columns that only some years have are null in the others.
    ``year`` names a column for the year, text YYZZ, from the files' names.
    """
    chosen = {}
    for suffix in sorted({*old, *new}):
        first, last = int(suffix[:2]), int(suffix[2:])
        if start <= first < end and last <= end:
            chosen[suffix] = (old if first < NEW_STORE_YEAR else new)[suffix]
    if not chosen:
        raise ValueError(f"no yearly table between {start} and {end}")
    # The names and types come from one file of each folder, no data is read for them.
    fields: dict[str, T.DataType] = {}
    for suffix, path in chosen.items():
        for f in spark.read.parquet(path).schema:
            if fields.setdefault(f.name, f.dataType) != f.dataType:
                raise ValueError(f"{f.name} is {f.dataType.simpleString()} in {suffix}, {fields[f.name].simpleString()} before")
    schema = T.StructType([T.StructField(n, k) for n, k in fields.items()])
    rows = spark.read.schema(schema).parquet(*chosen.values())
    sources: dict[str, list[str]] = {}
    for name in fields:
        sources.setdefault((renames or {}).get(name, name), []).append(name)
    wanted = [(renames or {}).get(c, c) for c in columns] if columns else list(sources)
    found = [F.coalesce(*(F.col(f"`{n}`") for n in sources[c])).alias(c) for c in dict.fromkeys(wanted) if c not in drop]
    if year:
        found.append(F.regexp_extract("_metadata.file_path", r"[_=](\d{4})/[^/]*$", 1).alias(year))
    return rows.select(*found)


def union_yearly(
    old: Mapping[str, DataFrame],
    new: Mapping[str, DataFrame],
    start: int,
    end: int,
    columns: Sequence[str] | None = None,
    renames: Mapping[str, str] | None = None,
    drop: Sequence[str] = (),
) -> DataFrame:
    """One frame of the yearly tables from ``start`` to ``end`` (two-digit years).

    Both stores are ``{YYZZ: table}``. The store is chosen by the year; drifted column names are
    repaired; all years must then have the same columns.
    """
    frames = []
    for suffix in sorted({*old, *new}):
        first, last = int(suffix[:2]), int(suffix[2:])
        if start <= first < end and last <= end:
            df = (old if first < NEW_STORE_YEAR else new)[suffix]
            df = df.select(*columns) if columns else df
            frames.append(rename_map(df, renames or {}))
    if not frames:
        raise ValueError(f"no yearly table between {start} and {end}")
    return union_all(frames).drop(*drop)


def latest_year(df: DataFrame, year: Column) -> DataFrame:
    """One row, ``latest_year``."""
    return df.agg(F.max(year).alias("latest_year"))


def latest_table_year(names: Iterable[str], prefix: str, today: date) -> int:
    """Largest two-digit end year among ``prefix…_YYZZ`` names; must be this year or the next."""
    pattern = re.compile(rf"{re.escape(prefix)}.*_\d\d(\d\d)")
    years = [int(m.group(1)) for m in map(pattern.fullmatch, names) if m]
    if not years or max(years) not in (today.year % 100, (today.year + 1) % 100):
        raise ValueError(f"latest year of {prefix} is {max(years, default=None)}: out of date")
    return max(years)


def latest_snapshot(df: DataFrame, day: str) -> DataFrame:
    """Rows of the newest snapshot. The newest date is a scalar subquery and reaches the scan."""
    return df.where(F.col(day) == df.select(F.max(day)).scalar())


def newest_partition(spark: SparkSession, root: str, column: str) -> DataFrame:
    """The rows of the greatest value of a partition column, found by the names of the folders.

    No data is read to learn which it is, and of the table only that folder is read. Folders without a
    value do not count; values are compared as the column's type. A table without values is an error.
    """
    table = spark.read.parquet(root)
    kind = table.schema[column].dataType.simpleString()
    names = [unquote(n.split("=", 1)[1]) for n in folder_names(spark, root) if n.startswith(f"{column}=")]
    known = [n for n in names if n != "__HIVE_DEFAULT_PARTITION__"]
    if not known:
        raise ValueError(f"{root} has no values of {column}")
    value = F.lit(max(known)) if kind in ("string", "date") else F.lit(max(known, key=float)).cast(kind)
    return table.where(F.col(column) == (value.cast("date") if kind == "date" else value))


def snapshot_date(name: Column) -> Column:
    """The ``YYYY_MM_DD`` in a table or file name as a date."""
    return F.try_to_date(F.regexp_extract(name, f"({SNAPSHOT_DATE})", 1), "yyyy_MM_dd")


def latest_table(names: Iterable[str], contains: str, without: Sequence[str] = ()) -> str:
    """The name with the newest date among those that contain a text and none of the others."""
    fit = [n for n in names if contains in n and not any(w in n for w in without)]
    dated = [(re.search(SNAPSHOT_DATE, n), n) for n in fit]
    found = [(m.group(0), n) for m, n in dated if m]
    if not found:
        raise ValueError(f"no dated table named like {contains}")
    return max(found)[1]


def partner_table(name: str, prefix: str, partner: str) -> str:
    """``prefix_DATE_version`` to ``prefix_partner_DATE_version``."""
    found = re.fullmatch(rf"{re.escape(prefix)}_({SNAPSHOT_DATE})_(.*)", name)
    if not found:
        raise ValueError(f"{name} is not named {prefix}_DATE_version")
    return f"{prefix}_{partner}_{found.group(1)}_{found.group(2)}"


def sample_cohort(df: DataFrame, keys: Sequence[str], n: int, seed: int | None = None) -> DataFrame:
    """All rows of ``n`` people.

    Without a seed, the people with the smallest hash, which is the same set in every run; with one,
    a Bernoulli sample of about ``n``, cut to at most ``n`` (this counts the people first).
    """
    people = df.select(*keys).distinct()
    if seed is None:
        chosen = people.orderBy(F.sha2(F.concat_ws("||", *keys), 256), *keys).limit(n)
    else:
        chosen = people.sample(fraction=min(1.0, n / max(1, people.count())), seed=seed).limit(n)
    return df.join(chosen, list(keys), "left_semi")
