"""Writing tables, upserts, archives and audit fields."""

import json
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebook.functions.values import joined
from casebook.operators.quality import require_unique
from casebook.session import shared_dir
from casebook.sources.fingerprint import fingerprint
from casebook.sources.published import Published

AUDIT = "META"


def write_table(
    df: DataFrame, target: str, overwrite: bool = False, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Write to a path (or a catalog table) and return what was written.

    Without ``overwrite`` an existing target is an error. A path becomes a :class:`Published` table: what
    it held before stays readable, also while it is overwritten, and a write that dies leaves it as it was.
    """
    if "/" in target:
        table = Published(df.sparkSession, target)
        if table.exists() and not overwrite:
            raise ValueError(f"{target} exists")
        return table.overwrite(df, partition_by)
    writer = df.write.mode("overwrite" if overwrite else "errorifexists").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(target)
    return df.sparkSession.table(target)


def hard_cache(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write to the shared folder and read back: a cut in the lineage that outlives executors."""
    path = shared_dir(df.sparkSession, name)
    (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def stage(spark: SparkSession, below: str) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A function that writes rows below a path and reads them back, as long as the block lasts.

    What it wrote is removed at the end of the block, so nothing that reads it may be left to run later.
    """
    paths: list[str] = []

    def store(df: DataFrame) -> DataFrame:
        paths.append(f"{below.rstrip('/')}/_stage={uuid.uuid4().hex}")
        df.write.parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    try:
        yield store
    finally:
        for path in (spark._jvm.org.apache.hadoop.fs.Path(p) for p in paths):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def keep(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    observed: Mapping[str, Column] | None = None,
    check: Callable[[DataFrame], object] | None = None,
    staged: Callable[[Callable[[DataFrame], DataFrame]], DataFrame] | None = None,
) -> tuple[DataFrame, dict, bool]:
    """The published table of a product, written only if it was not made from the same inputs before.

    ``staged`` makes the same rows from stages that it stores with the function it is given (see
    :func:`stage`); the frame itself then only tells what they are made from.

    ``check`` and ``observed`` (aggregates, by name) are part of the write: rows that fail the check are not
    published, and the aggregates are gathered while the rows are written and kept with them. Returns the
    table, the aggregates, and whether it was written now. See :func:`fingerprint` for what counts as the same.
    """
    table = Published(df.sparkSession, path)
    made_from = fingerprint(df, partition_by, [str(c) for c in (observed or {}).items()])
    if made_from and table.exists():
        note = table.describe()["note"]
        if note.get("made_from") == made_from:
            return table.read(), note["observed"], False
    seen = Observation()
    values = lambda: {"made_from": made_from, "observed": dict(seen.get) if observed else {}}
    with stage(df.sparkSession, path) as store:
        rows = staged(store).select(*df.columns) if staged else df
        rows = rows.observe(seen, *(c.alias(n) for n, c in observed.items())) if observed else rows
        written = table.overwrite(rows, partition_by, values, check)
    return written, table.describe()["note"]["observed"], True


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target with the source's rows: replaced where keys match, added where not.

    Null keys match nothing, so such source rows are added. The result is to be written to a new
    place, since the target is still being read. Repeated keys in the source are an error.
    """
    missing = [k for k in keys if k not in target.columns or k not in source.columns]
    if missing or not keys:
        raise ValueError(f"key columns missing: {missing}")
    complete = source.na.drop(subset=list(keys))
    require_unique(complete, keys, "upsert source")
    return target.join(source, list(keys), "left_anti").unionByName(source)


def compact(df: DataFrame) -> DataFrame:
    """Even out partitions before a write.

    Spark sizes them by bytes (``spark.sql.adaptive.advisoryPartitionSizeInBytes``), joining small
    and splitting large ones.
    """
    return df.hint("rebalance")


def archive_path(root: str, name: str, day: date, version: str, params_version: str) -> str:
    """``root/name_YYYY_MM_DD_v<version>_cv<params>``."""
    return f"{root.rstrip('/')}/{name}_{day:%Y_%m_%d}_v{version}_cv{params_version}"


def archive_snapshot(df: DataFrame, path: str) -> DataFrame:
    """Copy a table to a versioned path; an archive that exists already is left as it is.

    An archive exists once it is published: one whose write died is made anew.
    """
    table = Published(df.sparkSession, path)
    return table.read() if table.exists() else table.overwrite(df)


def export_csv_ready(df: DataFrame) -> DataFrame:
    """Array columns as comma text; a column that CSV cannot hold after that is an error."""
    arrays = [f.name for f in df.schema if isinstance(f.dataType, T.ArrayType)]
    flat = df.withColumns({c: F.coalesce(joined(F.col(c)), F.lit("")) for c in arrays})
    nested = (T.ArrayType, T.MapType, T.StructType, T.BinaryType)
    bad = [f.name for f in flat.schema if isinstance(f.dataType, nested)]
    if bad:
        raise ValueError(f"columns that CSV cannot hold: {', '.join(bad)}")
    return flat


def write_csv(df: DataFrame, path: str) -> None:
    """Write the CSV-ready form with a header."""
    export_csv_ready(df).write.mode("overwrite").csv(path, header=True)


def add_audit(
    df: DataFrame,
    version: str,
    params_version: str,
    day: date,
    database: str,
    stage_index: int,
    params: Mapping,
    pipeline_definition: Sequence,
    seed: int = 0,
) -> DataFrame:
    """Add the ``META`` struct: where a row comes from, and a uniform number to sample by."""
    if AUDIT in df.columns:
        raise ValueError(f"{AUDIT} is there already")
    fields = {
        "version": F.lit(version),
        "params_version": F.lit(params_version),
        "date": F.lit(day),
        "database": F.lit(database),
        "stage_index": F.lit(stage_index),
        "params": F.lit(json.dumps(params, default=str, sort_keys=True)),
        "pipeline_definition": F.lit(json.dumps(pipeline_definition, default=str)),
        "sampling": F.rand(seed),
    }
    return df.withColumn(AUDIT, F.struct(*(v.alias(k) for k, v in fields.items())))
