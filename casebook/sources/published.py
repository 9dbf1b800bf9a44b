"""Tables that are published version by version.

A write goes to a folder of its own below the table's; a small file then names the files of the new
version and is moved to its place in one step that fails if the place is taken. So a reader sees a
version wholly or not at all, a job that dies leaves the table as it was, and versions stay readable. On
that rest overwriting a table that is being read, merging rows into the files that hold their keys,
joining small files, and copies that share files or own them.

A version's list holds one name for each data file, as Spark's own listing does; rows never pass through
the driver. Moving a file must be atomic on the file system, as on HDFS or a local one.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Sequence
from functools import reduce
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebook.operators.quality import require_unique

VERSIONS, FOLDER = "_versions", "_part"
#: Files below this size are joined by ``compact``; Spark writes files of about this size for them.
SMALL_BYTES = 64 << 20
#: Values of a partition column by which a merge narrows what it reads; with more it reads all keys.
MOST_VALUES = 1000
#: Files that a task of a partitioned write may hold open. Up to so many values of the partition columns, its rows need
#: no sort, which would spill them; with more, Spark sorts the rest.
OPEN_FILES = 8
_OPEN = "spark.sql.maxConcurrentOutputFileWriters"


class Conflict(RuntimeError):
    """Another writer has published the version in the meantime; the work can be done again."""


class Published:
    """A published table below a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(self.path).getFileSystem(conf)
        self.path = str(self._fs.makeQualified(self._path(self.path)).toString())
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), conf)

    # versions

    def versions(self) -> list[int]:
        """Numbers of the published versions, oldest first."""
        folder = self._path(f"{self.path}/{VERSIONS}")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n) for n in names if re.fullmatch(r"\d{8}", n))

    def exists(self) -> bool:
        return bool(self.versions())

    def describe(self, version: int | None = None) -> dict:
        """What a version's file says: schema, partition columns (by), note, and files by the table that wrote them."""
        known = self.versions()
        number = version if version is not None else max(known, default=0)
        if number not in known:
            raise ValueError(f"{self.path} has no version {version or ''}".rstrip())
        lines = self.spark.read.text(f"{self.path}/{VERSIONS}/{number:08}", wholetext=True).collect()
        found = json.loads(lines[0][0])
        # Its own files are named without their table, so that a table can be moved.
        found["files"] = {self.path if root == "." else root: names for root, names in found["files"].items()}
        return {"number": number, **found}

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the newest by default; later versions do not change what was read."""
        return self._rows(self.describe(version))

    def _rows(self, found: dict, files: dict[str, list[str]] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(found["schema"])
        frames = []
        for root, names in (found["files"] if files is None else files).items():
            if names:
                reader = self.spark.read.option("basePath", root).schema(T.StructType([*schema, T.StructField(FOLDER, T.StringType())]))
                frames.append(reader.parquet(*(f"{root}/{n}" for n in names)))
        if not frames:
            return self.spark.createDataFrame([], schema)
        return reduce(DataFrame.unionByName, frames).select(*(f"`{n}`" for n in schema.names))

    def _publish(self, number: int, files: dict[str, list[str]], schema: T.StructType, by: Sequence[str], note: dict | None) -> None:
        """Makes a version visible; the last step of every write."""
        named = {"." if root == self.path else root: names for root, names in files.items()}
        text = json.dumps({"schema": schema.jsonValue(), "by": list(by), "note": note or {}, "files": named})
        folder = f"{self.path}/{VERSIONS}"
        self._fs.mkdirs(self._path(folder))
        waiting = self._path(f"{folder}/_{uuid.uuid4().hex}")
        out = self._fs.create(waiting, False)
        out.write(bytearray(text.encode()))
        out.close()
        none = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            self._context.rename(waiting, self._path(f"{folder}/{number:08}"), none)
        except Exception as error:
            self._fs.delete(waiting, False)
            if number in self.versions():
                raise Conflict(f"{self.path}: version {number} was published by another writer") from error
            raise

    def _write(self, df: DataFrame, by: Sequence[str]) -> list[str]:
        """Writes rows to a new folder of the table; names of its files."""
        folder = f"{FOLDER}={uuid.uuid4().hex}"
        writer = df.write
        before = self.spark.conf.get(_OPEN)
        self.spark.conf.set(_OPEN, str(OPEN_FILES))
        try:
            (writer.partitionBy(*by) if by else writer).parquet(f"{self.path}/{folder}")
        finally:
            self.spark.conf.set(_OPEN, before)
        # With a schema, since a partitioned write of no rows leaves no file to take it from.
        return [self._name(f) for f in self.spark.read.schema(df.schema).parquet(f"{self.path}/{folder}").inputFiles()]

    def _name(self, file: str) -> str:
        """A file's name below the table's folder."""
        return unquote(urlparse(file).path)[len(urlparse(self.path).path) + 1 :]

    # writes

    def overwrite(
        self,
        df: DataFrame,
        by: Sequence[str] = (),
        note: dict | Callable[[], dict] | None = None,
        check: Callable[[DataFrame], object] | None = None,
    ) -> DataFrame:
        """Publishes rows as the next version and returns it. The rows may come from the table itself.

        ``check`` sees the written rows before they are published; if it raises, the table stays as it was.
        A ``note`` that is a function is called when the rows are written.
        """
        number = max(self.versions(), default=0) + 1
        files = {self.path: self._write(df, by)}
        nullable = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
        if check:
            check(self._rows({"schema": nullable.jsonValue(), "files": files}))
        self._publish(number, files, nullable, by, note() if callable(note) else note)
        return self.read(number)

    def merge(self, source: DataFrame, keys: Sequence[str]) -> DataFrame:
        """Merges rows by key and returns the new version.

        Rows whose keys match take over the source's columns and keep their others; source rows that match
        nothing, also those with a null among their keys, are added, with nulls for columns they lack.
        Repeated keys in the source, and columns that the table lacks, are errors.

        Only files that hold a matching key are read whole and written anew; all others stay as they are. What
        is read to find them are the keys, and only of partitions that the source names, if a key is a
        partition column.
        """
        found = self.describe()
        number, by, schema = found["number"], found["by"], T.StructType.fromJson(found["schema"])
        missing = [k for k in keys if k not in schema.names or k not in source.columns]
        unknown = [c for c in source.columns if c not in schema.names]
        if missing or unknown or not keys:
            raise ValueError(f"key columns missing: {missing}, columns that the table lacks: {unknown}")
        source = source.select(*(F.col(f"`{c}`").cast(schema[c].dataType).alias(c) for c in source.columns))
        complete = source.na.drop(subset=list(keys))
        require_unique(complete, keys, "source of the merge")
        touched = self.holding(complete, keys, found)
        kept = {root: [n for n in names if n not in set(touched.get(root, ()))] for root, names in found["files"].items()}

        old = self._rows(found, touched)
        marked = complete.withColumn("_hit", F.lit(True))
        both = old.alias("old").join(marked.alias("new"), [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys], "left")
        value = lambda c: F.when(F.col("new._hit"), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}"))
        changed = both.select(*((value(c) if c in source.columns else F.col(f"old.{c}")).alias(c) for c in schema.names))
        # The touched files hold every match, so what they lack is new.
        added = complete.join(old.select(*keys), list(keys), "left_anti").unionByName(_incomplete(source, keys))
        files = self._write(changed.unionByName(added, allowMissingColumns=True), by)
        kept.setdefault(self.path, []).extend(files)
        self._publish(number + 1, {r: n for r, n in kept.items() if n}, schema, by, found["note"])
        return self.read(number + 1)

    def holding(self, wanted: DataFrame, keys: Sequence[str], found: dict | None = None) -> dict[str, list[str]]:
        """The files, by table, that hold one of the wanted keys."""
        found = found or self.describe()
        out: dict[str, list[str]] = {}
        for root, names in found["files"].items():
            rows = self._rows(found, {root: names}).select(*keys, F.col("_metadata.file_path").alias("_file"))
            for c in set(keys) & set(found["by"]):
                values = [r[0] for r in wanted.select(c).distinct().limit(MOST_VALUES + 1).collect()]
                if len(values) <= MOST_VALUES:
                    rows = rows.where(F.col(c).isin(values))
            hit = rows.join(wanted.select(*keys), list(keys), "left_semi").select("_file").distinct().collect()
            own = Published(self.spark, root)
            out[root] = sorted(own._name(r[0]) for r in hit)
        return {root: names for root, names in out.items() if names}

    def compact(self, small: int = SMALL_BYTES) -> DataFrame:
        """Joins files below ``small`` bytes, partition by partition; larger files stay as they are."""
        found = self.describe()
        by = found["by"]
        kept: dict[str, list[str]] = {}
        little: dict[str, list[str]] = {}
        for root, names in found["files"].items():
            sizes = self._rows(found, {root: names}).select("_metadata.file_path", "_metadata.file_size").distinct()
            few = {Published(self.spark, root)._name(r[0]) for r in sizes.where(F.col("file_size") < small).collect()}
            place = lambda n: n.split("/")[1:-1]
            little[root] = sorted(few - set(_single(few, place)))
            kept[root] = [n for n in names if n not in set(little[root])]
        if not any(little.values()):
            return self._rows(found)
        rows = self._rows(found, little).hint("rebalance", *by) if by else self._rows(found, little).hint("rebalance")
        kept.setdefault(self.path, []).extend(self._write(rows, by))
        schema = T.StructType.fromJson(found["schema"])
        self._publish(found["number"] + 1, {r: n for r, n in kept.items() if n}, schema, by, found["note"])
        return self.read()

    def clone(self, path: str, deep: bool = True, version: int | None = None) -> Published:
        """A copy of a version at another path; a copy that is there already stays as it is.

        A shallow copy names the files of this table, a deep one owns its files. Later writes to either
        do not show in the other.
        """
        copy = Published(self.spark, path)
        if copy.exists():
            return copy
        found = self.describe(version)
        note = {**found["note"], "copy_of": self.path, "version": found["number"]}
        try:
            if deep:
                copy.overwrite(self._rows(found), found["by"], note)
            else:
                copy._publish(1, found["files"], T.StructType.fromJson(found["schema"]), found["by"], note)
        except Conflict:
            pass  # Another writer has made the copy.
        return copy


def _incomplete(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a null among their keys."""
    lacking = reduce(lambda a, b: a | b, (F.col(f"`{k}`").isNull() for k in keys))
    return df.where(lacking)


def _single(names: set[str], place) -> list[str]:
    """Names that are alone in their folder."""
    folders: dict[tuple, list[str]] = {}
    for n in names:
        folders.setdefault(tuple(place(n)), []).append(n)
    return [own[0] for own in folders.values() if len(own) == 1]
