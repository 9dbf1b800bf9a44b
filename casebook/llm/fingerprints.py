"""Fingerprints of documents and of their neighbours in id order, over ordered ranges of ids.

A document and its successor must meet in one task. Ids are cut into ranges; each range also gets
a copy of the document that follows its last one, so every task sees all the neighbours it needs
and a text is shuffled once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import prepared, release, with_columns
from casebook.llm.phrases import edited_pair, fingerprint, likeness, shown

#: Buckets that rows without an id are dealt into.
STRAYS = 1024
SCHEMA = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def add_fingerprint(df: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """Adds the fingerprint of a text column as hexadecimal digits. One pass without a shuffle.

    Null is an empty text and has the empty fingerprint; equal texts have equal fingerprints. Texts
    are parsed whole. Other columns pass; a column of the added name is replaced.
    """
    return with_columns(df, [text], {name: "string"}, lambda: lambda texts: ([shown(fingerprint(t or "")) for t in texts],))


def range_of(id: Column, cuts: list[int]) -> Column:
    """The number of cuts, in ascending order, that an id reaches, by bisection."""
    if not cuts:
        return F.lit(0).cast("long")
    steps = [1 << k for k in reversed(range(len(cuts).bit_length()))]
    held = F.array(*map(F.lit, cuts))
    reach = lambda at, step: F.when(F.get(held, at + step - 1) <= id, at + step).otherwise(at)
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), reach).cast("long")


class Neighbours:
    """Rows of one range in order; each is finished when its successor has been parsed."""

    def __init__(self):
        self.row: tuple | None = None
        self.waiting: tuple | None = None
        self.done: list[tuple] = []

    def parsed(self, other: str) -> None:
        """Parses the last row, which this text follows, and finishes the row before it."""
        id, text = self.row
        own, edited, whole = edited_pair(text, other)
        self.finish(own)
        sha = hashlib.sha256(whole.encode("utf-8", "surrogatepass")).hexdigest()
        self.waiting = (id, len(text), sha, shown(own), shown(edited), likeness(own, edited)), own

    def finish(self, following) -> None:
        if self.waiting:
            row, own = self.waiting
            self.done.append((*row, likeness(own, following)))
            self.waiting = None

    def add(self, id: int, text: str) -> None:
        if self.row:
            self.parsed(text)
        self.row = id, text

    def close(self, text: str) -> None:
        """Ends the range; the text is that of the document after it."""
        if self.row:
            self.parsed(text)
            self.finish(fingerprint(text))
            self.row = None


def compare_with_next(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints each document and its edited text, and compares with the next document.

    Next is the next smaller id, and the largest after the smallest. Rows out: id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next (likeness of the
    fingerprint to that of the edited text and of the next document). Null texts are empty. Rows
    that share an id follow each other in the order of their texts. A row without an id has an
    empty text as its next. A single document is its own next. Other columns are not returned; an
    empty table gives no rows.

    The cuts between ranges are quantiles of the ids, one range for each shuffle partition.
    """
    spark = prepared(df.sparkSession)
    docs = df.select(F.col(id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = docs.select("id").approxQuantile("id", [k / n for k in range(1, n)], 0.25 / n)
    cuts = sorted({int(c) for c in found})
    known = docs.filter("id is not null").withColumn("range", range_of(F.col("id"), cuts))
    # One row per range: its first document, which the range above it needs as its last neighbour.
    heads = sorted(tuple(r) for r in known.groupBy("range").agg(F.max("id")).collect())
    above = [heads[k + 1][0] for k in range(len(heads) - 1)] + [heads[0][0] if heads else 0]
    guests = spark.createDataFrame([(head, to) for (_, head), to in zip(heads, above, strict=False)], "id long, range long")
    strays = docs.filter("id is null").withColumn("range", len(cuts) + 1 + F.pmod(F.xxhash64("text"), F.lit(STRAYS)))
    rows = (
        known.unionByName(strays)
        .withColumn("guest", F.lit(False))
        .unionByName(docs.join(F.broadcast(guests), "id").withColumn("guest", F.lit(True)))
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, at, closed = Neighbours(), None, False
        for batch in batches:
            for number, value, place, guest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if place != at or number is None:
                    rows.close("")
                    at, closed = place, False
                if not guest:
                    rows.add(number, value)
                elif not closed:
                    rows.close(value)
                    closed = True
            yield _batch(rows.done)
            rows.done = []
        rows.close("")
        yield _batch(rows.done)
        release(compare)

    # Ranges are partitions, so they are of one size; rows without an id are dealt over them.
    ordered = rows.select("id", "text", "range", "guest").repartitionById(len(cuts) + 1, F.col("range").cast("int")).sortWithinPartitions("range", "guest", F.desc("id"), "text")
    return ordered.mapInArrow(compare, SCHEMA).withColumnRenamed("id", id)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    text, number, share = pa.string(), pa.int64(), pa.float64()
    kinds = (number, number, text, text, text, share, share)
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
