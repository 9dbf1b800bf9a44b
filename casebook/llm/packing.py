"""Packing of token sequences into windows of one length, online and in bounded space.

Every partition keeps a fixed number of open windows. A document's last piece goes to the open
window it fills best; when it fits into none and no further window may be opened, the fullest is
emitted. Windows still open at the end of a partition are merged with those of neighbouring
partitions.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import BATCH_ROWS, prepared, release, stored

#: Tokens of a window, and windows a partition keeps open.
WINDOW = 2048
OPEN = 32
#: Partitions whose open windows one task merges: at most so many times OPEN windows.
MERGED = 16
#: Bytes of a token id.
WIDTH = 4


class Rows:
    """Collects rows and hands them out as record batches."""

    def __init__(self, schema: pa.Schema):
        self.schema = schema
        self.rows: list[tuple] = []

    def taken(self, least: int) -> Iterator[pa.RecordBatch]:
        if len(self.rows) >= least:
            columns = zip(*self.rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema)
            self.rows = []


class OpenWindows:
    """The open windows of a partition, ordered by their free space."""

    def __init__(self, window: int, most: int):
        self.window, self.most = window, most
        self.free: list[tuple[int, int]] = []
        self.pieces: dict[int, list[tuple]] = {}
        self.opened = 0

    def place(self, length: int, piece: tuple) -> list[tuple] | None:
        """Places a piece; returns the pieces of a window that this emits, if any."""
        out = None
        at = bisect.bisect_left(self.free, (length, -1))
        if at < len(self.free):
            room, window = self.free.pop(at)
        else:
            if len(self.free) >= self.most:
                out = self.pieces.pop(self.free.pop(0)[1])
            room, window = self.window, self.opened
            self.opened += 1
            self.pieces[window] = []
        self.pieces[window].append(piece)
        if room > length:
            bisect.insort(self.free, (room - length, window))
            return out
        full = self.pieces.pop(window)
        return full if out is None else out + [None] + full

    def rest(self) -> Iterator[list[tuple]]:
        """What is still open, fullest first."""
        for _, window in self.free:
            yield self.pieces[window]


def pack(
    df: DataFrame, id: str = "doc_id", ids: str = "ids", window: int = WINDOW, open_windows: int = OPEN, merged: int = MERGED,
    reader: Callable[[], Callable[[list], list]] | None = None,
) -> DataFrame:
    """Pieces of documents and their places in sequences of at most ``window`` tokens.

    ``ids`` holds a document's token ids as little-endian unsigned 32-bit integers; or anything else
    from which ``reader`` makes them: it is called once in a task and returns the function from the
    values of a batch to their ids (its ``release``, if any, is called at the end of the task), so that
    texts can be encoded and packed in one pass. A document
    longer than a window is cut into full windows and a last piece; last pieces are placed as the
    module text says, and cut only when open windows are merged. Rows out: id, start (tokens of the
    document before the piece), length, ids (of the piece), doc_tokens, sequence_id, offset.
    Documents without ids (null or empty) have no piece; equal or repeated rows are packed as
    separate documents; a null id stays null; other columns are not returned.

    Only the open windows are shuffled. The pieces are written once below the shared checkpoint
    folder, so no sequence is built twice.
    """
    prepared(df.sparkSession)
    # Plain names inside, so that no column of the input can clash with an added one.
    docs = df.select(F.col(id).alias("id"), F.col(ids).alias("ids"))
    kind = docs.schema["id"].dataType.simpleString()
    schema = f"id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, open boolean, part long"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        windows, rows, emitted = OpenWindows(window, open_windows), None, 0
        read = reader() if reader else lambda values: values

        def emit(pieces: list[tuple], still_open: bool) -> None:
            nonlocal emitted
            offset = 0
            for doc, start, data, tokens in pieces:
                length = len(data) // WIDTH
                rows.rows.append((doc, start, length, data, tokens, (part << 32) + emitted, offset, still_open, part))
                offset += length
            emitted += 1

        for batch in batches:
            rows = rows or Rows(_arrow(batch.schema.field(0).type))
            for doc, data in zip(batch.column(0).to_pylist(), read(batch.column(1).to_pylist()), strict=True):
                data = data or b""
                tokens = len(data) // WIDTH
                cut = tokens - tokens % window
                for start in range(0, cut, window):
                    emit([(doc, start, data[start * WIDTH : (start + window) * WIDTH], tokens)], False)
                if tokens > cut:
                    done = windows.place(tokens - cut, (doc, cut, data[cut * WIDTH :], tokens))
                    if done and None in done:
                        middle = done.index(None)
                        emit(done[:middle], False)
                        done = done[middle + 1 :]
                    if done:
                        emit(done, False)
                yield from rows.taken(BATCH_ROWS)
        if rows:
            for pieces in windows.rest():
                emit(pieces, True)
            yield from rows.taken(1)
        release(read)

    pieces = stored(docs.mapInArrow(place, schema), "packed")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Open windows one after the other, cut where a sequence is full."""
        group, used, sequence, rows = None, 0, 0, None
        for batch in batches:
            rows = rows or Rows(batch.schema)
            for doc, start, length, data, tokens, _, _, _, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part != group:
                    group, used, sequence = part, 0, 0
                at = 0
                while at < length:
                    if used == window:
                        used, sequence = 0, sequence + 1
                    n = min(length - at, window - used)
                    number = ((1 << 30) + group << 32) + sequence
                    rows.rows.append((doc, start + at, n, data[at * WIDTH : (at + n) * WIDTH], tokens, number, used, True, part))
                    at, used = at + n, used + n
            yield from rows.taken(BATCH_ROWS)
        if rows:
            yield from rows.taken(1)

    groups = pieces.filter("open").withColumn("part", F.floor(F.col("part") / merged).cast("long"))
    ordered = groups.repartition("part").sortWithinPartitions("part", "sequence_id", "offset")
    result = pieces.filter("not open").unionByName(ordered.mapInArrow(merge, schema))
    return result.select(F.col("id").alias(id), "start", "length", "ids", "doc_tokens", "sequence_id", "offset")


def _arrow(kind: pa.DataType) -> pa.Schema:
    longs = ("start", "length"), ("doc_tokens", "sequence_id", "offset")
    return pa.schema(
        [("id", kind), *((n, pa.int64()) for n in longs[0]), ("ids", pa.binary()), *((n, pa.int64()) for n in longs[1]), ("open", pa.bool_()), ("part", pa.int64())]
    )
