"""Small helpers the operators share: stored stages, batches, word hashes and components."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.session import shared_dir, tune

#: Rows of an Arrow batch. Texts can be long, so batches are kept short.
BATCH_ROWS = 500
#: Bytes from which on a word is hashed by itself.
LONG_WORD = 1024
#: Bytes of text that the vector code handles at once; a longer text is handled alone.
CHUNK_BYTES = 1 << 20


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the library's settings and short Arrow batches."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    # Where the package lies, for workers started elsewhere; on a cluster it comes by --py-files.
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, (root, env.get("PYTHONPATH"))))
    return spark


def stored(df: DataFrame, name: str, by: list[str] | None = None) -> DataFrame:
    """The rows written below the shared checkpoint folder and read again.

    Cuts the lineage with files that outlive lost executors; nothing is computed twice.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    writer = df.write
    if by:
        writer = writer.partitionBy(*by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a given table."""
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def with_columns(df: DataFrame, inputs: list[str], added: dict[str, str], task: Callable[[], Callable]) -> DataFrame:
    """Adds columns computed from Arrow batches.

    ``task`` runs once per task and returns a function from the input columns, as lists, to the
    added columns, as lists; a ``release`` of that function is called at the end. Other columns pass unchanged, whatever their names; a column of an
    added name (in any case) is replaced.
    """
    prepared(df.sparkSession)
    taken = {n.lower() for n in added}
    first = df.select(*(F.col(f"`{n}`") for n in inputs)).toDF(*(f"i{k}" for k in range(len(inputs))))
    if set(inputs) == set(df.columns):
        kept, flat, places = list(inputs), first, list(range(len(inputs)))
    else:
        kept = df.columns
        flat = df.toDF(*(f"c{k}" for k in range(len(kept))))
        places = [kept.index(n) for n in inputs]
    stay = [k for k, n in enumerate(kept) if n.lower() not in taken]
    fields = [f"{flat.columns[k]} {flat.schema[k].dataType.simpleString()}" for k in stay]
    fields += [f"a{k} {kind}" for k, kind in enumerate(added.values())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = task()
        for batch in batches:
            found = compute(*(batch.column(k).to_pylist() for k in places))
            kinds = [_arrow_type(kind) for kind in added.values()]
            new = [pa.array(c, kind) for c, kind in zip(found, kinds, strict=True)]
            names = [batch.schema.names[k] for k in stay] + [f"a{k}" for k in range(len(new))]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in stay), *new], names=names)
        release(compute)

    return flat.mapInArrow(run, ", ".join(fields)).toDF(*(kept[k] for k in stay), *added)


def release(function: Callable) -> None:
    """Gives back what a task's function holds: workers stay alive between tasks."""
    getattr(function, "release", lambda: None)()
    pa.default_memory_pool().release_unused()


def _arrow_type(kind: str) -> pa.DataType:
    known = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_()}
    return pa.list_(known[kind[6:-1]]) if kind.startswith("array<") else known[kind]


def spaces() -> np.ndarray:
    """256 flags: the bytes that part words, x20 and x09 to x0D."""
    flags = np.zeros(256, bool)
    flags[[0x20, *range(0x09, 0x0E)]] = True
    return flags


SPACE = spaces()
_RNG = np.random.Generator(np.random.PCG64(20240229))
#: A random value per byte; the second row gives A-Z the values of a-z.
_BYTES = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _BYTES.copy()
_FOLDED[65:91] = _BYTES[97:123]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of them."""
    if len(_POWERS[0]) < n:
        size = max(n, CHUNK_BYTES + CHUNK_BYTES // 8)
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[0], _POWERS[1]


def mixed(x: np.ndarray) -> np.ndarray:
    """Well spread 64-bit values of 64-bit values (one to one)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(texts: Iterable[bytes | None]) -> Iterator[list[bytes]]:
    """Consecutive texts in lists of about ``CHUNK_BYTES``; null is an empty text."""
    held, size = [], 0
    for text in texts:
        text = text or b""
        if held and size + len(text) > CHUNK_BYTES:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text) + 1
    if held:
        yield held


class Words:
    """The words of several texts as arrays: places, hashes, and the text each belongs to.

    A word is a maximal run of bytes other than x20 and x09 to x0D. ``fold`` hashes A-Z as a-z.
    """

    def __init__(self, texts: list[bytes], fold: bool):
        joined = b" ".join([*texts, b""])
        self.bytes = np.frombuffer(joined, np.uint8)
        lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        self.text_ends = np.cumsum(lengths)
        space = SPACE[self.bytes]
        edge = np.flatnonzero(np.diff(space, prepend=True, append=True))
        self.starts, self.ends = edge[0::2], edge[1::2]
        self.firsts = np.concatenate(([0], np.searchsorted(self.starts, self.text_ends)))
        up, down = _powers(len(self.bytes) + 1)
        sums = np.empty(len(self.bytes) + 1, np.uint64)
        sums[0] = 0
        values = (_FOLDED if fold else _BYTES)[self.bytes]
        np.cumsum(values * up[: len(self.bytes)], out=sums[1:])
        self.hashes = mixed((sums[self.ends] - sums[self.starts]) * down[self.starts])
        # Long words could be made to share a sum of that kind.
        for k in np.flatnonzero(self.ends - self.starts > LONG_WORD).tolist():
            word = joined[self.starts[k] : self.ends[k]]
            self.hashes[k] = xxhash.xxh3_64_intdigest(word.lower() if fold else word, 1)

    def of(self, k: int) -> slice:
        """The words of the k-th text."""
        return slice(self.firsts[k], self.firsts[k + 1])


    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sums per text of a value per word."""
        sums = np.concatenate(([0], np.cumsum(values)))
        return sums[self.firsts[1:]] - sums[self.firsts[:-1]]

    def bytes_per_text(self, values: np.ndarray) -> np.ndarray:
        """Sums per text of a value per byte; ``values`` is a table of 256."""
        sums = np.concatenate(([0], np.cumsum(values[self.bytes])))
        return np.diff(sums[self.text_ends], prepend=0)

    def repeated(self, width: int) -> np.ndarray:
        """Flags of the words in windows of ``width`` words that their text holds twice or more."""
        out = np.zeros(len(self.hashes), bool)
        windows = window_hashes(self.hashes, width)
        if not len(windows):
            return out
        text = np.repeat(np.arange(len(self.text_ends)), np.diff(self.firsts))
        inner = np.flatnonzero(text[: len(windows)] == text[width - 1 :])
        own = mixed(windows[inner] ^ mixed(text[inner].astype(np.uint64) + np.uint64(1)))
        order = np.argsort(own, kind="stable")
        same = np.flatnonzero(own[order][1:] == own[order][:-1])
        twice = inner[np.unique(np.concatenate((order[same], order[same + 1])))]
        for k in range(width):
            out[twice + k] = True
        return out


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for each window of so many neighbouring hashes; order counts."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:n].copy()
    for k in range(1, width):
        out *= np.uint64(0x9FB21C651E98DF25)
        out += hashes[k : k + n]
    return mixed(out)


def shingle_sets(texts: Iterable[bytes | None], width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, A-Z folded.

    A text with fewer words than ``width`` has its whole word sequence as its only shingle; one
    without words has none.
    """
    for chunk in chunks(texts):
        words = Words(chunk, fold=True)
        windows = window_hashes(words.hashes, width)
        for k in range(len(chunk)):
            span = words.of(k)
            n = span.stop - span.start
            if n >= width:
                yield np.unique(windows[span.start : span.stop - width + 1])
            elif n:
                yield window_hashes(words.hashes[span], int(n)) ^ np.uint64(n)
            else:
                yield np.empty(0, np.uint64)


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of edges (a, b): rows (id, component), the smallest id of each.

    In a round every vertex moves to the smallest of its neighbours and itself, and on to where
    that one moves; edges follow, and those within one place go. So the edges shrink fast, and the
    rounds grow with the logarithm of a component's diameter. The smallest vertex never moves. Each
    round is three written tables, of which only one needs a shuffle where the others are small; the
    moves of all rounds are put together at the end. Vertices without edges are not returned. The edges
    are read twice, so they should be a stored table; repeated ones do no harm.
    """
    left = edges.select("a", "b").filter("a != b")
    places, rounds = None, 0
    while places is None or not left.isEmpty():
        rounds += 1
        both = left.union(left.select("b", "a"))
        near = both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("to"))
        near = stored(near, f"{name}-near-{rounds}")
        onward = near.select(F.col("id").alias("to"), F.col("to").alias("next"))
        moves = stored(near.join(onward, "to").select("id", F.col("next").alias("to")), f"{name}-moves-{rounds}")
        if places is None:
            places = moves.withColumnRenamed("to", "component")
        else:
            moved = moves.withColumnRenamed("id", "component")
            places = places.join(moved, "component", "left").select("id", F.coalesce("to", "component").alias("component"))
        ends = [moves.select(F.col("id").alias(c), F.col("to").alias(f"{c}2")) for c in ("a", "b")]
        joined = left.join(ends[0], "a").join(ends[1], "b").filter("a2 != b2")
        left = stored(joined.select(F.col("a2").alias("a"), F.col("b2").alias("b")), f"{name}-edges-{rounds}")
    return stored(places, f"{name}-places") if rounds > 1 else places
