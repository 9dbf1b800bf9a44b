"""Approximate nearest neighbours by an adaptive scan of dimensions.

Vectors are dealt into lists around centroids. All are rotated by one random rotation, so that any
few dimensions tell about the same of a distance. A query probes the lists whose centroids are nearest.
Each list is a column block: the first dimension of all its vectors, then the second, and so on. The scan
adds up squared differences a few columns at a time. After each step a hypothesis test compares the
partial distance of every vector still there with the distance to beat; vectors that would need
unlikely small remaining differences are abandoned. What survives all columns is measured on the
original vectors in double precision.

The index (rotation, centroids) is fitted on a bounded sample; every row is indexed. How many lists a
query probes is measured: some rows of the sample are compared with all rows, and so many lists are probed
as hold the wanted share of their true neighbours. The sample also gives each query a distance to beat
from the start; no result comes from it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from casebook.llm.common import mixed, prepared, stored

#: Vectors the index is fitted on, at most.
SAMPLE = 16_384
#: Vectors of a list on average, and most centroids of each of the two levels: lists beyond the first
#: level's are parts of its lists, around its centroids plus one of the second level's.
LIST, CENTROIDS = 512, 1024
#: Share of true neighbours whose lists are probed, and rows of the sample it is measured with.
RECALL, MEASURED = 0.97, 256
#: The distance to beat is that of so many times k vectors of the sample.
LOOSE = 4
#: Vectors of a column block; larger lists are dealt into several.
BLOCK = 2048
#: How sure the test is: a vector is abandoned if its distance, projected from d of D dimensions, is over
#: (1 + SURE / sqrt(d)) times the distance to beat.
SURE = 2.1
#: Deviations below the mean at which the nearest of a list's vectors is expected.
LUCK = 3.0
#: Dimensions of the first step; each further step doubles what was added up.
STEP = 8
#: Vectors that repeat within a batch, kept by a task until its end.
HOT = 4096
ROUNDS = 10


@dataclass
class Index:
    """What is fitted: a scale, a rotation, centroids of two levels in rotated space, how many blocks
    each list has, the vectors of the sample without repeats in an arbitrary order, the radius of each
    list, and how many lists are probed."""

    scale: float
    rotation: np.ndarray
    coarse: np.ndarray
    fine: np.ndarray
    blocks: np.ndarray
    distinct: np.ndarray
    radius: np.ndarray
    probed: int = 1

    def rotated(self, x: np.ndarray) -> np.ndarray:
        return ((x * self.scale) @ self.rotation).astype(np.float32)

    def lists(self, x: np.ndarray) -> np.ndarray:
        """The list of each vector of rotated space."""
        near = nearest_centroid(x, self.coarse)
        if len(self.fine) == 1:
            return near
        return near * len(self.fine) + nearest_centroid(x - self.coarse[near], self.fine)

    def ranked(self, q: np.ndarray) -> np.ndarray:
        """All lists, for a vector of rotated space, by how near their nearest vector may be expected.

        The squared distances to a list's vectors lie around that to its centroid plus its radius squared, and
        the wider around it the wider the list is; the nearest is ``LUCK`` deviations below.
        """
        # |q - c - f|^2
        far = (q**2).sum() + distances(q[None], self.coarse)[0][:, None] + distances(q[None], self.fine)[0][None] + 2 * self.coarse @ self.fine.T
        far = np.maximum(far.ravel(), 0)
        return np.argsort(far + self.radius**2 - 2 * LUCK / np.sqrt(len(q)) * self.radius * np.sqrt(far), kind="stable")

    def probes(self, x: np.ndarray) -> np.ndarray:
        """The lists that each vector probes."""
        return np.stack([self.ranked(q)[: self.probed] for q in x])


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances up to a term of each row of x."""
    return np.nan_to_num((centroids**2).sum(axis=1) - 2 * (x @ centroids.T), nan=np.inf)


def nearest_centroid(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.concatenate([np.argmin(distances(x[a : a + 4096], centroids), axis=1) for a in range(0, len(x), 4096)]) if len(x) else np.zeros(0, np.int64)


def centroids_of(x: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """n centroids of x by Lloyd's rounds; a centroid without vectors moves to one that lies far from its own."""
    x = np.unique(x, axis=0)
    n = min(n, len(x))
    found = x[rng.permutation(len(x))[:n]]
    for _ in range(ROUNDS):
        own = nearest_centroid(x, found)
        count = np.bincount(own, minlength=n)
        sums = np.zeros_like(found, np.float64)
        np.add.at(sums, own, x)
        found = (sums / np.maximum(count, 1)[:, None]).astype(np.float32)
        empty = np.flatnonzero(count == 0)
        if len(empty):
            far = np.argsort(-((x - found[own]) ** 2).sum(axis=1))
            found[empty] = x[far[: len(empty)]]
    return found


def measured(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision of rows of x to q."""
    d = x.astype(np.float64) - q.astype(np.float64)
    out = np.sqrt(np.square(d).sum(axis=1))
    if not np.isfinite(out).all():
        most = np.abs(d).max(axis=1)
        out = np.where(np.isfinite(out), out, most * np.sqrt(np.square(d / most[:, None]).sum(axis=1)))
    return out


def fit(vectors: DataFrame, k: int, recall: float = RECALL, sample: int = SAMPLE, size: int = LIST, block: int = BLOCK) -> Index | None:
    """The index of vectors (id, vec) for searches of k; fitted on ``sample`` rows, those with the smallest
    hashes of their ids, which are all that reaches the driver. None without vectors."""
    drawn = vectors.orderBy(F.xxhash64("id"), "id").limit(sample).toArrow()
    n = vectors.count()
    if not n:
        return None
    x = matrix(drawn.column("vec").combine_chunks())
    rng = np.random.Generator(np.random.PCG64(20240611))
    rotation = np.linalg.qr(rng.standard_normal((x.shape[1], x.shape[1])))[0]
    scale = 2.0 ** -np.ceil(np.log2(np.abs(x).max()))
    y = ((x * scale) @ rotation).astype(np.float32)
    lists = max(1, n // size)
    coarse = centroids_of(y, min(lists, CENTROIDS), rng)
    fine = np.zeros((1, x.shape[1]), np.float32)
    if lists > CENTROIDS:
        fine = centroids_of(y - coarse[nearest_centroid(y, coarse)], min(CENTROIDS, -(-lists // CENTROIDS)), rng)
    count = len(coarse) * len(fine)
    distinct = x[np.sort(np.unique(x, axis=0, return_index=True)[1])]
    index = Index(scale, rotation, coarse, fine, np.ones(count, np.int64), distinct, np.zeros(count))
    lists = index.lists(y)
    held = np.bincount(lists, minlength=count)
    off = ((y - coarse[lists // len(fine)] - fine[lists % len(fine)]) ** 2).sum(axis=1)
    index.radius = np.sqrt(np.where(held > 0, np.bincount(lists, off, count) / np.maximum(held, 1), off.mean()))
    index.blocks = np.maximum(1, np.ceil(held / len(y) * n / block)).astype(np.int64)
    index.probed = measured_probes(index, vectors, k, recall)
    return index


def measured_probes(index: Index, vectors: DataFrame, k: int, recall: float) -> int:
    """How many of its nearest lists a row must probe to find this share of its k nearest rows.

    The first ``MEASURED`` distinct vectors of the sample are compared with all rows; of each batch their k nearest are
    kept, beside the row itself. At most ``MEASURED`` times k rows reach the driver.
    """
    sent = vectors.sparkSession.sparkContext.broadcast(index)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        q = own.distinct[:MEASURED] * own.scale
        turned = own.rotated(own.distinct[:MEASURED])
        rank = np.empty((len(q), len(own.blocks)), np.int32)
        for row, x in zip(rank, turned, strict=True):
            row[own.ranked(x)] = np.arange(len(row))
        for batch in batches:
            x = matrix(batch.column(1)) if batch.num_rows else q[:0]
            for a in range(0, len(x), 4096):
                part, lists = x[a : a + 4096] * own.scale, own.lists(own.rotated(x[a : a + 4096]))
                far = np.nan_to_num(distances(q, part), nan=np.inf)
                best = np.argpartition(far, min(k, far.shape[1] - 1), axis=1)[:, : k + 1]
                of = np.repeat(np.arange(len(q)), best.shape[1])
                columns = [pa.array(of), pa.array(far[of, best.ravel()]), pa.array(rank[of, lists[best.ravel()]])]
                yield pa.RecordBatch.from_arrays(columns, names=["asked", "far", "rank"])

    rows = vectors.mapInArrow(compare, "asked long, far double, rank int").filter("far < double('inf')")
    near = W.partitionBy("asked").orderBy("far", "rank")
    ranks = rows.withColumn("place", F.row_number().over(near)).filter((F.col("place") > 1) & (F.col("place") <= k + 1)).select("rank").toArrow().column("rank").to_numpy()
    least = min(len(index.blocks), k + 1)
    return max(least, int(np.quantile(ranks, recall, method="higher")) + 1) if len(ranks) else least


def matrix(vectors: pa.Array) -> np.ndarray:
    """Lists of equal length as rows, in double precision."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), -1)


def spread(x: np.ndarray) -> np.ndarray:
    """A hash of each row; equal rows have equal ones."""
    bits = (x + 0.0).view(np.uint64)
    out = np.zeros(len(x), np.uint64)
    for k in range(x.shape[1]):
        out = mixed(out * np.uint64(0x9FB21C651E98DF25) + bits[:, k])
    return out


def fewest(x: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of equal rows those with the ``most`` smallest ids: places, sorted by row and id; the number of the
    distinct row each holds; and whether its row had more. A repeated id of a row counts once."""
    value = spread(x)
    order = np.lexsort((ids, *(x[:, k] for k in reversed(range(min(2, x.shape[1])))), value))
    new = np.ones(len(order), bool)
    new[1:] = (x[order[1:]] != x[order[:-1]]).any(axis=1)
    single = new.copy()
    single[1:] |= ids[order[1:]] != ids[order[:-1]]
    order, new = order[single], new[single]
    number = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    place = np.arange(len(order)) - first[number]
    count = np.diff(np.append(first, len(order)))
    keep = place < most
    return order[keep], number[keep], (count > most)[number[keep]]


class Scan:
    """A column block and the queries that probe it."""

    def __init__(self, index: Index, x: np.ndarray, ids: np.ndarray, k: int):
        place, number, _ = fewest(x, ids, k)
        first = np.flatnonzero(np.diff(number, prepend=-1))
        self.x, self.k = x[place[first]], k
        # The ids that share a vector, smallest first.
        self.ids, self.first = ids[place], np.append(first, len(place))
        self.columns = np.ascontiguousarray(index.rotated(self.x).T)
        self.index = index

    def search(self, q: np.ndarray, beat: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the vectors of the block that are nearest to q, k at most."""
        turned = self.index.rotated(q[None])[0]
        own = self.survivors(turned, beat * self.index.scale)
        far = measured(self.x[own], q)
        count = self.first[own + 1] - self.first[own]
        ids = np.concatenate([self.ids[self.first[v] : self.first[v + 1]] for v in own.tolist()]) if len(own) else self.ids[:0]
        far = np.repeat(far, count)
        best = np.lexsort((ids, far))[: self.k]
        return ids[best], far[best]

    def survivors(self, q: np.ndarray, beat: float) -> np.ndarray:
        """Vectors that no test abandons."""
        total, done, end = None, 0, STEP
        own, whole = np.arange(self.columns.shape[1]), len(q)
        while done < whole:
            end = min(end, whole)
            part = self.columns[done:end] if len(own) == self.columns.shape[1] else self.columns[done:end, own]
            part = np.square(part - q[done:end, None]).sum(axis=0)
            total = part if total is None else total + part
            # At the end only rounding of the rotated vectors counts.
            slack = (1 + SURE / np.sqrt(end)) ** 2 * end / whole if end < whole else 1.001
            keep = ~(total > beat * beat * slack + 1e-9)
            own, total = own[keep], total[keep]
            done, end = end, 2 * end
        return own


def probing(sent: Broadcast, k: int, kind: str):
    """The tasks of a search with a broadcast index."""

    def index() -> Index:
        return sent.value

    dtype = np.float32 if kind == "float" else np.float64

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Vectors with their list and block. Of a vector that repeats often in a batch, the task gives out
        the k smallest ids at its end."""
        own = index()
        hot: dict[bytes, np.ndarray] = {}

        def given(x: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
            lists = own.lists(own.rotated(x))
            block = (spread(x) % own.blocks[lists].astype(np.uint64)).astype(np.int64)
            data = pa.array([row.tobytes() for row in x.astype(dtype)], pa.binary())
            none = pa.nulls(len(x), pa.float64())
            return pa.RecordBatch.from_arrays([pa.array(lists), pa.array(block), pa.array(np.zeros(len(x), np.int32)), pa.array(ids), data, none], names=NAMES)

        def rest() -> Iterator[pa.RecordBatch]:
            for row, ids in hot.items():
                yield given(np.repeat(np.frombuffer(row)[None], len(ids), axis=0), ids)
            hot.clear()

        for batch in batches:
            if not batch.num_rows:
                continue
            ids, x = batch.column(0).to_numpy(), matrix(batch.column(1)) + 0.0
            place, number, more = fewest(x, ids, k)
            if more.any():
                for v in np.unique(number[more]).tolist():
                    at = place[number == v]
                    row = x[at[0]].tobytes()
                    hot[row] = np.sort(np.append(hot.get(row, ids[:0]), ids[at]))[:k]
                if len(hot) > HOT:
                    yield from rest()
            place = place[~more]
            if len(place):
                yield given(x[place], ids[place])
        yield from rest()

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each query and block of a list that it probes, with the distance to beat."""
        own = index()
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, x = batch.column(0).to_numpy(), matrix(batch.column(1))
            beat = list(map(to_beat, x))
            lists = own.probes(own.rotated(x))
            query = np.repeat(np.arange(len(x)), lists.shape[1])
            lists = lists.ravel()
            count = own.blocks[lists]
            block = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            query, lists = np.repeat(query, count), np.repeat(lists, count)
            data = pa.array([row.tobytes() for row in x.astype(dtype)], pa.binary()).take(pa.array(query))
            columns = [pa.array(lists), pa.array(block), pa.array(np.ones(len(query), np.int32)), pa.array(ids[query]), data, pa.array(np.array(beat)[query])]
            yield pa.RecordBatch.from_arrays(columns, names=NAMES)

    def to_beat(q: np.ndarray) -> float:
        """A distance within which there are more than k vectors: the sample has ``LOOSE`` times as many that
        differ."""
        far = measured(index().distinct, q)
        return np.partition(far, LOOSE * k - 1)[LOOSE * k - 1] if len(far) >= LOOSE * k else np.inf

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Searches the blocks of a partition, in which each block's vectors come before its queries."""
        at, held, scan = None, [], None
        for batch in batches:
            found = []
            lists, blocks, kinds, numbers, data, beat = (c.to_pylist() for c in batch.columns)
            for where, query, number, row, least in zip(zip(lists, blocks, strict=True), kinds, numbers, data, beat, strict=True):
                if where != at:
                    at, held, scan = where, [], None
                if not query:
                    held.append((number, row))
                    continue
                if held and scan is None:
                    x = np.frombuffer(b"".join(v for _, v in held), dtype).astype(np.float64).reshape(len(held), -1)
                    scan = Scan(index(), x, np.array([n for n, _ in held], np.int64), k)
                if scan:
                    found.append((number, *scan.search(np.frombuffer(row, dtype).astype(np.float64), least)))
            yield hits(found)

    return placed, asked, scanned


NAMES = ["list", "block", "query", "id", "vec", "beat"]
ROWS = "list long, block long, query int, id long, vec binary, beat double"


def hits(found: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    number = np.repeat(np.array([f[0] for f in found], np.int64), [len(f[1]) for f in found]) if found else np.zeros(0, np.int64)
    ids = np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.int64)
    far = np.concatenate([f[2] for f in found]) if found else np.zeros(0)
    return pa.RecordBatch.from_arrays([pa.array(number), pa.array(ids), pa.array(far)], names=["asked", "vec_id", "score"])


def nearest(
    df: DataFrame, queries: Column, id: str = "id", vector: str = "vec", k: int = 10, recall: float = RECALL, sample: int = SAMPLE, size: int = LIST, block: int = BLOCK
) -> DataFrame:
    """The k rows found nearest to each row that ``queries`` selects, itself aside.

    Rows out: query_id, rank (from 1), vec_id, score, the Euclidean distance of the original vectors in
    double precision; nearest first, ties to the smaller id. Every row is indexed, the fit sees ``sample``
    of them. Lists are probed until they hold the share ``recall`` of the true neighbours, as measured. If
    there are k other vectors or fewer, all are found.

    Vectors that are null, zero or hold null or non-finite components take no part, nor do rows without an
    id or vectors of another length than most. Rows with equal vectors and different ids are all found, in
    the order of their ids; only the k + 1 smallest ids of a vector can be results, so a task passes on no
    more of them. Repeated rows count once. An empty table gives no rows; other columns are not used.

    One shuffle of the vectors and the probes, by list and block of ``block`` vectors; a list that holds
    a third of all vectors has that many blocks.
    """
    spark = prepared(df.sparkSession)
    kind = df.schema[vector].dataType.elementType.simpleString()
    vec = F.col(vector) if kind == "float" else F.col(vector).cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = df.select(F.col(id).cast("long").alias("id"), vec.alias("vec"), F.coalesce(queries, F.lit(False)).alias("is_query"))
    rows = rows.filter(F.col("id").isNotNull() & F.forall("vec", finite) & F.exists("vec", lambda x: x != 0))
    usual = rows.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), "size").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if not usual:
        return spark.createDataFrame([], schema)
    rows = rows.filter(F.size("vec") == usual.size)
    index = fit(rows.select("id", "vec"), k, recall, sample, size, block)
    placed, asked, scanned = probing(spark.sparkContext.broadcast(index), k + 1, kind if kind == "float" else "double")

    # Queries with one vector are one question.
    own = stored(rows.filter("is_query").select("id", "vec").distinct(), "queries")
    questions = stored(own.groupBy("vec").agg(F.min("id").alias("asked")), "questions")
    asked_vectors = questions.select("asked", "vec")
    dealt = rows.select("id", "vec").mapInArrow(placed, ROWS).unionByName(asked_vectors.mapInArrow(asked, ROWS))
    ordered = dealt.repartition("list", "block").sortWithinPartitions("list", "block", "query", "id")
    found = ordered.mapInArrow(scanned, "asked long, vec_id long, score double")
    found = found.groupBy("asked", "vec_id").agg(F.min("score").alias("score"))
    near = W.partitionBy("asked").orderBy("score", "vec_id")
    found = stored(found.withColumn("place", F.row_number().over(near)).filter(F.col("place") <= k + 1).drop("place"), "found")
    answers = own.join(questions, "vec").select(F.col("id").alias("query_id"), "asked").join(found, "asked").filter("query_id != vec_id")
    each = W.partitionBy("query_id").orderBy("score", "vec_id")
    return answers.withColumn("rank", F.row_number().over(each)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
