"""Near-duplicate documents by SetSketch registers.

A document's set of word shingles is sketched by registers that hold exponentially spaced,
truncated minima of hash values: ``floor(1 - log_b(x))`` of the least ``x``. Registers of a union
are the larger of both, so sketches merge, and the chance that registers agree grows with the
similarity. Bands of registers find candidates; a joint likelihood over larger, smaller and equal
registers drops hopeless pairs; the full sets decide.

Candidates are never spelled out as all pairs of a bucket. Buckets are joined to candidate groups
by edges to their smallest member. A small group is compared in one task. A large one is dealt into
blocks that also get the members that share most buckets; what these leave outside the group's main
component is compared with the whole group, block by block. Where that is too much, the group is
taken apart into its buckets again. Blocks are bounded by members and by shingles, so very long
texts meet few others in a task. None of these limits drops a pair that shares a bucket.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from casebook.llm.common import components, mixed, prepared, shingle_sets, stored, with_columns

WIDTH = 5
PERCENT = 75
#: At 75 % similarity a pair shares none of 64 bands of 6 with a chance of 3.5e-6.
BANDS, ROWS = 64, 6
REGISTERS = BANDS * ROWS
#: Spacing and rate of the registers.
BASE, RATE = 1.02, 20.0
#: Log likelihood by which similarities of PERCENT and more may be worse than the best one.
SLACK = 20.0
#: Members compared in one task, hubs that every block of a larger group gets, block of the rest.
SMALL, HUBS, BLOCK = 128, 16, 256
#: Shingles compared in one task, unless a single document has more.
HELD = 1 << 22
#: Copies of a large group made for members outside its main component; with more its buckets are used.
ASKING = 8

_MULTIPLIERS = np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 31, REGISTERS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_BAND_SALT = mixed(np.arange(1, BANDS + 1, dtype=np.uint64))


def registers(shingles: np.ndarray) -> np.ndarray:
    """The registers of a set of 64-bit hashes; all 0 for the empty set."""
    if not len(shingles):
        return np.zeros(REGISTERS, np.uint16)
    high = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(REGISTERS, np.iinfo(np.uint32).max)
    for k in range(0, len(high), 256):
        np.minimum(least, (high[k : k + 256, None] * _MULTIPLIERS).min(axis=0), out=least)
    x = -np.log1p(-(least + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(x) / math.log(BASE)), 0, 65535).astype(np.uint16)


def bands(sketch: np.ndarray) -> np.ndarray:
    """A 64-bit value for each band of registers."""
    parts = sketch.reshape(BANDS, ROWS).astype(np.uint64)
    out = _BAND_SALT.copy()
    for k in range(ROWS):
        out = mixed(out ^ parts[:, k]) + np.uint64(k)
    return out.view(np.int64)


def _exceeds(x: np.ndarray) -> np.ndarray:
    """Chance that one register exceeds the other, by the share only its set has."""
    return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)


_GRID = np.linspace(0.0, 1.0, 81)


def may_match(one: np.ndarray, size: int, others: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Which sketches may belong to sets of the asked similarity.

    Joint likelihood of the similarity given both sizes: the best over all similarities must not
    beat the best over those asked for by more than ``SLACK``. A set too small or large for the
    similarity never matches.
    """
    low, high = np.minimum(size, sizes), np.maximum(size, sizes)
    out = np.zeros(len(sizes), bool)
    fit = np.flatnonzero(100 * low >= percent * high)
    if not len(fit):
        return out
    more = (one > others[fit]).sum(axis=1)[:, None]
    less = (one < others[fit]).sum(axis=1)[:, None]
    same = REGISTERS - more - less
    u = (size / (size + sizes[fit]))[:, None]
    grid = _GRID * (low[fit] / high[fit])[:, None]
    p = np.maximum(_exceeds(u - (1 - u) * grid), 1e-9)
    q = np.maximum(_exceeds((1 - u) - u * grid), 1e-9)
    loglik = more * np.log(p) + less * np.log(q) + same * np.log(np.maximum(1 - p - q, 1e-9))
    asked = np.where(100 * grid >= percent - 1e-9, loglik, -np.inf)
    asked[:, -1] = loglik[:, -1]
    out[fit] = loglik.max(axis=1) - asked.max(axis=1) <= SLACK
    return out


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two full sets have the similarity; exact."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.concatenate((a, b))
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


class Group:
    """Members of one group in a task; ``label`` names those already known to be connected."""

    def __init__(self, percent: int, width: int):
        self.percent, self.width = percent, width
        self.ids: list[int] = []
        self.labels: list[int] = []
        self.texts: list[bytes] = []
        self.asks: list[bool] = []

    def edges(self) -> Iterator[tuple[int, int]]:
        """Links that join members' components: among all, or of those that ask with the others."""
        n = len(self.ids)
        if n < 2:
            return
        sets = list(shingle_sets(self.texts, self.width))
        sizes = np.array([len(s) for s in sets])
        sketches = np.stack([registers(s) for s in sets])
        above = {label: label for label in self.labels}

        def root(x: int) -> int:
            while above[x] != x:
                above[x] = x = above[above[x]]
            return x

        others = np.array([k for k in range(n) if not self.asks[k]], int)
        askers = [k for k in range(n) if self.asks[k]]
        for place, k in enumerate(askers):
            against = others if len(others) else np.array(askers[place + 1 :], int)
            mine = root(self.labels[k])
            against = np.array([j for j in against if root(self.labels[j]) != mine], int)
            if not len(against):
                continue
            against = against[may_match(sketches[k], sizes[k], sketches[against], sizes[against], self.percent)]
            alike = (sketches[against] == sketches[k]).sum(axis=1)
            for j in against[np.argsort(-alike, kind="stable")]:
                a, b = root(self.labels[k]), root(self.labels[j])
                if a != b and linked(sets[k], sets[j], self.percent):
                    above[max(a, b)] = min(a, b)
                    yield self.ids[k], self.ids[j]


def _links(rows: DataFrame, keys: list[str], percent: int, width: int) -> DataFrame:
    """Edges (a, b) found within groups of rows (keys, asks, label, id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, key = Group(percent, width), None
        for batch in batches:
            found = []
            columns = [batch.column(k).to_pylist() for k in range(len(keys) + 4)]
            for *own, asks, label, id, text in zip(*columns, strict=True):
                if own != key:
                    found += group.edges()
                    group, key = Group(percent, width), own
                group.ids.append(id)
                group.labels.append(label)
                group.asks.append(asks)
                group.texts.append((text or "").encode())
            yield _edge_batch(found)
        yield _edge_batch(list(group.edges()))

    picked = rows.select(*keys, "asks", "label", "id", "text")
    return picked.repartition(*keys).sortWithinPartitions(*keys, "id").mapInArrow(run, "a long, b long")


def _edge_batch(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([e[0] for e in found], pa.int64()), pa.array([e[1] for e in found], pa.int64())], names=["a", "b"]
    )


def sketch_documents(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Adds to (id, text): a key of the word sequence (null without id or words), the size of the
    shingle set, and the band values."""

    def task():
        def compute(ids, texts):
            raw = [(t or "").encode() for t in texts]
            keys, sizes, values = [], [], []
            for id, text, shingles in zip(ids, raw, shingle_sets(raw, width), strict=True):
                sizes.append(len(shingles))
                known = id is not None and len(shingles)
                keys.append(xxhash.xxh3_128_digest(b" ".join(text.lower().split())) if known else None)
                values.append(bands(registers(shingles)) if known else [])
            return keys, sizes, values

        return compute

    return with_columns(docs, ["id", "text"], {"key": "binary", "n_shingles": "long", "bands": "array<long>"}, task)


def near_duplicates(df: DataFrame, id: str = "doc_id", text: str = "text", percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """Groups of documents whose shingle sets have a Jaccard similarity of ``percent`` or more.

    Rows out, one per row in: id, n_shingles, component_id (the smallest id reachable over links),
    kept (id = component_id). Texts are compared whole, A-Z folded. Null and empty texts, and texts
    without words, have an empty set and no links. Equal word sequences are one class, whatever
    their number; repeated rows get the same answer. Ids should be unique: of rows that share an id
    but not the text, each counts with the class of its own text. A row without an id has no links,
    a null component_id, and is kept. Other columns are not returned. An empty table gives no rows.
    """
    prepared(df.sparkSession)
    docs = df.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    sketches = stored(sketch_documents(docs, width).drop("text"), "sketches")
    classes = sketches.filter("key is not null").groupBy("key").agg(F.min(F.struct("id", "bands", "n_shingles")).alias("first"))
    classes = stored(classes.select("key", F.col("first.id").alias("rep"), "first.bands", F.col("first.n_shingles").alias("weight")), "classes")
    values = classes.select("rep", F.explode("bands").alias("value"))
    hubs = values.groupBy("value").agg(F.min("rep").alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = stored(values.join(hubs, "value").groupBy("rep", "hub").agg(F.sum("n").alias("n")), "buckets")

    candidates = components(shared.select(F.col("hub").alias("a"), F.col("rep").alias("b")), "candidates")
    candidates = candidates.withColumnRenamed("component", "grp").join(classes.select(F.col("rep").alias("id"), "weight"), "id")
    sizes = candidates.groupBy("grp").agg(F.count(F.lit(1)).alias("size"), F.sum("weight").alias("held"))
    sized = stored(candidates.join(sizes, "grp"), "groups")
    # The texts of candidates are gathered once. Their number grows with the documents, so the join
    # is a shuffle at every size; on large inputs Spark filters the documents by a Bloom filter first.
    members = docs.join(sized.hint("merge"), "id").withColumns({"asks": F.lit(True), "label": F.col("id")})
    members = stored(members, "members")
    one_task = (F.col("size") <= SMALL) & (F.col("held") <= HELD)
    edges = _links(members.filter(one_task), ["grp"], percent, width)

    large = sized.filter(~one_task)
    if large.isEmpty():
        edges = stored(edges, "links")
        return _result(sketches, classes, edges, id)

    big = members.filter(~one_task)
    degree = shared.groupBy(F.col("rep").alias("id")).agg(F.sum("n").alias("degree"))
    order = W.partitionBy("grp").orderBy(F.desc("degree"), "id")
    hubs = large.join(degree, "id").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= HUBS)
    hubs = hubs.withColumn("before", F.sum("weight").over(order)).filter((F.col("rank") == 1) | (F.col("before") <= HELD)).select("id")
    blocks = _tasks("size", "held", SMALL)
    dealt = big.withColumn("block", F.pmod(F.xxhash64("id"), blocks))
    spread = big.join(hubs, "id").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    both = dealt.unionByName(spread.select(dealt.columns))
    edges = stored(edges.union(_links(both, ["grp", "block"], percent, width)), "links")

    texts = big.select("id", "text")
    labels = _labelled(large, edges, "first")
    main = stored(_main(labels, "grp"), "main")
    near = labels.join(main.filter(F.col("asking") <= ASKING), "grp")
    edges = stored(edges.union(_outside(near, "grp", texts, percent, width)), "near-links")
    far = main.filter(F.col("asking") > ASKING).select("grp")
    if not far.isEmpty():
        # No edges were found in these groups since they were labelled.
        edges = _crowds(labels.join(far, "grp"), classes, shared, texts, edges, percent, width)
    return _result(sketches, classes, edges, id)


def _tasks(rows: str, held: str, most: int) -> Column:
    """Into how many tasks so many rows with so many shingles are dealt."""
    return F.greatest(F.ceil(F.col(rows) / most), F.ceil(F.col(held) / HELD), F.lit(1))


def _labelled(members: DataFrame, edges: DataFrame, name: str) -> DataFrame:
    """(id, grp, weight, label) of members: the label is the component that the edges give."""
    found = members.join(components(edges, name), "id", "left")
    return stored(found.select("id", "grp", "weight", F.coalesce("component", "id").alias("label")), f"{name}-labels")


def _main(labels: DataFrame, by: str) -> DataFrame:
    """Per group with several labels the most frequent one, and the tasks its other members
    (asking) and all members (parts) are dealt into."""
    counted = labels.groupBy(by, "label").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w"))
    main = counted.groupBy(by).agg(F.max(F.struct("n", "label", "w")).alias("main"), F.sum("n").alias("n"), F.sum("w").alias("w"))
    main = main.select(by, "n", "w", F.col("main.label").alias("main"), (F.col("n") - F.col("main.n")).alias("out"), (F.col("w") - F.col("main.w")).alias("out_w"))
    return main.filter("out > 0").select(by, "main", _tasks("out", "out_w", BLOCK).alias("asking"), _tasks("n", "w", BLOCK).alias("parts"))


def _outside(rows: DataFrame, by: str, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """Edges of members outside the main component of their group with all of the group.

    Rows: (by, id, label, main, asking, parts). A group that fits in one task is sent once.
    """
    whole = texts.join(rows, "id")
    own = F.pmod(F.xxhash64("id"), F.col("parts"))
    asked = F.pmod(F.xxhash64("id", F.lit(1)), F.col("asking"))
    zero = F.lit(0).cast("long")
    every = lambda n: F.explode(F.sequence(zero, F.col(n) - 1))
    split = whole.filter("parts > 1")
    sides = [
        whole.filter("parts = 1").withColumns({"asks": F.lit(True), "asker": zero, "part": zero}),
        split.filter("label != main").withColumns({"asks": F.lit(True), "asker": asked, "part": every("parts")}),
        split.withColumns({"asks": F.lit(False), "asker": every("asking"), "part": own}),
    ]
    return _links(sides[0].unionByName(sides[1]).unionByName(sides[2]), [by, "asker", "part"], percent, width)


def _crowds(labels: DataFrame, classes: DataFrame, shared: DataFrame, texts: DataFrame, edges: DataFrame, percent: int, width: int) -> DataFrame:
    """All edges, with those inside groups of which too much lies outside the main component.

    ``labels`` has the members of these groups, labelled by the edges so far. Such groups are chains of buckets, so they are taken apart again. Each member first asks the
    hub it shares most with; then only buckets with members of several components are left, and
    only in these the members outside the bucket's main component ask the others. Buckets of the
    same members are asked once.
    """
    labels = stored(labels, "crowds")
    best = shared.filter("rep != hub").groupBy(F.col("rep").alias("id")).agg(F.max(F.struct("n", (-F.col("hub")).alias("hub"))).alias("best"))
    named = labels.select(F.col("id").alias("hub"), F.col("label").alias("hub_label"), F.col("weight").alias("hub_weight"))
    stars = labels.join(best, "id").select("id", "label", "weight", (-F.col("best.hub")).alias("hub")).join(named, "hub")
    stars = stored(stars.filter("label != hub_label"), "stars")
    counted = stars.groupBy("hub").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w"), F.first("hub_label").alias("label"))
    counted = stored(counted.select("hub", "label", _tasks("n", "w", BLOCK).alias("asking")), "hubs")
    askers = stars.join(counted.select("hub", "asking"), "hub").withColumns({"asks": F.lit(True), "asker": F.pmod(F.xxhash64("id"), F.col("asking"))})
    asked = counted.withColumns({"id": F.col("hub"), "asks": F.lit(False), "asker": F.explode(F.sequence(F.lit(0).cast("long"), F.col("asking") - 1))})
    columns = ["hub", "asker", "asks", "label", "id"]
    rows = texts.join(askers.select(columns).unionByName(asked.select(columns)), "id")
    edges = stored(edges.union(_links(rows, ["hub", "asker"], percent, width)), "star-links")

    labels = _labelled(labels, edges, "starred")
    held = classes.select(F.col("rep").alias("id"), F.explode("bands").alias("value"))
    held = stored(held.join(labels.select("id", "label", "weight"), "id"), "crowd-buckets")
    kinds = held.groupBy("value").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y"),
    )
    kinds = stored(kinds.filter("low < high").groupBy("n", "x", "y").agg(F.min("value").alias("value")).select("value"), "mixed-buckets")
    mixed_rows = stored(held.join(kinds, "value"), "mixed-members")
    rows = mixed_rows.join(stored(_main(mixed_rows, "value"), "bucket-main"), "value")
    return stored(edges.union(_outside(rows, "value", texts, percent, width)), "all-links")


def _result(sketches: DataFrame, classes: DataFrame, edges: DataFrame, id: str) -> DataFrame:
    reach = components(edges, "linked").withColumnRenamed("id", "rep")
    named = classes.select("key", "rep").join(reach, "rep", "left")
    joined = sketches.select("id", "key", "n_shingles").join(named, "key", "left")
    component = F.coalesce("component", "rep", "id")
    return joined.select(
        F.col("id").alias(id), "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept")
    )
