"""Line dedup by alignment of overlapping documents.

Documents that share runs of lines are aligned with patience diff, what that leaves unmatched is
aligned again exactly, and blocks of aligned lines are deleted from the later one. A run is as rare as
it can be for its first holder, so every later document is paired with the first holders of its runs, and
with no others: the pairs grow with the lines, however many documents share one. Together they find
every block that any earlier document holds.
"""

from __future__ import annotations

import bisect
import itertools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import _powers, mixed, prepared, stored, with_columns

#: Words of the least block that is deleted.
BLOCK_WORDS = 25
#: Lines that are aligned exactly at a time.
PIECE = 256
#: Documents that are sent to one copy of another.
SENT = 512


def line_values(text: str) -> tuple[list[int], list[int]]:
    """A 64-bit hash and the number of words of each line; lines end at \\n. White space around
    and between words does not count."""
    hashes, words = [], []
    for line in text.split("\n"):
        parts = line.split()
        words.append(len(parts))
        hashes.append(xxhash.xxh3_64_intdigest(" ".join(parts)) - (1 << 63) if parts else 0)
    return hashes, words


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned places (i, j) of equal values, increasing in both.

    Equal ends are aligned; between them the longest increasing run of values that occur once on
    each side splits the lists, and the parts are aligned in the same way. Parts without such a
    value align nothing but their ends; ``repeated_lines`` aligns exactly what that leaves.
    """
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, i_end, j, j_end = todo.pop()
        while i < i_end and j < j_end and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and a[i_end - 1] == b[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            out.append((i_end, j_end))
        if i == i_end or j == j_end:
            continue
        once_a, once_b = Counter(a[i:i_end]), Counter(b[j:j_end])
        place = {b[k]: k for k in range(j, j_end) if once_b[b[k]] == 1}
        unique = [(k, place[a[k]]) for k in range(i, i_end) if once_a[a[k]] == 1 and a[k] in place]
        anchors = rising(unique)
        if not anchors:
            continue
        # The anchors themselves start the parts and are aligned as equal beginnings.
        starts = [(i, j), *anchors]
        ends = [*anchors, (i_end, j_end)]
        todo += [(s[0], e[0], s[1], e[1]) for s, e in zip(starts, ends, strict=True) if s != e]
    return sorted(out)


def rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest subsequence of pairs whose second numbers rise."""
    tops: list[int] = []
    last: list[int] = []
    before: list[int] = []
    for k, (_, j) in enumerate(pairs):
        at = bisect.bisect_left(tops, j)
        before.append(last[at - 1] if at else -1)
        if at == len(tops):
            tops.append(j)
            last.append(k)
        else:
            tops[at], last[at] = j, k
    out, k = [], last[-1] if last else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def runs(hashes: np.ndarray, words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the shortest runs of lines that reach so many words: one from
    each line and one up to each line, as far as there are such.

    Any longer run is made of them: its lines lie in the run from its first line or, after that,
    in the run up to themselves. So what two lists share in runs is what they share in these.
    """
    least = max(1, least)
    total = np.concatenate(([0], np.cumsum(words, dtype=np.int64)))
    places = np.arange(len(total))
    ends = np.searchsorted(total, total + least)
    starts = np.searchsorted(total, total - least, side="right") - 1
    onward, back = ends < len(total), starts >= 0
    spans = np.concatenate((places[onward] * len(total) + ends[onward], starts[back] * len(total) + places[back]))
    starts, ends = np.divmod(np.unique(spans), len(total))
    up, down = _powers(len(total))
    # Odd values, so that lines without words, whose hash is 0, tell runs apart as well.
    values = mixed(hashes.astype(np.int64).view(np.uint64)) | np.uint64(1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * up[: len(values)], dtype=np.uint64)))
    return starts, ends, mixed((sums[ends] - sums[starts]) * down[starts])


class Holder:
    """An earlier document's lines, ready to be aligned with later ones."""

    def __init__(self, lines: list[int]):
        self.lines = lines
        self.places: dict[int, np.ndarray] | None = None

    def of(self, line: int) -> np.ndarray:
        """Where a line stands."""
        if self.places is None:
            order = np.argsort(np.array(self.lines, np.int64), kind="stable")
            values = np.array(self.lines, np.int64)[order]
            cuts = np.flatnonzero(np.diff(values, prepend=values[:1] - 1, append=values[-1:] + 1)) if len(values) else order
            self.places = {int(values[a]): order[a:z] for a, z in itertools.pairwise(cuts)}
        return self.places.get(line, NOWHERE)


NOWHERE = np.zeros(0, np.int64)


def patience_blocks(pairs: list[tuple[int, int]], words: list[int], least: int) -> set[int]:
    """Lines of the later list in blocks of an alignment, neighbours on both sides, of so many words."""
    out: set[int] = set()
    block: list[int] = []
    total, previous = 0, None
    for i, j in [*pairs, (-1, -1)]:
        if previous is None or (i, j) != (previous[0] + 1, previous[1] + 1):
            if total >= least:
                out.update(block)
            block, total = [], 0
        block.append(j)
        total += words[j] if j >= 0 else 0
        previous = (i, j)
    return out


def exact_blocks(earlier: Holder, later: list[int], words: list[int], least: int, begin: int, end: int) -> set[int]:
    """Lines of a part of the later list in blocks of so many words, by the alignment of that part without
    gaps: for each line and each of its places in the earlier list the block that ends there.

    The part is aligned in pieces of ``PIECE`` lines, each with the lines before it that make up a block;
    equal pieces, as in texts that go in a circle, are aligned once.
    """
    out: set[int] = set()
    known: dict[tuple[int, ...], list[int]] = {}
    for start in range(begin, end, PIECE):
        first, before = start, 0
        while first > begin and before < least:
            first -= 1
            before += words[first]
        piece = tuple(later[first : min(start + PIECE, end)])
        found = known.get(piece)
        if found is None:
            marked: set[int] = set()
            at, total, size = NOWHERE, NOWHERE, NOWHERE
            for k, line in enumerate(piece):
                here = earlier.of(line)
                if len(at) and len(here):
                    near = np.minimum(np.searchsorted(at, here - 1), len(at) - 1)
                    on = at[near] == here - 1
                    total, size = np.where(on, total[near], 0), np.where(on, size[near], 0)
                else:
                    total = size = np.zeros(len(here), np.int64)
                at, total, size = here, total + words[first + k], size + 1
                long = size[total >= least]
                if len(long):
                    marked.update(range(k + 1 - int(long.max()), k + 1))
            found = known[piece] = sorted(marked)
        out.update(first + k for k in found)
    return out


def repeated_lines(earlier: list[int] | Holder, later: list[int], words: list[int], least: int) -> list[int]:
    """Lines of the later document in blocks of at least so many words that the earlier one holds.

    A block is a run of neighbours on both sides; lines without words neither count nor break it. Patience
    diff aligns the documents. It gives each line one partner and keeps the order, and leaves parts that
    have no line which is unique on both sides; so what it leaves unmatched is aligned with the earlier
    document again, exactly, together with the lines around it that may belong to a block. Blocks that moved
    or that a document holds twice are found there.
    """
    holder = earlier if isinstance(earlier, Holder) else Holder(earlier)
    gone = patience_blocks(patience(holder.lines, later), words, least)
    held = [len(holder.of(line)) > 0 for line in later]
    at = 0
    while at < len(later):
        if at in gone or not held[at]:
            at += 1
            continue
        # From the first unmatched line on, and back as far as a block reaches.
        begin, before = at, 0
        while begin and held[begin - 1] and before < least:
            begin -= 1
            before += words[begin]
        end, after, last = at + 1, 0, at
        while end < len(later) and held[end] and after < least:
            if end in gone:
                after += words[end]
            else:
                after, last = 0, end
            end += 1
        if sum(words[begin:end]) >= least:
            gone |= exact_blocks(holder, later, words, least, begin, end)
        at = max(last, at) + 1
    return sorted(gone)


def find_repeated(df: DataFrame, id: str = "doc_id", text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """Documents that lose lines: id, keep (a flag per line), removed_lines, removed_words.

    A document is aligned with an earlier one (smaller id) that is the first to hold one of its
    ``runs`` of ``block_words`` words or more. Of the two the one with fewer lines is sent to the other;
    what is sent to a document goes to several copies of it if it is much.
    """
    prepared(df.sparkSession)
    docs = df.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).filter("id is not null and text is not null")

    def task():
        def compute(texts):
            found = [line_values(t) for t in texts]
            own = [runs(np.array(h, np.int64), np.array(w, np.int64), block_words)[2] for h, w in found]
            return [f[0] for f in found], [f[1] for f in found], [np.unique(k).view(np.int64) for k in own]

        return compute

    kinds = {"hashes": "array<long>", "words": "array<long>", "runs": "array<long>"}
    values = stored(with_columns(docs, ["text"], kinds, task).drop("text"), "lines")
    held = values.select("id", F.explode("runs").alias("run"))
    holders = held.groupBy("run").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last").drop("last")
    pairs = stored(held.join(holders, "run").filter("first < id").select("first", "id").distinct(), "line-pairs")

    sizes = values.groupBy("id").agg(F.max(F.size("hashes")).alias("n"))
    sized = pairs.join(sizes, "id").join(sizes.select(F.col("id").alias("first"), F.col("n").alias("n_first")), "first")
    sized = stored(sized.select("first", "id", (F.col("n_first") > F.col("n")).alias("to_first")), "line-routes")
    at, sent = F.when(F.col("to_first"), F.col("first")).otherwise(F.col("id")), F.when(F.col("to_first"), F.col("id")).otherwise(F.col("first"))
    routes = sized.select("to_first", at.alias("at"), sent.alias("sent"))
    counts = routes.groupBy("to_first", "at").agg(F.ceil(F.count(F.lit(1)) / SENT).cast("int").alias("copies"))
    routes = routes.join(counts, ["to_first", "at"]).withColumn("copy", F.pmod(F.xxhash64("sent"), F.col("copies")).cast("int"))
    guests = routes.select("to_first", "at", "copy", F.lit(True).alias("guest"), F.col("sent").alias("id"))
    hosts = counts.select("to_first", "at", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), F.lit(False).alias("guest"), F.col("at").alias("id"))
    rows = guests.unionByName(hosts).join(values.select("id", "hashes", "words"), "id")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, hosts = None, []
        for batch in batches:
            out = []
            for to_first, key, copy, guest, number, hashes, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (to_first, key, copy) != at:
                    at, hosts = (to_first, key, copy), []
                if not guest:
                    hosts.append((number, Holder(hashes) if to_first else hashes, words))
                    continue
                for host, own, weights in hosts:
                    if to_first:
                        gone = repeated_lines(own, hashes, words, block_words)
                    else:
                        gone = repeated_lines(hashes, own, weights, block_words)
                    if gone:
                        out.append((number if to_first else host, gone))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.list_(pa.int64()))], names=["id", "gone"]
            )

    order = ["to_first", "at", "copy", "guest", "id"]
    ordered = rows.select(*order, "hashes", "words").repartition("to_first", "at", "copy").sortWithinPartitions(*order)
    found = ordered.mapInArrow(align, "id long, gone array<long>")
    gone = found.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone"))
    # An id with several texts cannot say which lines go, so it keeps all.
    texts = values.groupBy("id").agg(F.count_distinct(F.xxhash64("hashes")).alias("texts"), F.first("words").alias("words"))
    own = gone.join(texts.filter("texts = 1").drop("texts"), "id")

    def flags():
        def compute(all_gone, all_words):
            out = []
            for gone, words in zip(all_gone, all_words, strict=True):
                lost = set(gone)
                out.append(([k not in lost for k in range(len(words))], len(lost), sum(words[k] for k in lost)))
            return list(zip(*out, strict=True)) if out else [()] * 3

        return compute

    added = {"keep": "array<boolean>", "removed_lines": "long", "removed_words": "long"}
    return with_columns(own, ["gone", "words"], added, flags).drop("gone", "words")


def dedup_lines(df: DataFrame, id: str = "doc_id", text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents without the blocks of lines that they share with earlier ones.

    All rows and columns stay; the text loses the deleted lines, and removed_lines and
    removed_words are added (replacing columns of these names). "Earlier" is the smaller id, so of
    equal texts the one with the smallest id stays whole and the others lose all their text if it
    has ``block_words`` words. Null texts stay null, empty ones empty; rows without an id stay as
    they are, as do rows that share an id but not the text. Repeated rows are treated alike.
    """
    added = ("removed_lines", "removed_words")
    kept = [c for c in df.columns if c.lower() not in added]
    places = [f"c{k}" for k in range(len(df.columns))]
    flat = df.toDF(*places)
    columns = dict(zip(df.columns, places, strict=True))
    own = find_repeated(df, id, text, block_words).withColumnRenamed("id", "key")
    joined = flat.join(own, flat[columns[id]].cast("long") == own.key, "left")
    parts = F.split(F.col(columns[text]), "\n", -1)
    left = F.array_join(F.filter(parts, lambda _, k: F.get("keep", k)), "\n")
    out = [
        (F.when(F.col("keep").isNotNull(), left).otherwise(F.col(columns[text])) if c == text else F.col(columns[c])).alias(c) for c in kept
    ]
    return joined.select(*out, *(F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in added))
