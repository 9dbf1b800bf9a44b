"""Phrase collocations from suffix subtrees of word prefixes.

Every place of a text begins a suffix of at most five words within its piece. The tree of these
suffixes has a node for each phrase, whose leaf total is the phrase's number of occurrences. It is
partitioned vertically: prefixes of one word, then of two, are counted; those too rare for any phrase
end their suffixes; prefixes with more suffixes than a memory budget are extended by a further word until
they fit; and prefixes are put together to groups of at most the budget. The subtrees of a group are
built by sorting its suffixes, each group by itself, and phrases are read off where prefixes change.

A phrase is scored by how much more often it occurs than its parts would if they were independent.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from casebook.llm.common import _powers, mixed, prepared, stored

#: Least occurrences of a phrase, most words of one, and phrases reported for each language.
LEAST, WORDS, TOP = 100, 5, 2000
#: Suffixes of a group: what one task sorts. Prefixes with more are extended.
BUDGET = 1 << 20
#: Slots that a group is made of, on average.
SLOTS = 4
#: Most bits of the flags of frequent prefixes, 16 MB; beyond 8 million prefixes more rare ones pass.
FLAG_BITS = 1 << 27
#: Bytes of text of one language that are handled at once; a longer text is handled alone.
CHUNK = 1 << 21
#: Bytes from which on a word is hashed by itself.
LONG_WORD = 64
#: Bytes that part pieces, and those that part words.
PIECE_ENDS, GAPS = b".,;:!?\n\v\f\r", b" \t"
UNKNOWN = "und"
SUFFIX = [f"w{k}" for k in range(1, WORDS + 1)]


class Pieces:
    """The words of texts as arrays: places, hashes, and whether the next word is in the same piece.

    A-Z are lower-cased. ``seed`` chooses the hashes; none is 0.
    """

    def __init__(self, texts: list[bytes], seed: int):
        self.text = b"\n".join([*texts, b""]).lower()
        data = np.frombuffer(self.text, np.uint8)
        ends, gap = np.zeros(256, bool), np.zeros(256, bool)
        ends[list(PIECE_ENDS)] = True
        gap[list(PIECE_ENDS + GAPS)] = True
        edge = np.flatnonzero(np.diff(gap[data], prepend=True, append=True))
        self.starts, self.ends = edge[0::2], edge[1::2]
        piece = np.cumsum(ends[data])[self.starts] if len(self.starts) else self.starts
        self.goes_on = np.append(piece[1:] == piece[:-1], False)[: len(piece)]
        up, down = _powers(len(data) + 1)
        values = np.random.Generator(np.random.PCG64(seed)).integers(1, 1 << 63, 256, dtype=np.uint64)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * up[: len(data)], out=sums[1:])
        self.hashes = mixed((sums[self.ends] - sums[self.starts]) * down[self.starts])
        for k in np.flatnonzero(self.ends - self.starts >= LONG_WORD).tolist():
            self.hashes[k] = xxhash.xxh3_64_intdigest(self.text[self.starts[k] : self.ends[k]], seed)
        self.hashes[self.hashes == 0] = 1

    def word(self, k: int) -> str:
        return self.text[self.starts[k] : self.ends[k]].decode()


def by_language(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Texts of one language, about ``CHUNK`` bytes of them or less; batches hold language and text."""
    held: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}
    for batch in batches:
        for language, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if text:
                held.setdefault(language, []).append(text.encode())
                size[language] = size.get(language, 0) + len(held[language][-1])
                if size[language] >= CHUNK:
                    yield language, held.pop(language)
                    del size[language]
        if sum(size.values()) >= 4 * CHUNK:
            yield from held.items()
            held, size = {}, {}
    yield from held.items()


def counted(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal rows put together: rows and their numbers. Some may stay apart, none are mistaken."""
    value = rows[:, 0].copy()
    for k in range(1, rows.shape[1]):
        value = mixed(value * np.uint64(0x9FB21C651E98DF25) + rows[:, k])
    order = np.argsort(value)
    rows = rows[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    first = np.flatnonzero(new)
    return rows[first], np.diff(np.append(first, len(rows)))


def flag_values(rows: np.ndarray, language: str) -> np.ndarray:
    """A value for each prefix of a language, whose lowest bits choose its flag."""
    value = np.full(len(rows), xxhash.xxh3_64_intdigest(language.encode()), np.uint64)
    for k in range(rows.shape[1]):
        value = mixed(value * np.uint64(0x9FB21C651E98DF25) + rows[:, k])
    return value


class Flags:
    """One bit for each of many values: unset for all values that are not among those given."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def of(self, values: np.ndarray) -> np.ndarray:
        at = values & np.uint64(64 * len(self.bits) - 1)
        return (self.bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def flags(prefixes: DataFrame, words: int) -> Broadcast:
    """The flags of prefixes (lang, w1…) as a broadcast of at most ``FLAG_BITS`` bits."""
    spark = prefixes.sparkSession
    names = SUFFIX[:words]

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            language = batch.column(0).dictionary_encode()
            rows = np.stack([batch.column(k + 1).to_numpy().view(np.uint64) for k in range(words)], axis=1)
            out = np.empty(len(rows), np.uint64)
            for k, name in enumerate(language.dictionary.to_pylist()):
                own = np.asarray(language.indices) == k
                out[own] = flag_values(rows[own], name)
            yield pa.RecordBatch.from_arrays([pa.array(out.view(np.int64))], names=["value"])

    n = prefixes.count()
    bits = min(FLAG_BITS, max(1 << 10, 1 << (16 * n).bit_length()))
    at = F.col("value").bitwiseAND(bits - 1)
    set_bits = (
        prefixes.select("lang", *names)
        .mapInArrow(values, "value long")
        .groupBy(F.shiftright(at, 6).alias("at"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(value & {bits - 1} & 63 as int))")).alias("bits"))
        .toArrow()
    )
    held = np.zeros(bits // 64, np.uint64)
    held[set_bits["at"].to_numpy()] = set_bits["bits"].to_numpy().view(np.uint64)
    return spark.sparkContext.broadcast(held)


def scanned(docs: DataFrame, seed: int, words: int, rows_of: Callable[[], Callable[[str, Pieces], np.ndarray]]) -> DataFrame:
    """Rows lang, w1…, n: what ``rows_of`` makes of the texts of a language, counted chunk by chunk."""
    names = SUFFIX[:words]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = rows_of()
        for language, texts in by_language(batches):
            rows = find(language, Pieces(texts, seed))
            if len(rows):
                rows, n = counted(rows)
                columns = [pa.array(np.ascontiguousarray(rows[:, k]).view(np.int64)) for k in range(words)]
                lang = pa.DictionaryArray.from_arrays(np.zeros(len(n), np.int32), [language]).cast(pa.string())
                yield pa.RecordBatch.from_arrays([lang, *columns, pa.array(n)], names=["lang", *names, "n"])

    return docs.mapInArrow(run, f"lang string, {', '.join(f'{w} long' for w in names)}, n long")


def differing(pieces: Pieces, first: np.ndarray) -> np.ndarray:
    """Flags of the words that are spelled otherwise than the word at ``first``, letter by letter."""
    data = np.frombuffer(pieces.text, np.uint8)
    size = pieces.ends - pieces.starts
    out = size != size[first]
    before = np.cumsum(size) - size
    at = np.arange(int(size.sum())) + np.repeat(pieces.starts - before, size)
    there = np.minimum(at + np.repeat(pieces.starts[first] - pieces.starts, size), len(data) - 1)
    return out | (np.add.reduceat(data[at] != data[there], before) > 0 if len(at) else out)


def word_counts(docs: DataFrame, seed: int) -> DataFrame:
    """Rows lang, word, w1 (its hash), n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for language, texts in by_language(batches):
            pieces = Pieces(texts, seed)
            _, first, back, n = np.unique(pieces.hashes, return_index=True, return_inverse=True, return_counts=True)
            other = np.flatnonzero(differing(pieces, first[back]))
            n -= np.bincount(back[other], minlength=len(n))
            at, n = np.append(first, other), np.append(n, np.ones(len(other), np.int64))
            spelled = [pieces.word(k) for k in at.tolist()]
            columns = [pa.array([language] * len(n), pa.string()), pa.array(spelled, pa.string()), pa.array(pieces.hashes[at].view(np.int64)), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "word", "w1", "n"])

    rows = docs.mapInArrow(run, "lang string, word string, w1 long, n long")
    return rows.groupBy("lang", "word").agg(F.max("w1").alias("w1"), F.sum("n").alias("n"))


def words_of(docs: DataFrame) -> tuple[DataFrame, int]:
    """The words with their counts, and a seed under which no two words of a language share a hash."""
    for seed in range(1, 100):
        words = stored(word_counts(docs, seed), "words")
        if words.groupBy("lang", "w1").count().filter("count > 1").isEmpty():
            return words, seed
    raise RuntimeError("no seed parts the words")


def key(words: int) -> list[str]:
    return ["lang", *SUFFIX[:words]]


def subtrees(suffixes: DataFrame, least: int) -> DataFrame:
    """Nodes (lang, phrase, n) of the suffixes of each partition, sorted by lang, w1…; ``depth`` words of
    a suffix lead to its subtree, whose root is not among the nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                if sum(b.num_rows for b in held) >= 1 << 16:
                    whole = pa.Table.from_batches(held).combine_chunks()
                    cut = open_at(whole)
                    yield from nodes(whole.slice(0, cut))
                    held = whole.slice(cut).to_batches()
        if held:
            yield from nodes(pa.Table.from_batches(held).combine_chunks())

    def changes(table: pa.Table, words: int) -> np.ndarray:
        """Whether each row's prefix differs from that of the row before."""
        codes = table.column("lang").combine_chunks()
        codes = codes.chunk(0) if isinstance(codes, pa.ChunkedArray) else codes
        lang = np.asarray(codes.dictionary_encode().indices)
        new = np.ones(len(lang), bool)
        new[1:] = lang[1:] != lang[:-1]
        for name in SUFFIX[:words]:
            column = table.column(name).to_numpy()
            new[1:] |= column[1:] != column[:-1]
        return new

    def open_at(table: pa.Table) -> int:
        """Where the last prefix of three words begins: it may go on in the next batch."""
        return int(np.flatnonzero(changes(table, 3))[-1])

    def nodes(table: pa.Table) -> Iterator[pa.RecordBatch]:
        if not table.num_rows:
            return
        n, depth = table.column("n").to_numpy(), table.column("depth").to_numpy()
        columns = [table.column(name).to_numpy() for name in SUFFIX]
        for words in range(3, WORDS + 1):
            first = np.flatnonzero(changes(table, words))
            total = np.add.reduceat(n, first)
            own = first[(total >= least) & (columns[words - 1][first] != 0) & (depth[first] < words)]
            if len(own):
                total = total[np.searchsorted(first, own)]
                phrases = np.stack([c[own] for c in columns[:words]], axis=1)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1, dtype=np.int32) * words), pa.array(phrases.ravel()))
                lang = table.column("lang").take(pa.array(own)).combine_chunks()
                lang = lang.chunk(0) if isinstance(lang, pa.ChunkedArray) else lang
                yield pa.RecordBatch.from_arrays([lang, lists, pa.array(total)], names=["lang", "phrase", "n"])

    return suffixes.select("lang", *SUFFIX, "n", "depth").mapInArrow(run, "lang string, phrase array<long>, n long")


def grouped(suffixes: DataFrame, pairs: DataFrame, budget: int, least: int) -> tuple[DataFrame, list[DataFrame]]:
    """Suffixes dealt into partitions, one for each group of prefixes, with the ``depth`` of their
    prefix; and the nodes (lang, phrase, n) that were counted to extend prefixes over the budget.

    Prefixes are hashed into slots, whose sizes are summed on the cluster; as many slots as fit the
    budget are a group. There are about ``SLOTS`` slots for each budget's worth of suffixes.
    """
    spark = suffixes.sparkSession
    known: list[DataFrame] = []
    depth: Column = F.lit(2)
    heavy = pairs.filter(F.col("n") > budget)
    for words in range(2, WORDS):
        heavy = stored(heavy.select(*key(words), F.lit(True).alias(f"over{words}")), "heavy")
        if heavy.isEmpty():
            break
        suffixes = suffixes.join(heavy, key(words), "left")
        under = suffixes.filter(f"over{words} and w{words + 1} != 0")
        counts = stored(under.groupBy(*key(words + 1)).agg(F.sum("n").alias("n")), "extended")
        known.append(counts.filter(F.col("n") >= least).select("lang", F.array(*SUFFIX[: words + 1]).alias("phrase"), "n"))
        depth = F.when(F.col(f"over{words}"), words + 1).otherwise(depth)
        heavy = counts.filter(F.col("n") > budget)
    prefix = F.array(*(F.when(F.lit(k) <= F.col("depth"), F.col(w)).otherwise(0) for k, w in enumerate(SUFFIX, 1)))
    rows = suffixes.select("lang", *SUFFIX, "n", depth.alias("depth"))
    rows = rows.filter(f"depth < {WORDS}").withColumn("value", F.xxhash64("lang", prefix))
    total = suffixes.count()
    slots = SLOTS * (total // budget + 1)
    slot = F.pmod("value", F.lit(slots)).cast("long")
    sizes = dict(rows.groupBy(slot.alias("slot")).count().collect())
    group, used, groups = 0, 0, []
    for k in range(slots):
        size = sizes.get(k, 0)
        if used and used + size > budget:
            group, used = group + 1, 0
        groups.append((k, group))
        used += size
    dealt = F.broadcast(spark.createDataFrame(groups, "slot long, grp int"))
    rows = rows.withColumn("slot", slot).join(dealt, "slot")
    return rows.repartitionById(group + 1, "grp").sortWithinPartitions("lang", *SUFFIX), known


def phrase_counts(df: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """Words (lang, word, w1, n: all of them) and phrases (lang, phrase, n) of two to ``WORDS`` words
    that occur ``least`` times or more; a phrase is the hashes of its words, which the words name."""
    prepared(df.sparkSession)
    docs = df.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text"))
    words, seed = words_of(docs)
    often = flags(words.filter(F.col("n") >= least), 1)

    def reach(language: str, pieces: Pieces, bits: np.ndarray) -> np.ndarray:
        """Whether a place and the next are frequent words of one piece."""
        frequent = Flags(bits).of(flag_values(pieces.hashes[:, None], language))
        return frequent & np.append(frequent[1:], False)[: len(frequent)] & pieces.goes_on

    def find_pairs() -> Callable[[str, Pieces], np.ndarray]:
        bits = often.value

        def find(language: str, pieces: Pieces) -> np.ndarray:
            at = np.flatnonzero(reach(language, pieces, bits))
            return np.stack((pieces.hashes[at], pieces.hashes[at + 1]), axis=1)

        return find

    pairs = scanned(docs, seed, 2, find_pairs).groupBy(*key(2)).agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    pairs = stored(pairs, "pairs")
    both = flags(pairs, 2)

    def find_suffixes() -> Callable[[str, Pieces], np.ndarray]:
        bits, pair_bits = often.value, both.value

        def find(language: str, pieces: Pieces) -> np.ndarray:
            own = np.append(pieces.hashes, np.zeros(WORDS, np.uint64))
            linked = np.zeros(len(own), bool)
            at = np.flatnonzero(reach(language, pieces, bits))
            linked[at] = Flags(pair_bits).of(flag_values(np.stack((own[at], own[at + 1]), axis=1), language))
            at = np.flatnonzero(linked[:-1] & linked[1:])
            rows = np.zeros((len(at), WORDS), np.uint64)
            on = np.ones(len(at), bool)
            rows[:, 0] = own[at]
            for k in range(1, WORDS):
                on &= linked[at + k - 1]
                rows[:, k] = np.where(on, own[at + k], 0)
            return rows

        return find

    suffixes = stored(scanned(docs, seed, WORDS, find_suffixes), "suffixes")
    rows, known = grouped(suffixes, pairs, budget, least)
    phrases = pairs.select("lang", F.array("w1", "w2").alias("phrase"), "n").unionByName(subtrees(rows, least))
    for more in known:
        phrases = phrases.unionByName(more)
    return words, stored(phrases, "phrases")


def collocations(
    df: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, top: int = TOP, budget: int = BUDGET
) -> DataFrame:
    """The phrases of each language that occur more often than their parts suggest.

    Texts are lower-cased (A-Z), cut into pieces at ``PIECE_ENDS`` and into words at ``GAPS``; a null
    language is ``UNKNOWN``. Phrases have two to five words and occur ``least`` times or more (a). Cut
    into a first part (l times) and a rest (r times), a phrase among n words has the score
    floor(1000 * a * n / (l * r)); the lowest of its cuts counts, of equal ones the first. Phrases that
    lie in a longer one as often as they occur at all are left out. Rows out, ``top`` for each language
    by score and a, descending, and phrase: lang, rank, phrase, a, l, r, n, score.

    Null and empty texts have no words; repeated rows count again; an empty table gives no rows. Scores
    are computed in decimals of 38 digits, exact for up to 10**15 words. Texts are scanned three times; only
    counts are shuffled. Words are compared by hashes that are checked to differ for all words.
    """
    words, phrases = phrase_counts(df, lang, text, least, budget)
    ones = words.filter(F.col("n") >= least).select("lang", F.array("w1").alias("phrase"), "n")
    counts = stored(ones.unionByName(phrases), "phrase-counts")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    size = F.size("phrase")

    longer = phrases.filter(size > 2)
    parts = F.array(F.slice("phrase", 1, size - 1), F.slice("phrase", 2, size - 1))
    covers = longer.select("lang", F.explode(parts).alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("most"))
    alone = phrases.join(covers, ["lang", "phrase"], "left").filter("most is null or most < n").select("lang", "phrase", F.col("n").alias("a"))

    cuts = alone.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    cuts = cuts.withColumns({"begin": F.slice("phrase", F.lit(1), F.col("k")), "rest": F.slice("phrase", F.col("k") + 1, size - F.col("k"))})
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("begin"), F.col("n").alias("l")), ["lang", "begin"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    cuts = cuts.join(totals, "lang")
    exact = lambda c: f"cast({c} as decimal(15, 0))"
    score = F.expr(f"(1000BD * {exact('a')} * {exact('n')}) div ({exact('l')} * {exact('r')})")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r", "n")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.n", "cut.score")

    first = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    best = stored(scored.withColumn("rank", F.rank().over(first)).filter(F.col("rank") <= top).drop("rank"), "best-phrases")
    named = best.select("lang", "phrase", F.posexplode("phrase").alias("k", "w1")).join(words.select("lang", "w1", "word"), ["lang", "w1"])
    spelled = named.groupBy("lang", "phrase").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "word"))), lambda x: x.word), " ").alias("spelled"))
    found = best.join(spelled, ["lang", "phrase"]).drop("phrase").withColumnRenamed("spelled", "phrase")
    found = found.withColumn("rank", F.row_number().over(first.orderBy(F.desc("score"), F.desc("a"), "phrase")).cast("long")).filter(F.col("rank") <= top)
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
