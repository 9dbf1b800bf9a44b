"""The operators applied to the given tables, each with its SQL where SQL can express it."""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm import bpe, classifier, collocations, counts, fingerprints, lines, minhash, neighbours, oracles, packing, periodic, rules, urls, warc
from casebook.llm.common import table, with_columns

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: Folder of the tokenizer files; unset: that of the installed package.
TOKENIZERS = os.environ.get("TOKENIZER_DIR")
WORD_BPE = "word_bpe_49k.json"


def query(name: str, sql: str | None = None):
    """Register a query and the SQL it must agree with."""

    def register(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def tokenizer(spark: SparkSession) -> bpe.Tokenizer:
    """The word BPE the queries use."""
    if TOKENIZERS:
        return bpe.Tokenizer(spark, os.path.join(TOKENIZERS, WORD_BPE))
    import public_tokenizers

    return bpe.Tokenizer(spark, public_tokenizers.path(WORD_BPE))


def packed(docs: DataFrame) -> DataFrame:
    """The pieces of documents of the word BPE, each document closed by id 1."""
    coder = tokenizer(docs.sparkSession)

    def reader():
        encoder = coder.encoder()
        return lambda texts: [ids + b"\x01\0\0\0" for ids in encoder.encode_all(texts)]

    return packing.pack(docs, ids="text", reader=reader)


@query("op5_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies."""
    pieces = packed(table(spark, sf_dir, "documents", "doc_id", "text"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op7_bpe")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoding of every document, and the decoding of that."""
    coder = tokenizer(spark)
    encoded = bpe.encode(table(spark, sf_dir, "documents", "doc_id", "text"), coder)
    decoded = bpe.decode(encoded.select("doc_id", "n_tokens", "ids"), coder)
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op9_token_counts")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histogram of the documents' encoded lengths with its suffix sums."""
    return counts.length_histogram(counts.token_lengths(table(spark, sf_dir, "documents", "text"), tokenizer(spark)))


@query("op2_warc", oracles.WARC)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back through the index."""
    index = warc.write_archives(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    read = warc.read_records(index, payload=False)
    return read.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op3_near_duplicates", oracles.NEAR_DUPLICATES)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near-duplicate documents."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


#: The rules the contract fixes: host, path, verdict.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


@query("op4_url_filter", oracles.URL_FILTER)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL."""
    judged = urls.filter_urls(table(spark, sf_dir, "pages", "page_id", "url"), RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op6_line_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document keeps of its lines."""
    return lines.dedup_lines(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op8_phrase_fingerprints")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and their likeness."""
    return fingerprints.compare_with_next(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op10_quality_classifier")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weak label and score of every document."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return classifier.classify(docs, classifier.train(docs)).select("doc_id", "votes", "weak_label", "score", "kept")


@query("op1_quality_rules", oracles.QUALITY_RULES)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules' verdict on every document."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    judged = rules.judge(docs, table(spark, sf_dir, "labels", "doc_id", "quality"), with_text=False)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "failed_rules", "kept")


@query("op11_nearest_vectors")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth one."""
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return neighbours.nearest(vectors, F.col("vec_id") % 100 == 0, id="vec_id", vector="embedding", k=10)


@query("op12_collocations", oracles.COLLOCATIONS)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The phrases of each language with the highest scores."""
    return collocations.collocations(table(spark, sf_dir, "documents", "lang", "text"))


def looped(id: int | None, text: str | None) -> str | None:
    """The text that the contract of op13 makes of a document: in one of ten the words go in a circle."""
    mark = zlib.crc32(str(id).encode())
    if id is None or not text or mark % 10:
        return text
    words, g = text.encode().split(), mark // 10
    if not words:
        return text
    a = g % len(words)
    p = 1 + (len(words) - a) // (3 + g % 8)
    return b" ".join(words[:a] + [words[a + k % p] for k in range(len(words) - a)]).decode()


@query("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every document, some of them made periodic first."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    docs = with_columns(docs, ["doc_id", "text"], {"text": "string"}, lambda: lambda ids, texts: (list(map(looped, ids, texts)),))
    found = periodic.add_runs(docs)
    n, shown = (F.size("runs") / 3).cast("long"), F.col("runs").cast("array<string>")
    row = lambda k: F.concat(F.get(shown, 3 * k), F.lit(","), F.get(shown, 3 * k + 1), F.lit(","), F.get(shown, 3 * k + 2), F.lit("\n"))
    rows = F.when(n == 0, "").otherwise(F.array_join(F.transform(F.sequence(F.lit(0), (n - 1).cast("int")), row), ""))
    return found.select(
        "doc_id", n.alias("n_runs"), "start", "length", "period", F.expr("1000 * length div period").alias("exponent_milli"),
        F.sha2(rows, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
