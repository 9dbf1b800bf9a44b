"""Token counts: the exact histogram of encoded lengths, and what follows from it for any limit."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from casebook.llm.bpe import Tokenizer
from casebook.llm.common import prepared, stored

#: Lengths that share a coarse step of the suffix sums.
STEP = 1024


def token_lengths(df: DataFrame, tokenizer: Tokenizer, text: str = "text", n_tokens: str = "n_tokens") -> DataFrame:
    """The encoded length of each text, as the only column. Null and empty texts have length 0."""
    prepared(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer.encoder()
        for batch in batches:
            found = [len(ids) // 4 for ids in coder.encode_all(batch.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], names=[n_tokens])

    return df.select(text).mapInArrow(run, f"{n_tokens} long")


def length_histogram(lengths: DataFrame, length: str = "n_tokens") -> DataFrame:
    """One row per length that occurs: n_tokens, documents, and over all documents

    * documents_longer, tokens_longer: documents longer than this and their tokens,
    * tokens_cut: the tokens left when every document is cut to this length,
    * documents_upto: documents of at most this length, the rank for quantiles,
    * total_documents, total_tokens.

    Rows with a null length are not documents. An empty table gives no rows. The counts are summed
    map-side per length; suffix sums are taken within steps of ``STEP`` lengths and over the sums
    of steps, so no task sees more than the lengths of a step or one row per step. The counts per length
    are written once below the shared checkpoint folder: the lengths are not computed twice.
    """
    prepared(lengths.sparkSession)
    step = F.floor(F.col("n_tokens") / STEP)
    counted = (
        lengths.select(F.col(length).cast("long").alias("n_tokens"))
        .filter("n_tokens is not null")
        .groupBy("n_tokens")
        .agg(F.count(F.lit(1)).alias("documents"))
        .withColumn("step", step)
    )
    counted = stored(counted, "lengths")
    sums = counted.groupBy("step").agg(
        F.sum("documents").alias("documents"), F.sum(F.col("documents") * F.col("n_tokens")).alias("tokens")
    )
    later = W.orderBy(F.desc("step")).rowsBetween(W.unboundedPreceding, -1)
    whole = W.orderBy(F.desc("step")).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    steps = sums.select(
        "step",
        *(F.coalesce(F.sum(c).over(later), F.lit(0)).alias(f"{c}_later") for c in ("documents", "tokens")),
        *(F.sum(c).over(whole).alias(f"total_{c}") for c in ("documents", "tokens")),
    )
    above = W.partitionBy("step").orderBy(F.desc("n_tokens")).rowsBetween(W.unboundedPreceding, -1)

    def longer(what: Column, name: str) -> Column:
        return (F.coalesce(F.sum(what).over(above), F.lit(0)) + F.col(f"{name}_later")).alias(f"{name}_longer")

    joined = counted.join(steps, "step").select(
        "n_tokens",
        "documents",
        longer(F.col("documents"), "documents"),
        longer(F.col("documents") * F.col("n_tokens"), "tokens"),
        "total_documents",
        "total_tokens",
    )
    return joined.select(
        "n_tokens",
        "documents",
        "documents_longer",
        "tokens_longer",
        (F.col("total_tokens") - F.col("tokens_longer") + F.col("n_tokens") * F.col("documents_longer")).alias("tokens_cut"),
        (F.col("total_documents") - F.col("documents_longer")).alias("documents_upto"),
        "total_documents",
        "total_tokens",
    )


def tokens_within(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """For each limit (context): tokens left after cutting every document to it, documents over it.

    The row of the greatest length that is not above a limit answers it by its suffix sums; below the
    smallest length every document is cut. One pass finds these rows, one value for each limit. An
    empty table has 0 of both.
    """
    held = F.struct("n_tokens", "total_tokens", "total_documents", "tokens_longer", "documents_longer")
    own = histogram.agg(
        *(F.max_by(held, F.when(F.col("n_tokens") <= limit, F.col("n_tokens"))).alias(f"at{k}") for k, limit in enumerate(limits)),
        F.max("total_documents").alias("documents"),
    )
    rows = F.array(
        *(
            F.struct(
                F.lit(int(limit)).cast("long").alias("context"),
                F.coalesce(
                    F.col(f"at{k}.total_tokens") - F.col(f"at{k}.tokens_longer") + limit * F.col(f"at{k}.documents_longer"),
                    limit * F.col("documents"),
                    F.lit(0),
                ).cast("long").alias("tokens"),
                F.coalesce(f"at{k}.documents_longer", "documents", F.lit(0)).cast("long").alias("documents_over"),
            )
            for k, limit in enumerate(limits)
        )
    )
    return own.select(F.explode(rows).alias("row")).select("row.*")


def length_quantile(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """For each share the smallest length that at least this share of the documents does not exceed."""
    asked = F.array(*(F.lit(float(s)) for s in shares))
    return (
        histogram.select("n_tokens", "documents_upto", "total_documents", F.explode(asked).alias("share"))
        .filter(F.col("documents_upto") >= F.col("share") * F.col("total_documents"))
        .groupBy("share")
        .agg(F.min("n_tokens").alias("n_tokens"))
    )
