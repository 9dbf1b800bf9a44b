"""From raw documents to packed training sequences, in five stages.

A stage takes (spark, docs, sf_dir) and returns a DataFrame. Its rows are written as Parquet below the
shared checkpoint folder and read again as the next stage's docs. All but the last return the
columns of the documents they got, whatever these are; they need doc_id, text and lang. Null and
empty texts do not pass the classifier; repeated rows are treated alike; rows without an id pass or
fail by their text alone. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm import classifier, lines, minhash, rules
from casebook.llm.common import prepared, stored, table
from casebook.llm.queries import packed

#: No SQL expresses the classifier, the alignment, the sketches or the tokenizer.
ORACLE_SQL = None
NEEDED = ("doc_id", "text", "lang")


def changed(docs: DataFrame, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The columns of the documents after a step that may add columns and drop rows.

    Columns that the step does not need are renamed meanwhile, so none can clash with added ones.
    """
    inner = [c if c in NEEDED else f"_other_{k}" for k, c in enumerate(docs.columns)]
    return step(docs.toDF(*inner)).select(*(F.col(i).alias(c) for i, c in zip(inner, docs.columns, strict=True)))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the weak-label classifier accepts. It is trained on these documents."""
    model = classifier.train(docs)
    return changed(docs, lambda own: classifier.classify(own, model).filter("kept"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the rules, with cutoffs from the labelled among them."""
    labels = table(spark, sf_dir, "labels", "doc_id", "quality")
    return changed(docs, lambda own: rules.judge(own, labels).filter("kept"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without lines that an earlier one has; those that lose every word go."""
    empty = (F.col("removed_lines") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return changed(docs, lambda own: lines.dedup_lines(own).filter(~empty))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates."""
    judged = minhash.near_duplicates(docs)
    gone = judged.groupBy(F.col("doc_id").alias("_gone")).agg(F.max("kept").alias("_kept")).filter("not _kept").select("_gone")
    return changed(docs, lambda own: own.join(stored(gone, "near-copies"), F.col("doc_id") == F.col("_gone"), "left_anti"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents' tokens and their places in sequences."""
    return packed(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of a documents table."""
    docs = prepared(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
