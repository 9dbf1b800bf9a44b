"""Quality rules with cutoffs whose false rejections are bounded.

Three rates of a document are compared with cutoffs: symbols, repeated lines and words in repeated
windows. The cutoffs come from labelled documents that nothing else was fitted on. For a stratum and
a rule the cutoffs are tested from the loosest on: the hypothesis that the rule rejects more than its
share of good documents must be refused by the exact binomial test, and the first cutoff that fails
ends the sequence. The tests of all strata and rules share the allowed error equally (Bonferroni);
within a sequence no further correction is due. The rules of a document share the allowed rejection.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import SPACE, Words, chunks, prepared, stored, with_columns

#: Rate of good documents of a stratum that may be rejected, and chance that any bound is wrong.
ALPHA, DELTA = 0.03, 0.05
#: Words below which a document fails, and per cent of repeated words above which it does.
LEAST_WORDS, MOST_REPEATED = 50, 50
SYMBOLS = b"#*$%&|<>"
STATS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
#: Cutoffs of each rate, loosest first. A document is rejected if its rate is above the cutoff.
CUTOFFS = {
    "symbol_rate": (0.5, 0.4, 0.3, 0.2, 0.15, 0.1, 0.07, 0.05, 0.035, 0.025, 0.018, 0.012, 0.008, 0.005),
    "dup_line_rate": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.07, 0.05),
    "repeat_rate": (0.48, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.16, 0.13, 0.1, 0.08, 0.06, 0.05),
}
_IN_SYMBOLS = np.isin(np.arange(256), list(SYMBOLS)).astype(np.int64)
_STARTS = (~SPACE & ((np.arange(256) & 0xC0) != 0x80)).astype(np.int64)


def dup_lines(text: str) -> tuple[int, int]:
    """Lines of a text that hold a word, and those of them that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(" \t\n\r\x0b\x0c")]
    return len(lines), len(lines) - len(set(lines))


def statistics(texts: list[str | None]) -> list[list[int]]:
    """The columns ``STATS`` of texts."""
    out: list[list[int]] = [[] for _ in STATS]
    for chunk in chunks((t or "").encode() for t in texts):
        words = Words(chunk, fold=False)
        columns = [np.diff(words.firsts), words.bytes_per_text(_STARTS), words.bytes_per_text(_IN_SYMBOLS)]
        columns += [None, None, words.per_text(words.repeated(3).astype(np.int64))]
        for place, column in enumerate(columns):
            if column is not None:
                out[place] += column.tolist()
    lines = [dup_lines(t or "") for t in texts]
    out[3], out[4] = [x[0] for x in lines], [x[1] for x in lines]
    return out


def add_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds the columns ``STATS`` and base_failed. Texts are read whole; null is an empty text."""
    added = with_columns(df, [text], {n: "long" for n in STATS}, lambda: statistics)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return added.withColumn("base_failed", failed)


def rates() -> dict:
    """The rates as columns of ``STATS``; 0 where there is nothing to divide by."""
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))
    return {
        "symbol_rate": share("n_symbols", "word_chars"),
        "dup_line_rate": share("n_dup_lines", "n_lines"),
        "repeat_rate": share("n_repeat_words", "n_words"),
    }


def binomial_tail(k: int, n: int, p: float) -> float:
    """Chance of at most k of n, exact but for rounding. Above the mean, where no test can be
    passed, simply 1."""
    if k >= n or k > n * p:
        return 1.0
    log = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    term = total = math.exp(log)
    # Below the mean the terms fall; those that no longer change the sum are left out.
    for j in range(k, 0, -1):
        term *= j * (1 - p) / ((n - j + 1) * p)
        total += term
        if term < total * 1e-18:
            break
    return total


def chosen(good: int, rejected: list[int], cutoffs: tuple[float, ...], alpha: float, delta: float) -> float | None:
    """The strictest cutoff that fixed-sequence testing allows; None if not even the loosest."""
    best = None
    for cutoff, k in zip(cutoffs, rejected, strict=True):
        if good == 0 or binomial_tail(k, good, alpha) > delta:
            break
        best = cutoff
    return best


def calibrate(holdout: DataFrame, stratum: str = "stratum", good: str = "good", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Cutoffs of each stratum: stratum, good_documents and a column per rate (null: no cutoff).

    ``holdout`` has ``STATS``, base_failed, the stratum and whether a row is good; rows that are not
    good, or failed the base rules, do not count. One pass with sums per stratum; the sequences
    are tested where the sums lie, so there may be any number of strata.
    """
    prepared(holdout.sparkSession)
    counts = [
        F.sum((rate > cutoff).cast("long")).alias(f"{name}_{k}")
        for name, rate in rates().items()
        for k, cutoff in enumerate(CUTOFFS[name])
    ]
    usable = holdout.filter(F.col(good) & ~F.col("base_failed")).withColumnRenamed(stratum, "stratum")
    sums = stored(usable.groupBy("stratum").agg(F.count(F.lit(1)).alias("good_documents"), *counts), "holdout")
    tests = max(1, sums.count()) * len(CUTOFFS)
    own_alpha, own_delta = alpha / len(CUTOFFS), delta / tests
    inputs = ["good_documents", *(f"{n}_{k}" for n, c in CUTOFFS.items() for k in range(len(c)))]

    def compute(n, *columns):
        rows = list(zip(*columns, strict=True))
        out, at = [], 0
        for cutoffs in CUTOFFS.values():
            out.append([chosen(g, list(r[at : at + len(cutoffs)]), cutoffs, own_alpha, own_delta) for g, r in zip(n, rows, strict=True)])
            at += len(cutoffs)
        return out

    found = with_columns(sums, inputs, {f"{n}_cutoff": "double" for n in CUTOFFS}, lambda: compute)
    return found.select("stratum", "good_documents", *(f"{n}_cutoff" for n in CUTOFFS))


def judge(
    df: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", stratum: str = "lang",
    alpha: float = ALPHA, delta: float = DELTA, with_text: bool = True,
) -> DataFrame:
    """Adds ``STATS``, base_failed, failed_rules (names, parted by commas) and kept to documents.

    ``labels`` has the id and quality (1: good); they are the holdout, and of an id with several
    labels the lowest counts. A null stratum is the stratum "". A stratum without enough labelled
    documents has no cutoffs, so it loses only what fails the base rules: fewer than 50 words, or
    more than half of the words in repeated windows. With the chance 1 - ``delta`` no stratum loses
    more than ``alpha`` of its good documents to cutoffs. Null and empty texts fail. Repeated rows
    are judged alike; a row without an id is judged but calibrates nothing; an empty table gives no
    rows. Columns of the added names are replaced; all others pass, whatever their names.

    The statistics are written once. Without ``with_text`` the text is not returned and the texts are
    read once; with it they are read a second time, which costs less than a copy of them.
    """
    added = {n.lower() for n in (*STATS, "base_failed", "failed_rules", "kept")}
    kept = [n for n in df.columns if n.lower() not in added and (with_text or n != text)]
    # Plain names inside, so that no column of the input can clash with an added one.
    place = {n: f"c{k}" for k, n in enumerate(df.columns)}
    flat = df.toDF(*place.values())
    docs = add_statistics(flat.withColumn("stratum", F.coalesce(F.col(place[stratum]).cast("string"), F.lit(""))), place[text])
    marks = labels.groupBy(F.col(id).alias("marked")).agg(F.min("quality").alias("quality"))
    if with_text:
        facts = stored(docs.select(F.col(place[id]).alias("id"), "stratum", *STATS, "base_failed"), "facts")
    else:
        facts = docs = stored(docs.drop(place[text]), "facts").withColumn("id", F.col(place[id]))
    holdout = facts.join(marks, F.col("id") == F.col("marked")).withColumn("good", F.col("quality") == 1)
    cutoffs = stored(calibrate(holdout, "stratum", "good", alpha, delta), "cutoffs")
    judged = apply_cutoffs(docs, cutoffs)
    return judged.select(*(F.col(place[n]).alias(n) for n in kept), *STATS, "base_failed", "failed_rules", "kept")


def apply_cutoffs(docs: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Adds failed_rules and kept to documents with ``STATS``, base_failed and stratum."""
    limits = cutoffs.select("stratum", *(F.col(f"{n}_cutoff").alias(f"{n}_limit") for n in CUTOFFS))
    broken = [F.when(rate > F.col(f"{n}_limit"), F.lit(n)) for n, rate in rates().items()]
    failed = F.concat_ws(",", F.when(F.col("base_failed"), F.lit("base")), *broken)
    return docs.join(limits, "stratum", "left").withColumn("failed_rules", failed).withColumn("kept", F.col("failed_rules") == "")
