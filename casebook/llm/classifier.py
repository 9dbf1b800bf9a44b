"""Quality classifier from weak labels.

Overlapping heuristic labellers vote on every document. Expectation-maximisation over the counts of
vote patterns estimates how often each labeller votes how on good and on bad documents, without
any labels. The posterior of a document's pattern is its weak label, and weak labels train a linear
scorer on hashed word shapes, which generalises beyond the labellers' thresholds.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import Words, chunks, prepared, with_columns

#: Documents the scorer is fitted on, at most; the votes of all documents are counted.
SAMPLE = 8000
BUCKETS = 1 << 15
ROUNDS, STEPS = 200, 300
#: Rates of the labellers: at least the first is a bad vote, at most the second a good one.
LABELLERS = {
    "symbols": (0.2, 0.02),
    "capitals": (0.5, 0.2),
    "stutter": (0.3, 0.05),
    "shouting": (0.3, 0.05),
    "echo": (0.5, 0.3),
    "bars": (0.15, 0.02),
    "endless": (0.98, 0.95),
    "ragged": (0.3, 0.05),
    "noise": (0.2, 0.08),
}


def _table(members: bytes) -> np.ndarray:
    return np.isin(np.arange(256), list(members)).astype(np.int64)


_SYMBOL, _BANG, _BAR, _STOP = (_table(x) for x in (b"#*$%&|<>", b"!", b"|", b".:;?"))
_ENDS = _table(b"#*$%&|<>!")
_PLAIN = _table(bytes([*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256), 32, *range(9, 14)]))
_UPPER, _LOWER = _table(bytes(range(65, 91))), _table(bytes(range(97, 123)))
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123] = _SHAPE[128:] = ord("a")
_SHAPE[65:91] = ord("A")
_SHAPE[48:58] = ord("0")
_BETWEEN = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_SHAPE[_BETWEEN] = 32


def shape(text: bytes) -> bytes:
    """The text with letters, capitals and digits as a, A and 0, and runs of one kind cut to one."""
    kinds = _SHAPE[np.frombuffer(text, np.uint8)]
    return kinds[np.concatenate(([True], kinds[1:] != kinds[:-1]))].tobytes() if len(kinds) else b""


class Features:
    """What votes and scores of several texts are computed from."""

    def __init__(self, texts: list[bytes]):
        words = Words(texts, fold=False)
        self.n = np.diff(words.firsts)
        some = np.maximum(self.n, 1)
        same = np.zeros(len(words.hashes), bool)
        same[1:] = words.hashes[1:] == words.hashes[:-1]
        first = words.firsts[:-1]
        same[first[first < len(same)]] = False
        again = words.repeated(3)
        upper, lower = words.bytes_per_text(_UPPER), words.bytes_per_text(_LOWER)
        stops = words.bytes_per_text(_STOP)
        self.rates = {
            "symbols": words.bytes_per_text(_SYMBOL) / some,
            "capitals": upper / np.maximum(upper + lower, 1),
            "stutter": words.per_text(same.astype(np.int64)) / some,
            "shouting": words.bytes_per_text(_BANG) / some,
            "echo": words.per_text(again.astype(np.int64)) / some,
            "bars": words.bytes_per_text(_BAR) / some,
            "endless": 1 - np.minimum(stops / some, 1),
            "ragged": words.per_text(_ENDS[words.bytes[words.ends - 1]]) / some,
            "noise": words.bytes_per_text(1 - _PLAIN) / np.maximum(words.bytes_per_text((~_BETWEEN).astype(np.int64)), 1),
        }
        shapes = Words([shape(t) for t in texts], fold=False)
        # A word's shape, and whether it repeats its neighbour or lies in a repeated window.
        salt = same.astype(np.uint64) * np.uint64(2) + again.astype(np.uint64)
        self.index = ((shapes.hashes + salt * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(17)) % np.uint64(BUCKETS)
        self.firsts = words.firsts

    def votes(self) -> np.ndarray:
        """-1, 0 or 1 per text and labeller; texts without words get no vote."""
        out = np.zeros((len(self.n), len(LABELLERS)), int)
        for k, (name, (bad, good)) in enumerate(LABELLERS.items()):
            out[:, k] = np.where(self.rates[name] >= bad, -1, np.where(self.rates[name] <= good, 1, 0))
        out[self.n == 0] = 0
        return out

    def scores(self, weights: np.ndarray, bias: float) -> np.ndarray:
        """Chance of being good: a logistic of the mean weight of a text's words."""
        sums = np.concatenate(([0.0], np.cumsum(weights[self.index], dtype=float)))
        mean = (sums[self.firsts[1:]] - sums[self.firsts[:-1]]) / np.maximum(self.n, 1)
        return np.where(self.n > 0, 1 / (1 + np.exp(-np.clip(mean + bias, -50, 50))), 0.0)


def pattern(votes: np.ndarray) -> str:
    return "".join("-0+"[v + 1] for v in votes)


class Estimate:
    """Shares of the latent kinds of documents and the chances of each vote, [kind, labeller, vote].

    Kind 0 is good. Bad documents are bad in several ways, so there is a bad kind for each labeller,
    anchored by it: the labeller recognises its kind mostly, and none accuses good documents often.
    These two bounds (labellers are better than chance) name the kinds; all else is estimated.
    """

    RECOGNISED, ACCUSED = 0.8, 0.05

    def __init__(self):
        n = len(LABELLERS)
        self.shares = np.array([0.8, *[0.2 / n] * n])
        self.chances = np.empty((n + 1, n, 3))
        self.chances[0] = 0.02, 0.18, 0.8
        self.chances[1:] = 0.3, 0.2, 0.5
        self.bound()

    def bound(self) -> None:
        bad = self.chances[:, :, 0]
        limit = bad.copy()
        limit[0] = np.minimum(bad[0], self.ACCUSED)
        own = np.arange(len(LABELLERS))
        limit[own + 1, own] = np.maximum(bad[own + 1, own], self.RECOGNISED)
        self.chances[:, :, 1:] *= ((1 - limit) / np.maximum(1 - bad, 1e-9))[:, :, None]
        self.chances[:, :, 0] = limit
        self.chances = np.clip(self.chances, 1e-4, 1)

    def kinds(self, seen: np.ndarray) -> np.ndarray:
        """Chance of each kind for rows of votes (0 bad, 1 none, 2 good)."""
        logs = np.log(self.shares) + np.log(self.chances)[:, np.arange(seen.shape[1]), seen].sum(axis=2).T
        odds = np.exp(logs - logs.max(axis=1, keepdims=True))
        return odds / odds.sum(axis=1, keepdims=True)


def estimate(counts: dict[str, int], rounds: int = ROUNDS) -> Estimate:
    """Expectation-maximisation over the counts of vote patterns, smoothed by one vote.

    Patterns without any vote tell nothing and are left out.
    """
    out = Estimate()
    told = sorted((p, n) for p, n in counts.items() if set(p) != {"0"})
    if not told:
        return out
    seen = np.array([["-0+".index(v) for v in p] for p, _ in told])
    n = np.array([n for _, n in told], float)
    for _ in range(rounds):
        part = out.kinds(seen) * n[:, None]
        out.shares = (part.sum(axis=0) + 1) / (n.sum() + len(out.shares))
        for vote in range(3):
            out.chances[:, :, vote] = part.T @ (seen == vote) + 1
        out.chances /= out.chances.sum(axis=2, keepdims=True)
        out.bound()
    return out


def fit(rows: list[tuple[np.ndarray, np.ndarray, float]]) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear scorer, from (buckets, shares, weak label) of documents.

    Logistic loss on the soft labels with a small penalty, and a fixed number of steps of scaled
    gradients. Without documents of both kinds all weights are 0 and
    the bias is that of a good document.
    """
    weights, bias = np.zeros(BUCKETS), 0.0
    target = np.array([r[2] for r in rows])
    if not len(rows) or target.max() < 0.5 or target.min() > 0.5:
        return weights, -5.0 if len(rows) and target.max() < 0.5 else 5.0
    row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    column = np.concatenate([np.array(r[0], int) for r in rows])
    value = np.concatenate([np.array(r[1], float) for r in rows])
    used, column = np.unique(column, return_inverse=True)
    w, speed, speed_bias = np.zeros(len(used)), np.full(len(used), 1e-8), 1e-8
    for _ in range(STEPS):
        score = np.bincount(row, value * w[column], len(rows)) + bias
        off = (1 / (1 + np.exp(-np.clip(score, -50, 50))) - target) / len(rows)
        gradient = np.bincount(column, value * off[row], len(used)) + 1e-6 * w
        speed += gradient**2
        speed_bias += off.sum() ** 2
        w -= 1.0 * gradient / np.sqrt(speed)
        bias -= 0.3 * off.sum() / math.sqrt(speed_bias)
    weights[used] = w
    return weights, bias


def add_votes(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds votes: a letter per labeller, in the order of ``LABELLERS``: - bad, 0 none, + good."""

    def compute(texts):
        return ([pattern(v) for chunk in chunks((t or "").encode() for t in texts) for v in Features(chunk).votes()],)

    return with_columns(df, [text], {"votes": "string"}, lambda: compute)


class Model:
    """Estimated labellers and the scorer fitted to their posteriors."""

    def __init__(self, labellers: Estimate, weights: np.ndarray, bias: float):
        self.labellers, self.weights, self.bias = labellers, weights, bias

    def weak(self, patterns: list[str]) -> list[float]:
        """Weak labels: the chance of being good."""
        seen = np.array([["-0+".index(v) for v in p] for p in patterns], int).reshape(len(patterns), len(LABELLERS))
        return self.labellers.kinds(seen)[:, 0].tolist()


def train(df: DataFrame, id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Model:
    """Counts the votes of all documents, and fits the scorer on a sample of at most ``sample``.

    At most 3 ** 9 pattern counts and the shape counts of the sample reach the driver: six bytes for
    each bucket that a sampled text fills, so at most ``6 * sample * BUCKETS`` bytes.
    The sample are the documents with the smallest hashes of their ids, one row of each id; of
    several texts of an id it is the smallest.
    """
    spark = prepared(df.sparkSession)
    docs = df.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    counts = {r.votes: r.n for r in add_votes(docs.select("text")).groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()}
    model = Model(estimate(counts), np.zeros(BUCKETS), 0.0)
    ids = docs.select("id").filter("id is not null").distinct().orderBy(F.xxhash64("id"), "id").limit(sample)
    picked = spark.createDataFrame(ids.collect(), ids.schema)

    def compute(texts):
        votes, buckets, counts = [], [], []
        for chunk in chunks((t or "").encode() for t in texts):
            features = Features(chunk)
            votes += [pattern(v) for v in features.votes()]
            for k in range(len(chunk)):
                own, n = np.unique(features.index[features.firsts[k] : features.firsts[k + 1]], return_counts=True)
                buckets.append(own.astype("<u2").tobytes())
                counts.append(n.astype("<u4").tobytes())
        return votes, buckets, counts

    drawn = docs.join(F.broadcast(picked), "id").filter("text is not null").groupBy("id").agg(F.min("text").alias("text")).select("text")
    kinds = {"votes": "string", "buckets": "binary", "counts": "binary"}
    rows = with_columns(drawn, ["text"], kinds, lambda: compute).select("votes", "buckets", "counts").collect()
    # The order of collected rows is not fixed, that of sums over them should be.
    rows = sorted((bytes(r.buckets), bytes(r.counts), r.votes) for r in rows if set(r.votes) != {"0"} and r.buckets)
    found = [(np.frombuffer(b, "<u2"), np.frombuffer(n, "<u4"), y) for (b, n, _), y in zip(rows, model.weak([r[2] for r in rows]), strict=True)]
    model.weights, model.bias = fit([(buckets, counts / counts.sum(), y) for buckets, counts, y in found])
    return model


def classify(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds votes, weak_label (chance of being good by the votes), score (by the scorer) and kept
    (a score of 0.5 or more).

    One pass without a shuffle; the weights, of fixed size, are broadcast. Null texts and texts
    without words have no votes and the score 0, and are not kept. Equal texts and repeated rows
    are judged alike. Other columns pass; columns of the added names are replaced.
    """
    spark = prepared(df.sparkSession)
    sent = spark.sparkContext.broadcast(model)

    def task():
        own = sent.value

        def compute(texts):
            votes, scores = [], []
            for chunk in chunks((t or "").encode() for t in texts):
                features = Features(chunk)
                votes += [pattern(v) for v in features.votes()]
                scores += features.scores(own.weights, own.bias).tolist()
            return votes, own.weak(votes), scores, [s >= 0.5 for s in scores]

        return compute

    return with_columns(df, [text], {"votes": "string", "weak_label": "double", "score": "double", "kept": "boolean"}, task)
