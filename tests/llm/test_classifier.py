import math

import duckdb
import numpy as np
import pytest

from casebook.llm import classifier
from casebook.llm.queries import op10


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_labels_it_never_saw(spark, sf_dir):
    labels = dict(duckdb.sql(f"select doc_id, quality from '{sf_dir}/labels.parquet'").fetchall())
    rows = {r.doc_id: r for r in op10(spark, sf_dir).collect()}
    assert len(rows) == duckdb.sql(f"select count(*) from '{sf_dir}/documents.parquet'").fetchall()[0][0]
    right = [rows[k].kept == bool(q) for k, q in labels.items()]
    good = [rows[k].kept for k, q in labels.items() if q]
    bad = [not rows[k].kept for k, q in labels.items() if not q]
    assert np.mean(right) > 0.98 and np.mean(good) > 0.99 and np.mean(bad) > 0.9


def test_estimation_finds_the_labellers():
    """Votes drawn from known chances give these chances back."""
    rng = np.random.default_rng(1)
    true = classifier.Estimate()
    n = len(classifier.LABELLERS)
    true.chances[0], true.chances[1:] = (0.01, 0.04, 0.95), (0.1, 0.2, 0.7)
    true.chances[1:, 1] = 0.9, 0.05, 0.05
    true.chances[np.arange(n) + 1, np.arange(n)] = 0.95, 0.03, 0.02
    true.shares = np.array([0.85, *[0.15 / n] * n])
    kinds = rng.choice(n + 1, 20_000, p=true.shares)
    counts = {}
    for kind in kinds:
        votes = "".join("-0+"[rng.choice(3, p=true.chances[kind, k] / true.chances[kind, k].sum())] for k in range(n))
        counts[votes] = counts.get(votes, 0) + 1
    found = classifier.estimate(counts)
    assert abs(found.shares[0] - 0.85) < 0.02
    assert np.abs(found.chances[0] - true.chances[0]).max() < 0.03


def test_features():
    features = classifier.Features([b"", b"a b c", b"THE!! DOG!!", b"And And And And", b"one*** two### | x"])
    votes = [classifier.pattern(v) for v in features.votes()]
    names = list(classifier.LABELLERS)
    assert set(votes[0]) == {"0"}
    assert [votes[2][names.index(k)] for k in ("capitals", "shouting", "ragged")] == ["-"] * 3
    assert votes[3][names.index("stutter")] == votes[3][names.index("echo")] == "-"
    assert [votes[4][names.index(k)] for k in ("symbols", "bars", "ragged", "noise")] == ["-"] * 4
    assert classifier.shape("The 42 dögs!! RUN".encode()) == b"Aa 0 a! A"


def test_score_is_a_mean_of_weights():
    rng = np.random.default_rng(2)
    weights = rng.normal(size=classifier.BUCKETS)
    texts = [b"some words here", b"", b"Some WORDS!! here here", b"one"]
    whole = classifier.Features(texts)
    single = [float(classifier.Features([t]).scores(weights, 0.3)[0]) for t in texts]
    assert whole.scores(weights, 0.3) == pytest.approx(single)
    mean = weights[classifier.Features([texts[0]]).index].mean() + 0.3
    assert single[0] == pytest.approx(1 / (1 + np.exp(-mean))) and single[1] == 0


def test_rows(frame):
    fine = "These are plain words of a fine text, and there is another sentence. "
    rows = [(k, fine + f"Number {k} is the last one.") for k in range(40)] + [(k, "JUNK!! " * 30) for k in range(40, 50)]
    rows += [(50, None), (51, ""), (52, " \n"), (53, fine * 20_000), (53, fine * 20_000), (None, fine)]
    docs = frame(rows).selectExpr("*", "1 as kept", "2 as score", "'v' as votes", "3 as buckets")
    model = classifier.train(docs)
    got = classifier.classify(docs, model).collect()
    assert len(got) == len(rows)
    kept = {r.doc_id: r.kept for r in got}
    assert [k for k, v in kept.items() if not v] == list(range(40, 53))
    again = classifier.train(docs.repartition(5))
    assert np.array_equal(again.weights, model.weights) and again.bias == model.bias


def test_empty_table_and_one_kind(frame):
    empty = frame([])
    assert classifier.classify(empty, classifier.train(empty)).collect() == []
    same = frame([(k, "Just a plain text here. " * 5) for k in range(5)])
    assert all(r.kept for r in classifier.classify(same, classifier.train(same)).collect())


def test_sample_is_bounded(frame):
    docs = frame([(k, "Plain words are here. " * 3 if k % 4 else "NO!! " * 20) for k in range(60)])
    assert classifier.train(docs, sample=10).weights.any()


def test_a_repeated_id_gives_the_sample_one_row(spark, documents, monkeypatch):
    fitted, fit = [], classifier.fit
    monkeypatch.setattr(classifier, "fit", lambda rows: fitted.append(rows) or fit(rows))
    df = spark.createDataFrame([(k % 20, t) for k, t in enumerate(documents.values())], "doc_id long, text string")
    classifier.train(df, sample=10)
    classifier.train(df.groupBy("doc_id").agg({"text": "min"}).toDF("doc_id", "text"), sample=10)
    assert 0 < len(fitted[0]) <= 10
    assert [r[0].tolist() for r in fitted[0]] == [r[0].tolist() for r in fitted[1]]


def plain_votes(text):
    """The labellers' votes, letter by letter."""
    raw = text.encode()
    words = raw.split()
    letters = lambda members: sum(b in members for b in raw)
    some = max(len(words), 1)
    upper, lower = letters(range(65, 91)), letters(range(97, 123))
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    again = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    gaps = {9, 10, 11, 12, 13, 32}
    plain = {*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256), *gaps}
    rates = {
        "symbols": letters(b"#*$%&|<>") / some,
        "capitals": upper / max(upper + lower, 1),
        "stutter": sum(a == b for a, b in zip(words, words[1:], strict=False)) / some,
        "shouting": letters(b"!") / some,
        "echo": len(again) / some,
        "bars": letters(b"|") / some,
        "endless": 1 - min(letters(b".:;?") / some, 1),
        "ragged": sum(w[-1] in b"#*$%&|<>!" for w in words) / some,
        "noise": sum(b not in plain for b in raw) / max(sum(b not in gaps for b in raw), 1),
    }
    vote = lambda rate, bad, good: "-" if rate >= bad else "+" if rate <= good else "0"
    return "".join(vote(rates[n], *limits) for n, limits in classifier.LABELLERS.items()) if words else "0" * len(rates)


def plain_kinds(shares, chances, votes):
    odds = []
    for share, own in zip(shares, chances, strict=True):
        for k, v in enumerate(votes):
            share *= own[k]["-0+".index(v)]
        odds.append(share)
    return [x / sum(odds) for x in odds]


def plain_estimate(patterns):
    """Expectation-maximisation over the documents one by one."""
    n = len(classifier.LABELLERS)

    def bound(chances):
        for kind, own in enumerate(chances):
            for k, c in enumerate(own):
                least, most = (0.8, 1) if kind == k + 1 else (0, 0.05) if kind == 0 else (0, 1)
                bad = min(max(c[0], least), most)
                scale = (1 - bad) / max(1 - c[0], 1e-9)
                own[k] = [min(max(x, 1e-4), 1) for x in (bad, c[1] * scale, c[2] * scale)]
        return chances

    shares = [0.8] + [0.2 / n] * n
    chances = bound([[[0.02, 0.18, 0.8] if kind == 0 else [0.3, 0.2, 0.5] for _ in range(n)] for kind in range(n + 1)])
    for _ in range(classifier.ROUNDS):
        parts = [plain_kinds(shares, chances, p) for p in patterns]
        sums = [sum(p[kind] for p in parts) for kind in range(n + 1)]
        shares = [(x + 1) / (len(parts) + n + 1) for x in sums]
        counts = [[[sum(p[kind] for p, votes in zip(parts, patterns, strict=True) if votes[k] == v) + 1 for v in "-0+"] for k in range(n)] for kind in range(n + 1)]
        chances = bound([[[x / sum(c) for x in c] for c in own] for own in counts])
    return shares, chances


def test_query_against_plain_python(spark, tmp_path, monkeypatch):
    """Votes, estimation, weak labels and scorer spelled out; only the hashes of words' shapes are the operator's."""
    monkeypatch.setattr(classifier, "ROUNDS", 12)
    monkeypatch.setattr(classifier, "STEPS", 25)
    rows = duckdb.sql("select doc_id, text from '/root/testdata/sf0.001/documents.parquet' where n_chars < 3000 order by doc_id limit 120").fetchall()
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(classifier.estimate, "__defaults__", (12,))
    got = {r.doc_id: r for r in op10(spark, str(tmp_path)).collect()}
    votes = {i: plain_votes(t or "") for i, t in rows}
    assert {i: r.votes for i, r in got.items()} == votes
    shares, chances = plain_estimate([v for v in votes.values() if set(v) != {"0"}])
    weak = {i: plain_kinds(shares, chances, v)[0] for i, v in votes.items()}
    for i, r in got.items():
        assert r.weak_label == pytest.approx(weak[i], abs=1e-6)
    words = {i: classifier.Features([(t or "").encode()]).index.tolist() for i, t in rows}
    fitted = [i for i, v in votes.items() if set(v) != {"0"} and words[i]]
    weights, speed, bias, bias_speed = {}, {}, 0.0, 1e-8
    for _ in range(25):
        slope, off_sum = {}, 0.0
        for i in fitted:
            mean = sum(weights.get(b, 0.0) for b in words[i]) / len(words[i])
            off = (1 / (1 + math.exp(-(mean + bias))) - weak[i]) / len(fitted)
            off_sum += off
            for b in words[i]:
                slope[b] = slope.get(b, 0.0) + off / len(words[i])
        bias_speed += off_sum**2
        bias -= 0.3 * off_sum / math.sqrt(bias_speed)
        for b, g in slope.items():
            g += 1e-6 * weights.get(b, 0.0)
            speed[b] = speed.get(b, 1e-8) + g * g
            weights[b] = weights.get(b, 0.0) - g / math.sqrt(speed[b])
    for i, r in got.items():
        score = 1 / (1 + math.exp(-(sum(weights.get(b, 0.0) for b in words[i]) / len(words[i]) + bias))) if words[i] else 0.0
        assert r.score == pytest.approx(score, abs=1e-3) and r.kept == (r.score >= 0.5)
