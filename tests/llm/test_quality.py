import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlens.llm import quality_rules as Q
from roadlens.llm import ranker as R


def base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    counts, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if counts[g] > 1:
            covered |= {i, i + 1, i + 2}
    seen, repeats = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeats += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), repeats, len(covered)


def test_base_counts(odd, odd_rows, empty, small):
    for df, rows in ((odd, odd_rows), (small, [(r.doc_id, r.text) for r in small.collect()])):
        out = Q.judged(df).collect()
        want = sorted(((i, *base(t)) for i, t in rows), key=str)
        assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out), key=str) == want
        for r in out:
            assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
            assert r.kept == (not r.base_failed and r.posterior >= 0.5)
    assert Q.judged(empty).count() == 0


def test_repeated_windows_by_hand(spark):
    texts = ["a b c a b c", "a a a a a", "a b c d", "x a b c y a b c z", "a b", "a b c a b a b c", "p q r " * 40]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_repeat_words for r in Q.counts(df).collect()}
    assert got == {k: base(t)[4] for k, t in enumerate(texts)}


def test_verdicts_agree_with_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = Q.judged(docs).join(labels, "doc_id").where("NOT base_failed").collect()
    assert sum(r.kept for r in rows if r.quality == 1) >= 0.99 * sum(r.quality == 1 for r in rows)
    assert sum(not r.kept for r in rows if r.quality == 0) >= 0.9 * sum(r.quality == 0 for r in rows)


def test_estimation_finds_planted_accuracies():
    draw = np.random.default_rng(1)
    truth, counts = draw.random(40_000) < 0.8, Counter()
    planted = [(0.95, 0.7), (0.9, 0.6), (0.97, 0.5), (0.92, 0.8)]
    for good in truth:
        votes = []
        for on_good, on_bad in planted:
            right = draw.random() < (on_good if good else on_bad)
            votes.append(0 if draw.random() < 0.2 else (1 if good == right else -1))
        counts[tuple(votes)] += 1
    prior, accuracy = Q.estimate(sorted(counts.items()))
    assert abs(prior - 0.8) < 0.05
    assert all(abs(a - p) < 0.08 for got, want in zip(accuracy, planted) for a, p in zip(got, want))


def test_no_python_in_plan(odd):
    plan = Q.judged(odd)._jdf.queryExecution().executedPlan().toString() + Q.counts(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan


def test_ranker_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = R.scored(docs, R.fit(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert len(bad) > 80 and np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad]) > 0.995
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_ranker_defined_cases(spark, odd, odd_rows, empty):
    labels = spark.createDataFrame([(1, 1), (9, 0), (9, 1), (10, 1), (None, 0), (6, None)], "doc_id long, quality int")
    ranker = R.fit(odd, labels)
    assert ranker == R.fit(odd, labels)
    assert R.scored(odd, ranker).count() == len(odd_rows)
    assert R.scored(empty, ranker).count() == 0
    assert R.fit(odd, labels.where("false")) == R.CONSTANT
    assert {r.predicted for r in R.scored(odd, R.CONSTANT).collect()} == {1}
    kept = R.accepted(odd, ranker)
    assert kept.schema == odd.schema
    assert kept.count() == R.scored(odd, ranker).where("predicted = 1").count()


def test_ranker_ignores_labels_of_held_out_rows(spark, small):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    flipped = labels.withColumn("held", R.held_out(labels.doc_id)).selectExpr("doc_id", "if(held, 1 - quality, quality) AS quality")
    assert R.fit(small, labels) == R.fit(small, flipped)


def _labelled(spark, n, share, seed):
    """Feature rows with a noisy linear preference."""
    draw = np.random.default_rng(seed)
    x = np.round(draw.random((n, R.N_FEATURES)), 3)
    quality = (x @ np.linspace(-1, 1, R.N_FEATURES) + 0.3 * draw.standard_normal(n) > np.quantile(x @ np.linspace(-1, 1, R.N_FEATURES), share)).astype(int)
    return x, quality, spark.createDataFrame([(k, int(q), v.tolist()) for k, (q, v) in enumerate(zip(quality, x))], "doc_id long, quality int, x array<double>")


def _plain(x, quality):
    """All pairs at once, as one matrix."""
    mean, scale = x.mean(axis=0), x.std(axis=0)
    z, w = (x - mean) / scale, np.zeros(x.shape[1])
    diff = (z[quality == 1][:, None] - z[quality == 0][None]).reshape(-1, x.shape[1])
    for _ in range(R.STEPS):
        p = 1 / (1 + np.exp(np.clip(diff @ w, -35, 35)))
        step = np.linalg.solve((diff * (p * (1 - p))[:, None]).T @ diff / len(diff) + R.RIDGE * np.eye(len(w)), R.RIDGE * w - (diff * p[:, None]).mean(axis=0))
        w -= step / max(1.0, np.abs(step).max() / 2)
    return w, float(np.quantile(z @ w, (quality == 0).mean())), 3 / (z @ w).std()


def test_ranker_like_all_pairs_compared(spark):
    x, quality, rows = _labelled(spark, 400, 0.2, 3)
    got, (w, cut, steepness) = R.learn(rows), _plain(x, quality)
    assert np.allclose(got.weights, w, atol=1e-5) and abs(got.cut - cut) < 1e-5 and abs(got.steepness - steepness) < 1e-5


@pytest.mark.parametrize("share", [0.004, 0.3, 0.996])
def test_every_labelled_row_is_in_a_block_with_both_labels(spark, monkeypatch, share):
    monkeypatch.setattr(R, "BLOCK", 40)
    x, quality, rows = _labelled(spark, 1000, share, 5)
    blocks = R._blocks(rows, {q: int((quality == q).sum()) for q in (0, 1)}).collect()
    assert len(blocks) == 25 and all(b.good and b.bad and len(b.good) + len(b.bad) <= 41 for b in blocks)
    for q, name in ((1, "good"), (0, "bad")):
        assert {tuple(v) for b in blocks for v in b[name]} == {tuple(v) for v in x[quality == q].tolist()}
    fitted = R.learn(rows)
    assert fitted == R.learn(rows.orderBy(F.desc("doc_id")).repartition(5)) and np.corrcoef(fitted.weights, np.linspace(-1, 1, R.N_FEATURES))[0, 1] > 0.5


def test_ranker_counts_labels_beyond_a_sample(spark):
    """Rejected rows alone beyond the 6,000 smallest id hashes: a sample of those has one label."""
    ids = spark.range(8000).withColumnRenamed("id", "doc_id").where(~R.held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id")).collect()
    rows = [(r.doc_id, f"some plain words {r.doc_id}" if k < 6000 else f"$$ ## {r.doc_id} !!", int(k < 6000)) for k, r in enumerate(ids)]
    assert 6000 < len(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    got = R.scored(df, R.fit(df.drop("quality"), df.drop("text"))).join(df, "doc_id")
    assert got.where("predicted <> quality").count() <= 1  # the cut lies between the labels


def test_quantile_is_exact(spark, monkeypatch):
    monkeypatch.setattr(R, "KEPT", 10)
    draw = np.random.default_rng(2)
    values = np.concatenate([draw.standard_normal(900), np.full(700, 0.25), [1e9, -1e-12, 1e-12]])
    df = spark.createDataFrame([(float(v),) for v in values], "raw double")
    for below in (1, 2, 400, 800, 1100, len(values) - 1):
        assert abs(R.quantile(df, below, len(values)) - np.quantile(values, below / len(values))) <= 1e-9 * max(1, abs(np.quantile(values, below / len(values))))
