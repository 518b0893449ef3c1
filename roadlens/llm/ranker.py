"""Quality by Bradley-Terry ranking: a linear document score learnt from preference pairs.

From labelled rows (crc32 of doc_id as text, modulo HELD_OUT, not 0) come
pairs of a preferred and a rejected text; the logistic loss on the difference
of their features is minimised by Newton steps.  The share of rejected labels
gives the quantile of all their scores below which a text is rejected; a
logistic curve places that threshold at THRESHOLD, so scores lie in (0, 1).

Fitting takes every labelled row that is not held out: their features are
written once (about 140 bytes a row) and dealt into blocks of about BLOCK rows,
each with texts of both labels, in which every preferred text is compared with
every rejected one.  A Newton step is one pass over the blocks; means, spread and
the exact quantile are passes over the features.  What comes to the driver is one
row of sums per task, at most BINS counts, or KEPT scores.  Sums are taken in
whole multiples of 1 / FIXED, so no order of adding shows in the result.
Scoring runs over every row and whole texts, without a shuffle.  Features come
from the text alone.

Defined results: null text counts as empty; empty texts have a score; without
labels of both kinds every score is THRESHOLD; a doc_id labelled twice has its
smaller label; a null doc_id is not held out; repeated rows score alike; extra
columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import crc_mod, id_and_text, places, slices

HELD_OUT = 5
THRESHOLD = 0.3
BLOCK = 2048
RIDGE = 1e-3
STEPS = 25
FIXED = float(1 << 32)
BINS = 1024
KEPT = 10_000

_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
_DIGITS = bytes(range(48, 58))
_MARKS = b"!?"
_STOPS = b".,;:"
N_FEATURES = 17


def _share(text: bytes, chars: bytes, of: int) -> float:
    return (len(text) - len(text.translate(None, chars))) / of if of else 0.0


def features(text: bytes) -> list[float]:
    """Shares and lengths of a text; saturated, so no outlier outweighs the others."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * (N_FEATURES - 1) + [1.0]
    size = sum(map(len, words))
    counts = Counter(words)
    grams = max(1, n - 2)
    lines = [x for x in text.split(b"\n") if x.strip()]
    letters = _share(text, _LETTERS, size)
    return [
        np.log1p(n) / 10,
        min(size / n, 20) / 10,
        _share(text, _SYMBOLS, size),
        min(1.0, 10 * _share(text, _SYMBOLS, size)),
        _share(text, _UPPER, size) / letters if letters else 0.0,
        letters,
        _share(text, _DIGITS, size),
        min(1.0, 10 * _share(text, _MARKS, size)),
        min(1.0, 10 * _share(text, _STOPS, size)),
        len(counts) / n,
        counts.most_common(1)[0][1] / n,
        1 - len(set(zip(words, words[1:], words[2:]))) / grams if n > 2 else 0.0,
        sum(map(eq, words, words[1:])) / n,
        len(set(lines)) / len(lines),
        min(1.0, 5 * len(lines) / n),
        1.0 / np.sqrt(n),
        0.0,
    ]


@dataclass(frozen=True)
class Ranker:
    weights: tuple[float, ...]
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    cut: float
    steepness: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        z = (x - np.array(self.mean)) / np.array(self.scale)
        return (z * np.array(self.weights)).sum(axis=1)  # row by row: equal texts score alike in any batch

    def score(self, x: np.ndarray) -> np.ndarray:
        """In (0, 1); THRESHOLD at the cut."""
        z = self.steepness * (self.raw(x) - self.cut) + np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


CONSTANT = Ranker((0.0,) * N_FEATURES, (0.0,) * N_FEATURES, (1.0,) * N_FEATURES, 0.0, 1.0)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(crc_mod(doc_id, HELD_OUT) == 0, F.lit(False))


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = [features(t.as_py()) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "x"])


def _matrix(values: pa.Array) -> np.ndarray:
    return values.flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES)


def _sums(df: DataFrame, measured: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """The sum of the vectors that ``measured`` makes of the rows of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            whole = np.rint(measured(batch) * FIXED).astype(np.int64).sum(axis=0)
            total = whole if total is None else total + whole
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.int64()))], names=["sums"])

    rows = df.mapInArrow(run, "sums array<long>").collect()  # one row per task
    return np.array([sum(column) / FIXED for column in zip(*[r["sums"] for r in rows])])


def _blocks(rows: DataFrame, counts: dict[int, int]) -> DataFrame:
    """One row per block: the features of its ``good`` and ``bad`` rows.

    Both labels are dealt out in turn; rows of a label that has fewer of them than
    there are blocks go to several, so each block holds both and each row is in one.
    """
    blocks = -(-sum(counts.values()) // BLOCK)
    dealt = places(rows.select("quality", F.xxhash64("doc_id").alias("h"), F.xxhash64("x").alias("hx"), "x"), ["quality"], ["h", "hx"], "ranked")
    turns = F.when(F.col("n") >= blocks, F.array(F.col("pos") % blocks)).otherwise(F.sequence(F.col("pos"), F.greatest("pos", F.lit(blocks - 1).cast("long")), F.col("n")))
    dealt = dealt.select("quality", "x", F.explode(turns).alias("block"))
    of = {name: F.sort_array(F.collect_list(F.when(F.col("quality") == q, F.col("x")))).alias(name) for name, q in (("good", 1), ("bad", 0))}
    return materialise(dealt.groupBy("block").agg(*of.values()).select("good", "bad"), "blocks")


def _slopes(weights: np.ndarray, mean: np.ndarray, scale: np.ndarray, batch: pa.RecordBatch) -> np.ndarray:
    """Per block: gradient and Hessian of the mean loss over its pairs, and 1."""
    out = []
    for k in range(batch.num_rows):
        good, bad = ((_matrix(batch.column(c)[k].values) - mean) / scale for c in ("good", "bad"))
        p = 1 / (1 + np.exp(np.clip((good @ weights)[:, None] - (bad @ weights)[None, :], -35, 35)))  # chance of the wrong order
        q, n = p * (1 - p), len(good) * len(bad)
        grad = p.sum(axis=0) @ bad - p.sum(axis=1) @ good
        cross = good.T @ (q @ bad)
        hess = (good * q.sum(axis=1)[:, None]).T @ good + (bad * q.sum(axis=0)[:, None]).T @ bad - cross - cross.T
        out.append(np.concatenate([grad, hess.ravel(), [n]]) / n)
    return np.array(out)


def _moments(center: np.ndarray, batch: pa.RecordBatch) -> np.ndarray:
    off = _matrix(batch.column("x")) - center
    return np.concatenate([off, off * off], axis=1)


def learn(rows: DataFrame, ridge: float = RIDGE, steps: int = STEPS) -> Ranker:
    """Bradley-Terry weights and the cut from all ``rows``: doc_id, quality (1 preferred, 0 rejected), x."""
    counts = {r["quality"]: r["count"] for r in rows.groupBy("quality").count().collect()}
    if len(counts) < 2:
        return CONSTANT
    n, d = sum(counts.values()), N_FEATURES
    x = rows.select("x")
    mean = _sums(x, partial(_moments, np.zeros(d)))[:d] / n
    scale = np.sqrt(_sums(x, partial(_moments, mean))[d:] / n)
    scale[scale < 1e-9] = 1.0
    blocks, w = _blocks(rows, counts), np.zeros(d)
    for _ in range(steps):
        sums = _sums(blocks, partial(_slopes, w, mean, scale))
        grad, hess = sums[:d] / sums[-1] + ridge * w, sums[d:-1].reshape(d, d) / sums[-1] + ridge * np.eye(d)
        step = np.linalg.solve(hess, grad)
        w -= step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-6:
            break
    linear = Ranker(tuple(w), tuple(mean), tuple(scale), 0.0, 1.0)

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(linear.raw(_matrix(batch.column("x"))))], names=["raw"])

    scores = materialise(x.mapInArrow(raw, "raw double"), "raw_scores")
    exact = [F.sum(c.cast("decimal(28,15)")).cast("double") for c in (F.col("raw"), F.col("raw") * F.col("raw"))]
    total, squares = scores.agg(*exact).first()
    spread = np.sqrt(max(0.0, squares / n - (total / n) ** 2))
    return Ranker(tuple(w), tuple(mean), tuple(scale), quantile(scores, counts[0], n), float(1 / max(1e-6, spread)) * 3)


def quantile(scores: DataFrame, below: int, n: int) -> float:
    """The exact quantile ``below`` / ``n`` of ``raw`` in ``scores`` (``n`` rows), interpolated as numpy does."""
    low = _value_at(scores, below - 1)
    upto, after = scores.agg(F.count(F.when(F.col("raw") <= low, 1)), F.min(F.when(F.col("raw") > low, F.col("raw")))).first()
    high = low if upto > below else after
    return low + (1 - below / n) * (high - low)


def _value_at(scores: DataFrame, rank: int) -> float:
    """The value with ``rank`` others before it, by counts in ever narrower bins."""
    while True:
        low, high, n = scores.agg(F.min("raw"), F.max("raw"), F.count("*")).first()
        if low == high:
            return low
        if n <= KEPT:
            return sorted(r["raw"] for r in scores.collect())[rank]
        at = F.least(F.floor((F.col("raw") - low) / (high - low) * BINS), F.lit(BINS - 1)).cast("int")
        for r in sorted(scores.groupBy(at.alias("bin")).count().collect()):  # at most BINS rows
            if rank < r["count"]:
                break
            rank -= r["count"]
        scores = scores.where(at == r["bin"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Ranker:
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("quality"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    texts = id_and_text(docs, id_col, text_col).where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    # features before the join: the texts do not cross a shuffle
    return learn(materialise(texts.mapInArrow(_feature_rows, "doc_id long, x array<double>").join(known, "doc_id"), "features"))


def scored(docs: DataFrame, ranker: Ranker, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = np.array([features(t.as_py()) for t in batch.column("text")]).reshape(-1, N_FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ranker.score(x))], names=["doc_id", "score"])

    rows = id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def accepted(docs: DataFrame, ranker: Ranker, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows it rejects, all columns as they came."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = np.array([features((t.as_py() or "").encode()) for t in batch.column(at)]).reshape(-1, N_FEATURES)
            yield batch.filter(pa.array(ranker.score(x) >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
