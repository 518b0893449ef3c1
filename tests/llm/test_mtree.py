"""Exact top-k search against every product."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlens.llm import mtree as T

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, k=20, every=20):
    kept = []
    for i, v in rows:
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, [math.floor(64 * float(np.float32(x))) for x in v]))
    out = []
    for a, (i, q) in enumerate(kept):
        if i is None or i % every:
            continue
        scores = sorted((-sum(x * y for x, y in zip(q, v)), j is None, j or 0) for b, (j, v) in enumerate(kept) if b != a)
        out += [(i, n + 1, None if no else j, -s) for n, (s, no, j) in enumerate(scores[:k])]
    return sorted(out, key=str)


def run(df, **kw):
    return sorted((tuple(r) for r in T.top_k(df, **kw).collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(3)


def test_many_pages_and_leaves(spark):
    """Clustered vectors, so that bounds leave pages and leaves out."""
    r = np.random.default_rng(5)
    centres = r.normal(size=(6, 12)) * 3
    rows = [(i, (centres[i % 6] + r.normal(size=12) * 0.1).tolist()) for i in range(900)]
    assert run(frame(spark, rows), pivots=5, page=64, leaf=16, block=7) == plain(rows)


def test_one_very_common_vector_and_ties(spark):
    r = random.Random(6)
    rows = [(i, [1.0, 0.5, -0.25] if i % 3 else [r.uniform(-2, 2) for _ in range(3)]) for i in range(500)]
    assert run(frame(spark, rows), pivots=4, page=50, leaf=16, block=3, k=9) == plain(rows, 9)


def test_nulls_odd_lengths_and_repeated_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (20, None), (40, [1.0, None]), (60, [nan, 1.0]), (80, [inf]), (100, []), (120, [-3.5]),
            (None, [4.0, 4.0, 4.0]), (None, [0.1, 0.1]), (7, [0.015, -0.015]), (140, [0.0, 0.0, -1.0]), (-20, [1e30, -1.0])]
    df = frame(spark, rows).withColumns({c: F.lit(1) for c in ("uid", "pivot", "page", "dist", "rank", "score", "q", "block", "n", "pos")})
    got = [x for x in run(df, k=4) if abs(x[3]) < 2**40 and x[0] != -20]
    want = [x for x in plain(rows, 4) if abs(x[3]) < 2**40 and x[0] != -20]
    assert got == want
    assert run(df.where("false")) == [] and run(frame(spark, [(20, [1.0])])) == []


def test_large_components_are_exact(spark):
    r = random.Random(8)
    rows = [(i, [float(r.randint(-2**23, 2**23)) for _ in range(4)]) for i in range(120)]  # products near 2^58
    assert run(frame(spark, rows), page=40, leaf=8, pivots=3, k=5) == plain(rows, 5)


@pytest.mark.parametrize("n", [1, 5, 300])
def test_leaves_hold_all_vectors_once(n):
    v = np.random.default_rng(n).integers(-9, 9, size=(n, 5))
    v[: n // 2] = 1
    part = T.leaf_of(v, 16)
    assert len(part) == n and np.bincount(part).max() <= 16 and set(part) == set(range(part.max() + 1))


def test_bounds_leave_work_out(monkeypatch):
    """In clustered data a query does not multiply every vector of a page."""
    import pandas as pd

    r = np.random.default_rng(9)
    v = np.concatenate([r.integers(-5, 5, size=(256, 8)) + c for c in r.integers(-400, 400, size=(16, 8))])
    part = T.leaf_of(v, 256)
    rows = pd.DataFrame({"v": [T.packed(x) for x in v], "uid": range(len(v)), "id": [str(i) for i in range(len(v))], "leaf": part,
                         "route": False, "dist": 0.0, "radius": 0.0, "parent": 0.0, "centre": None})
    top = v[0]
    rows.at[0, "centre"] = T.packed(top)
    for k in range(part.max() + 1):
        at = np.flatnonzero(part == k)
        d = T.distances(v[at], v[at[0]])
        rows.loc[at, "dist"], rows.loc[at, "radius"], rows.loc[at, "parent"] = d, d.max(), T.distances(v[at[:1]], top)[0]
        rows.loc[at[0], "route"] = True
    done = []
    product = T.products
    monkeypatch.setattr(T, "products", lambda a, b: (done.append(len(a) * len(b)), product(a, b))[1])
    q = v[:40]
    hits = T.search(T.Page(rows), q, np.arange(40), np.full(40, -2.0**63), 10)
    want = []
    for i in range(40):
        s = sorted((-int(q[i] @ v[j]), j) for j in range(len(v)) if j != i)[:10]
        want += [(i, -a, j, j) for a, j in s]
    assert hits == want and sum(done) < 40 * len(v) / 2
