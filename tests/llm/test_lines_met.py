"""op9: rows that meet under a band key move once, whatever their number."""

import random
from collections import Counter

import pytest

from roadlens.llm import line_dedup as L

from .test_lines_whole import kept, large_bands, without_copies


@pytest.mark.parametrize("small, hot, buckets", [(512, 1024, 1 << 16), (3, 8, 4), (3, 50, 1)])
def test_keys_that_meet(spark, monkeypatch, small, hot, buckets):
    for name, value in (("SMALL", small), ("HOT_KEYS", hot), ("BUCKETS", buckets)):
        monkeypatch.setattr(L, name, value)
    r = random.Random(2)
    rows = [(r.choice((-7, 5, r.randrange(-400, 400))), k) for k in range(900)]
    n = Counter(key for key, _ in rows)
    met, total = L._met(spark.createDataFrame(rows, "key long, lid long"))
    want = sorted((key, lid, n[key]) for key, lid in rows if n[key] > 1)
    assert sorted(map(tuple, met.collect())) == want and total == len(want)
    assert L._met(spark.createDataFrame([], "key long, lid long"))[1] == 0


def test_hot_keys_in_whole(spark, monkeypatch):
    for name, value in (("SMALL", 4), ("FINE", 6), ("HOT_KEYS", 500), ("BUCKETS", 64)):
        monkeypatch.setattr(L, name, value)
    rows = large_bands()
    assert kept(spark.createDataFrame(rows, "doc_id long, text string")) == without_copies(rows)


def test_plan_does_not_change_with_the_number_of_keys(spark, monkeypatch):
    """Up to BROADCAST_ELEMENTS keys were broadcast, above it all rows were shuffled twice."""
    rows = [(k, " ".join(random.Random(k // 2).choices(["north", "valley", "river", "winter", "road", "snow"], k=30)) + f" {k}") for k in range(60)]
    plans = []
    for most in (0, 10**9):
        monkeypatch.setattr(L, "BROADCAST_ELEMENTS", most)
        made, write = [], L.materialise
        monkeypatch.setattr(L, "materialise", lambda df, name, *a, f=write, made=made, **b: made.append((name, df._jdf.queryExecution().optimizedPlan().toString().count("Join"))) or f(df, name, *a, **b))
        out = L.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))
        plans.append((made, [out._jdf.queryExecution().optimizedPlan().toString().count("strategy=broadcast")]))
        assert sorted(((x.doc_id, x.text) for x in out.collect()), key=str) == without_copies(rows)
        monkeypatch.setattr(L, "materialise", write)
    assert plans[0] == plans[1] and "met" in dict(plans[0][0])
