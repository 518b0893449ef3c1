"""The Merkle manifest against a plain version that builds whole trees in memory."""

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from roadlens.llm import merkle as M

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i:i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def climb(levels, at, value):
    """Siblings on the way up from place ``at`` and what ``value`` becomes at the top."""
    rest = ""
    for nodes in levels[:-1]:
        run = nodes[at // 16 * 16:at // 16 * 16 + 16]
        rest += "".join(run[:at % 16] + run[at % 16 + 1:])
        value = h("".join(run[:at % 16] + [value] + run[at % 16 + 1:]))
        at //= 16
    return rest, value


def plain(rows):
    groups = {}
    for r in rows:
        own = leaf(r, r["text"])
        bent = own
        if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["text"] is not None:
            bent = leaf(r, "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"]))
        groups.setdefault(r["source"], []).append((r["doc_id"], own, bent))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = tree([x[1] for x in groups[s]])
    top = tree([trees[s][-1][0] for s in names])
    out = []
    for n, s in enumerate(names):
        for at, (i, own, bent) in enumerate(groups[s]):
            inside, value = climb(trees[s], at, bent)
            outside, value = climb(top, n, value)
            out.append((i, own, trees[s][-1][0], top[-1][0], h(inside + outside), value, value == top[-1][0]))
    return out


def order(row):
    return tuple((x is None, str(x)) for x in row)


def check(df, levels=M.LEVELS):
    got = [tuple(r) for r in M.manifest(df, levels=levels).collect()]
    want = plain([r.asDict() for r in df.select(*FIELDS).collect()])
    assert sorted(got, key=order) == sorted(want, key=order)
    return got


def test_odd_rows_and_clashing_columns(odd):
    check(odd.withColumns({c: F.lit(1) for c in ("grp", "pos", "block", "digest", "bent", "leaf", "_row", "_part", "others")}))


def test_empty_and_single(odd, empty):
    assert M.manifest(empty).count() == 0
    [row] = check(odd.where("doc_id = 6"))
    assert row[1] == row[2] == row[3] and row[4] == h("")  # a lone leaf is subroot and root


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_hot_source_over_many_superblocks(spark, levels):
    """A source with most rows; with small superblocks its tree takes several tiers."""
    rows = spark.range(5000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 40)).alias("source"),
        F.lit("en").alias("lang"), (F.col("id") * 3).alias("n_chars"), F.concat(F.lit("Text No "), F.col("id").cast("string")).alias("text"))
    got = check(rows, levels)
    assert {r[-1] for r in got} == {True, False}


def test_tampering_shows_in_a_few_rows_alone(small):
    got = check(small)
    bent = [r for r in got if not r[-1]]
    assert bent and all(zlib.crc32(str(r[0]).encode()) % 5 == 0 for r in bent)
