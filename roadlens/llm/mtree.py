"""Exact top-k inner-product search in a paged M-tree.

The tree has four levels.  At the top stand at most PIVOTS routing objects, a
documented bounded sample, with the covering radius of all vectors assigned to
each.  The vectors of a routing object are cut, in order of their distance to it,
into pages of at most PAGE vectors: rows of one table, each with its own routing
object, covering radius and distance to the parent.  Inside a page stand leaves
of at most LEAF vectors, again with routing object, radius and parent distance,
and every vector has its distance to the routing object of its leaf.

The metric is Euclidean.  For a query q, a routing object c and a vector v the
triangle inequality gives ``|q.v - q.c| <= |q| d(v, c)``, so a ball of radius r
around c holds no score above ``q.c + |q| r``, and a child at distance p from its
parent o none above ``q.o + |q| (p + r)``: that bound needs no product with the
child.  A query first searches the page it is promised most, which gives it a
threshold; then every page whose bound reaches the threshold, by blocks of
queries.  Inside a page each query visits its leaves best bound first and stops
when the next bound is below its k-th score; in a leaf only vectors whose own
bound reaches that score are multiplied (a prefix, since they stand in order of
their distance).  Nothing that could enter a result is left out: the search is
exact, whatever the data; where bounds tell little it reads every page.

Scores are exact integers: a page is multiplied in doubles when norms prove that
no sum leaves 2^53, else in integers of any size.

Defined results: vectors that are null or hold null or non-finite components take
no part; shorter vectors count as padded with zeros, an empty one is the zero
vector; a null id is never a query and comes after all other ids of its score;
rows that repeat an id are rows of their own, as queries and as candidates; a
query without other rows has no result.  Components are clipped to +-2^62 and
scores to what a long holds.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .common import places

PIVOTS = 256        # routing objects at the top, at most (a sample of as many vectors)
PAGE = 8_192        # vectors of a page
LEAF = 512          # vectors of a leaf
QUERIES = 2_048     # queries of a block
SCALE = 64
_LAST_ID = np.iinfo(np.int64).max
_EXACT = float(1 << 53)


# ---- vectors -------------------------------------------------------------------


def scaled(values: np.ndarray, scale: int = SCALE) -> np.ndarray | None:
    """floor(scale * x) of each component, None if some component is not finite."""
    x = np.floor(values.astype(np.float64) * scale)
    if not np.isfinite(x).all():
        return None
    return np.clip(x, -(2.0**62), 2.0**62).astype(np.int64)


def packed(vector: np.ndarray) -> bytes:
    """Little-endian integers, of two bytes where that holds every component, else of eight."""
    short = vector.astype("<i2")
    return b"\x02" + short.tobytes() if (short == vector).all() else b"\x08" + vector.astype("<i8").tobytes()


def unpacked(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, dtype=f"<i{blob[0]}", offset=1).astype(np.int64)


def matrix(blobs) -> np.ndarray:
    """Vectors as rows, padded with zeros to the longest."""
    rows = [unpacked(b) for b in blobs]
    out = np.zeros((len(rows), max(map(len, rows), default=0)), dtype=np.int64)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both padded with zero columns to the wider one."""
    w = max(a.shape[1], b.shape[1])
    return tuple(x if x.shape[1] == w else np.pad(x, ((0, 0), (0, w - x.shape[1]))) for x in (a, b))


def norms(v: np.ndarray) -> np.ndarray:
    return np.sqrt((v.astype(np.float64) ** 2).sum(axis=1))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of ``a`` with all rows of ``b``: exact integers, as float64
    where norms prove them below 2^53, else as Python integers clipped to a long."""
    if len(a) == 0 or len(b) == 0 or a.shape[1] == 0:
        return np.zeros((len(a), len(b)))
    if norms(a).max() * norms(b).max() < _EXACT / 2:
        return a.astype(np.float64) @ b.astype(np.float64).T
    return np.clip(a.astype(object) @ b.astype(object).T, -(2**63), 2**63 - 1)


def ceiling(score: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """``score + spread`` as a float that no exact value below it exceeds."""
    score = score.astype(np.float64)
    return score + spread + (np.abs(score) + spread) * 1e-12 + 1e-6


def distances(v: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Distances to one vector, rounded up."""
    v, c = same_width(v, centre.reshape(1, -1))
    return norms(v.astype(np.float64) - c.astype(np.float64)) * (1 + 1e-12) + 1e-9


def vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(uid, vec_id, v) of the rows that take part, written to the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("v")
            starts, flat = column.offsets.to_numpy(), column.values
            held, known = np.asarray(column.is_valid()), np.asarray(flat.is_valid())
            numbers = flat.cast(pa.float64()).fill_null(0).to_numpy(zero_copy_only=False)
            keep, out = [], []
            for i in np.flatnonzero(held):
                a, b = starts[i], starts[i + 1]
                if known[a:b].all() and (v := scaled(numbers[a:b], scale)) is not None:
                    keep.append(i)
                    out.append(packed(v))
            take = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("uid").take(take), batch.column("vec_id").take(take), pa.array(out, pa.binary())],
                                             names=["uid", "vec_id", "v"])

    source = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"),
                         F.monotonically_increasing_id().alias("uid"))
    return materialise(source.select("uid", "vec_id", "v").mapInArrow(run, "uid long, vec_id long, v binary"), "vectors")


# ---- pages ---------------------------------------------------------------------


def sampled_pivots(rows: DataFrame, n: int, pivots: int = PIVOTS, page: int = PAGE) -> np.ndarray:
    """At most ``pivots`` different vectors of four times as many rows, first by a hash: routing objects of the top."""
    wanted = max(1, min(pivots, -(-n // page)))
    rows = rows.orderBy(F.xxhash64("uid"), "uid").limit(4 * wanted).select("v").collect()
    return matrix(list(dict.fromkeys(bytes(r["v"]) for r in rows))[:wanted])


def assigned(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(pivot, dist, uid, vec_id, v): each vector with its nearest routing object of the top."""
    wide = pivots.astype(np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                piece = batch.slice(at, 4096)
                v, p = same_width(matrix(piece.column("v").to_pylist()).astype(np.float64), wide)
                near = ((p**2).sum(axis=1)[None, :] - 2 * (v @ p.T)).argmin(axis=1)
                dist = norms(v - p[near]) * (1 + 1e-12) + 1e-9
                yield pa.RecordBatch.from_arrays(
                    [pa.array(near.astype(np.int32)), pa.array(dist), piece.column("uid"), piece.column("vec_id"), piece.column("v")],
                    names=["pivot", "dist", "uid", "vec_id", "v"])

    return materialise(rows.mapInArrow(run, "pivot int, dist double, uid long, vec_id long, v binary"), "assigned")


def leaf_of(v: np.ndarray, size: int = LEAF) -> np.ndarray:
    """Leaf number of each vector of a page: vectors are split in halves, each half nearer to
    one of two far objects, until no part is larger than ``size``; equal ones by their place."""
    out, todo, n = np.zeros(len(v), dtype=np.int64), [np.arange(len(v))], 0
    f = v.astype(np.float64)
    while todo:
        part = todo.pop()
        if len(part) <= size:
            out[part], n = n, n + 1
            continue
        x = f[part]
        a = x[norms(x - x[0]).argmax()]
        b = x[norms(x - a).argmax()]
        order = np.argsort(x @ (b - a), kind="stable")
        todo += [part[order[len(part) // 2:]], part[order[:len(part) // 2]]]
    return out


def built(rows: DataFrame, page: int = PAGE, leaf: int = LEAF) -> DataFrame:
    """The vectors with their place in the tree: (pivot, page, leaf, route, dist, radius, parent,
    uid, vec_id, v).  ``route`` marks the routing object of a leaf and ``dist`` is the distance
    to it; ``radius`` and ``parent`` are those of the leaf (``parent``: to the page's object)."""
    ranked = places(rows, ["pivot"], ["dist", "uid"], "by_distance").withColumn("page", F.floor(F.col("pos") / page))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos", ignore_index=True)
        v = matrix(rows["v"])
        part = leaf_of(v, leaf)
        top = v[int(norms(v.astype(np.float64) - v.astype(np.float64).mean(axis=0)).argmin())]  # nearest to the middle
        out = rows[["pivot", "page", "uid", "id", "v"]].assign(leaf=part, route=False, dist=0.0, radius=0.0, parent=0.0)
        for k in range(part.max() + 1):
            at = np.flatnonzero(part == k)
            x = v[at]
            c = int(norms(x.astype(np.float64) - x.astype(np.float64).mean(axis=0)).argmin())
            d = distances(x, x[c])
            out.loc[at, "dist"], out.loc[at, "radius"] = d, d.max()
            out.loc[at, "parent"] = distances(x[c:c + 1], top)[0]
            out.loc[at[c], "route"] = True
        out["centre"] = None
        out.at[0, "centre"] = packed(top)
        out["outer"] = rows["dist"].max()
        return out

    schema = ("pivot int, page long, leaf long, route boolean, dist double, radius double, parent double, "
              "uid long, id string, v binary, centre binary, outer double")
    narrow = ranked.select("pivot", "page", "pos", "dist", "uid", F.col("vec_id").cast("string").alias("id"), "v")
    return materialise(narrow.groupBy("pivot", "page").applyInPandas(run, schema), "pages")


# ---- search --------------------------------------------------------------------


class Page:
    """A page in memory: leaves with their routing objects, vectors in order of falling distance."""

    def __init__(self, rows: pd.DataFrame):
        rows = rows.sort_values(["leaf", "dist", "uid"], ascending=[True, False, True], ignore_index=True)
        self.v = matrix(rows["v"])
        self.uid = rows["uid"].to_numpy()
        self.ids = np.array([_LAST_ID if i is None or i != i else int(i) for i in rows["id"]], dtype=np.int64)
        self.named = rows["id"].notna().to_numpy()
        self.dist = rows["dist"].to_numpy()
        leaves = rows["leaf"].to_numpy()
        self.starts = np.flatnonzero(np.r_[True, leaves[1:] != leaves[:-1]])
        self.ends = np.r_[self.starts[1:], len(rows)]
        self.routes = np.flatnonzero(rows["route"].to_numpy())
        self.radius = rows["radius"].to_numpy()[self.starts]
        self.parent = rows["parent"].to_numpy()[self.starts]
        self.centre = matrix([rows["centre"].dropna().iloc[0]])


def search(page: Page, q: np.ndarray, uid: np.ndarray, floor: np.ndarray, k: int) -> list[tuple]:
    """(query row, score, id, uid) of every query's best k of the page that reach its ``floor``.

    All queries advance together: each step takes the best leaf left of every
    query, groups the queries by leaf and multiplies once per leaf.
    """
    q, v = same_width(q, page.v)
    centre = np.pad(page.centre, ((0, 0), (0, v.shape[1] - page.centre.shape[1])))
    size = norms(q)
    # bounds by the stored parent distance; only where they reach the floor is a product with the leaf's object made
    bound = ceiling(products(q, centre), size[:, None] * (page.parent + page.radius)[None, :])
    for leaf in range(len(page.starts)):
        live = np.flatnonzero(bound[:, leaf] >= floor)
        if len(live):
            exact = products(q[live], v[page.routes[leaf]:page.routes[leaf] + 1])[:, 0]
            bound[live, leaf] = np.minimum(bound[live, leaf], ceiling(exact, size[live] * page.radius[leaf]))
    order = np.argsort(-bound, axis=1, kind="stable")
    best: list[list[tuple]] = [[] for _ in q]
    floor = floor.astype(np.float64).copy()
    active = np.arange(len(q))
    for step in range(order.shape[1]):
        mine = order[active, step]
        go = bound[active, mine] >= floor[active]
        active, mine = active[go], mine[go]
        if not len(active):
            break
        for leaf in np.unique(mine):
            who = active[mine == leaf]
            a, b = page.starts[leaf], page.ends[leaf]
            # vectors of the leaf whose own distance to its object can reach a floor: a prefix
            centre_score = products(q[who], v[page.routes[leaf]:page.routes[leaf] + 1])[:, 0].astype(np.float64)
            gap = floor[who] - ceiling(centre_score, np.abs(floor[who]) * 1e-12)
            need = (gap / np.maximum(size[who], 1e-300)).min() - 1e-6
            b = a + int(np.searchsorted(-page.dist[a:b], -need, side="right"))
            if b == a:
                continue
            scores = products(q[who], v[a:b])
            for row, one in zip(who, scores):
                at = np.flatnonzero(one >= floor[row])
                if len(at) > 4 * k:  # the k + 1 best (one may be the query's own row), ties to the smaller id
                    if one.dtype != object:
                        at = at[one[at] >= np.partition(one[at], len(at) - k - 1)[len(at) - k - 1]]
                    at = at[np.lexsort((page.uid[a + at], page.ids[a + at], -one[at]))[:k + 1]]
                found = best[row]
                found += [(-int(one[j]), int(page.ids[a + j]), int(page.uid[a + j]), bool(page.named[a + j])) for j in at if page.uid[a + j] != uid[row]]
                if len(found) >= k:
                    found.sort()
                    del found[k:]
                    least = -found[-1][0]
                    floor[row] = max(floor[row], least if abs(least) < _EXACT else np.nextafter(float(least), -np.inf))
    return [(row, -s, i if named else None, u) for row, found in enumerate(best) for s, i, u, named in sorted(found)[:k]]


def searched(pages: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(q_uid, score, id, uid): the hits of every (page, query) of ``asked`` (pivot, page, block, q_uid, q, floor)."""

    def run(key, rows: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        names = ["q_uid", "score", "id", "uid"]
        if rows.empty or asks.empty:
            return pd.DataFrame([], columns=names)
        uid = asks["q_uid"].to_numpy()
        hits = search(Page(rows), matrix(asks["q"]), uid, asks["floor"].to_numpy(dtype=np.float64), k)
        return pd.DataFrame([(uid[row], s, None if i is None else str(i), u) for row, s, i, u in hits], columns=names)

    # a page goes once to every block of queries that asks for it
    wanted = asked.select("pivot", "page", F.col("block").alias("for_block")).distinct()
    sent = pages.join(wanted, ["pivot", "page"])
    return sent.groupBy("pivot", "page", "for_block").cogroup(asked.groupBy("pivot", "page", "block")).applyInPandas(run, "q_uid long, score long, id string, uid long")


def best_k(hits: DataFrame, k: int) -> DataFrame:
    """The k best hits of each query (Spark cuts each task's rows to k per query before the shuffle)."""
    order = Window.partitionBy("q_uid").orderBy(F.desc("score"), F.asc_nulls_last(F.col("id").cast("long")), "uid")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(rows: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE,
          pivots: int = PIVOTS, page: int = PAGE, leaf: int = LEAF, block: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best of all other rows for each row whose id ``every`` divides."""
    source = vectors(rows, id_col, vector_col, scale)
    n = source.count()
    tops = sampled_pivots(source, n, pivots, page)
    tree = built(assigned(source, tops), page, leaf)
    directory = materialise(tree.groupBy("pivot", "page").agg(F.max("outer").alias("outer")), "directory")
    spans = {r["pivot"]: r["outer"] for r in directory.groupBy("pivot").agg(F.max("outer").alias("outer")).collect()}  # one row per top object
    covering = np.array([spans.get(i, -np.inf) for i in range(len(tops))])

    def asks(batches: Iterator[pa.RecordBatch], first: bool) -> Iterator[pa.RecordBatch]:
        """Routing objects of the top that can still hold a hit of a query (``first``: the most promising one)."""
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                piece = batch.slice(at, 1024)
                q = matrix(piece.column("q").to_pylist())
                wide, p = same_width(q, tops)
                reach, size = products(wide, p).astype(np.float64), norms(wide)
                bound = np.where(covering[None, :] < 0, -np.inf, ceiling(reach, size[:, None] * np.maximum(covering, 0)[None, :]))
                if first:
                    who, where = np.arange(len(q)), np.where(covering[None, :] < 0, -np.inf, reach).argmax(axis=1)
                else:
                    who, where = np.nonzero(bound >= piece.column("floor").to_numpy()[:, None])
                take = pa.array(who)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(c).take(take) for c in ("q_uid", "q", "floor")] + [pa.array(where.astype(np.int32)), pa.array(reach[who, where]), pa.array(size[who])],
                    names=["q_uid", "q", "floor", "pivot", "reach", "size"])

    schema = "q_uid long, q binary, floor double, pivot int, reach double, size double"
    queries = source.where(F.col("vec_id") % every == 0).select(F.col("uid").alias("q_uid"), F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    n_queries = queries.count()
    blocks = max(1, -(-n_queries // block))
    in_block = F.pmod(F.xxhash64("q_uid"), F.lit(blocks)).alias("block")
    low = float(-(2**63))
    start = queries.select("q_uid", "q", F.lit(low).alias("floor"))
    first = materialise(start.mapInArrow(lambda b: asks(b, True), schema).select(
        "pivot", F.lit(0).cast("long").alias("page"), in_block, "q_uid", "q", "floor"), "first_pages")
    hits = materialise(searched(tree, first, k), "first_hits")
    floors = hits.groupBy("q_uid").agg(F.min("score").alias("least"), F.count("*").alias("found")).where(F.col("found") >= k)
    known = queries.join(floors, "q_uid", "left").select("q_uid", "q", F.coalesce(F.col("least").cast("double"), F.lit(low)).alias("floor"))
    second = known.mapInArrow(lambda b: asks(b, False), schema)
    # a page is at most ``outer`` from its parent: its bound needs no product with its own object
    spread = F.col("size") * F.col("outer")
    ceiled = F.col("reach") + spread + (F.abs("reach") + spread) * 1e-12 + 1e-6
    reaching = second.join(directory, "pivot").where(ceiled >= F.col("floor")).join(
        first.select("q_uid", "pivot", "page"), ["q_uid", "pivot", "page"], "left_anti")
    asked = materialise(reaching.select("pivot", "page", in_block, "q_uid", "q", "floor"), "pages_to_search")
    hits = hits.unionByName(materialise(searched(tree, asked, k), "hits"))
    return best_k(hits, k).join(queries.select("q_uid", "query_id"), "q_uid").select(
        "query_id", "rank", F.col("id").cast("long").alias("vec_id"), "score")


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""
