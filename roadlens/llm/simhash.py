"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints: 64 bits over word shingles; bit b is set when more than half of
the shingle hashes have it.  Linking: fingerprints at most RADIUS bits apart.
Equal fingerprints collapse first.  With RADIUS 2 and four 16-bit blocks two
blocks agree, so six tables of 32-bit keys hold every pair in a common bucket.
A bucket above BUCKET fingerprints is cut again by the same argument inside
the bits it does not fix (8-bit blocks, then 4-bit ones), which ends in
buckets of at most 256 values: every pair is still compared, no bucket is
capped, and no key with many rows is ever grouped.

In a bucket the fingerprints are stored as vertical bit planes; the distances
of one fingerprint to 64 others advance together in bitwise carry-save
counters, and a block stops once all counters exceed the radius.  Of a bucket
come star edges (member, smallest linked member), never all pairs; connected
components join them.

Defined results: null text counts as empty; a text without words has
fingerprint zero and links like any other; component_id ignores null doc_ids
unless a component has no other; repeated rows give repeated result rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import components, first_of_each, join_counted, slices, unused
from .exact_dedup import row_key

SHINGLE = 3
RADIUS = 2
BUCKET = 1024
_PIECE = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a text (A-Z lower-cased, split at ASCII white space)."""
    words = text.lower().split()  # bytes: only ASCII letters and blanks are touched
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, _PIECE):  # pieces bound the memory of a very long text
        part = words[at:min(at + _PIECE, n) + shingle - 1]
        hashes = np.fromiter(
            (digest(s, 42) for s in map(b" ".join, zip(*(part[i:] for i in range(shingle))))) if len(words) >= shingle
            else (digest(b" ".join(words), 42),),
            dtype=np.uint64,
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, mark: Column | None = None) -> DataFrame:
    """(doc_id, mark, fp) per row; fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column("text")], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("mark"), pa.array(fps.view(np.int64))], names=["doc_id", "mark", "fp"])

    source = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
        (F.lit(None) if mark is None else mark).cast("string").alias("mark"),
    )
    return source.mapInArrow(run, "doc_id long, mark string, fp long")


def near(fps: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Which of the (unsigned 64-bit) fingerprints are within ``radius`` bits:
    a square boolean matrix, by vertical planes and carry-save counters."""
    m = len(fps)
    width = -(-m // 64)
    padded = np.concatenate([fps, np.repeat(fps[:1], width * 64 - m)])
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    planes = np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(np.uint64)  # 64 planes of `width` words
    n_counters = max(1, radius.bit_length())
    counters = [np.zeros((m, width), dtype=np.uint64) for _ in range(n_counters)]
    over = np.zeros((m, width), dtype=np.uint64)
    live = np.arange(m)  # rows whose blocks have not all exceeded the radius
    exceeded = np.full((m, width), np.uint64(0xFFFFFFFFFFFFFFFF))
    own = (np.uint64(1) << (np.arange(m, dtype=np.uint64) % np.uint64(64)))
    for b in range(64):
        flip = np.where(bits[live, b] == 1, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))
        carry = planes[b][None, :] ^ flip[:, None]  # a set bit: this plane differs
        for c in counters:  # carry-save step of all counters at once
            c_and = c & carry
            c ^= carry
            carry = c_and
        over |= carry
        if b % 8 == 7:
            high = over | _above(counters, radius)
            rest = ~high
            rest[np.arange(len(live)), live // 64] &= ~own[live]  # a fingerprint always equals itself
            going = rest.any(axis=1)
            if not going.all():
                live = live[going]
                over, counters = over[going], [c[going] for c in counters]
                if not len(live):
                    break
    exceeded[live] = over | _above(counters, radius)
    linked = np.unpackbits(np.ascontiguousarray(~exceeded).view(np.uint8).reshape(m, -1), axis=1, bitorder="little")[:, :m].astype(bool)
    linked[np.arange(m), np.arange(m)] = True
    return linked


def _above(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Bit mask of the counters whose value exceeds ``radius``."""
    greater = np.zeros_like(counters[0])
    equal = ~greater
    for k in range(len(counters) - 1, -1, -1):
        if radius >> k & 1:
            equal = equal & counters[k]
        else:
            greater |= equal & counters[k]
            equal = equal & ~counters[k]
    return greater


def star_edges(fps: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """(member, smallest linked member) for the links among ``fps`` (signed longs)."""
    order = np.unique(fps)
    linked = near(order.view(np.uint64), radius)
    todo, a, b = np.ones(len(order), dtype=bool), [], []
    for i in range(len(order)):
        if not todo[i]:
            continue
        todo[i] = False
        front = np.array([i])
        while len(front):
            reached = np.flatnonzero(linked[front].any(axis=0) & todo)
            todo[reached] = False
            a.append(order[reached])
            b.append(np.full(len(reached), order[i]))
            front = reached
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def _choices(free: Column, free_bits: int, n_blocks: int, radius: int) -> Column:
    """Array of (table, fixed bits, free bits): any `radius` differing bits leave
    n_blocks - radius blocks equal, so each choice of that many blocks is a table."""
    width = free_bits // n_blocks
    block = [F.shiftrightunsigned(free, i * width).bitwiseAND(F.lit((1 << width) - 1)) for i in range(n_blocks)]

    def packed(which):
        out = F.lit(0).cast("long")
        for i in which:
            out = F.shiftleft(out, width).bitwiseOR(block[i])
        return out

    return F.array(*[
        F.struct(F.lit(t).cast("long").alias("t"), packed(fixed).alias("key"), packed([i for i in range(n_blocks) if i not in fixed]).alias("free"))
        for t, fixed in enumerate(combinations(range(n_blocks), n_blocks - radius))
    ])


def links(distinct_fps: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Star edges (a, b) that connect all fingerprints at most ``radius`` (2) bits apart.

    ``distinct_fps``: column fp, each value once.
    """
    if radius != 2 or bucket < 256:
        raise ValueError("the tables are laid out for radius 2 and buckets of 256 or more")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held):
            a, b = star_edges(np.concatenate(held), radius)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        held, n = [], 0
        for batch in batches:
            for fps in batch.column("fps"):
                part = fps.values.to_numpy(zero_copy_only=False)
                if held and n + len(part) > bucket:
                    yield out(held)
                    held, n = [], 0
                held.append(part)  # small buckets share a block: a link across them is a link
                n += len(part)
        if held:
            yield out(held)

    level = distinct_fps.select(F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"), F.col("fp").alias("free"), "fp")
    edges, free_bits = None, 64
    for depth in range(3):
        half = free_bits // 2
        step = F.explode(_choices(F.col("free"), free_bits, 4, radius)).alias("c")
        wide = level.select("k1", "k2", "fp", step)
        shift = 35 if depth == 0 else half + 3
        key = F.shiftleft(F.col("c.t"), half).bitwiseOR(F.col("c.key"))
        keyed = wide.select(
            (key if depth == 0 else F.col("k1")).alias("k1"),
            (F.lit(0).cast("long") if depth == 0 else F.shiftleft(F.col("k2"), shift).bitwiseOR(key)).alias("k2"),
            F.col("c.free").alias("free"), "fp",
        )
        counts = materialise(keyed.groupBy("k1", "k2").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
        sizes = counts.agg(F.sum("n").alias("total"), F.max("n").alias("most")).first()
        if not sizes["total"]:
            break
        members = join_counted(keyed, counts, ["k1", "k2"], "n", sizes["total"])
        found = (
            members.where(F.col("n") <= bucket).groupBy("k1", "k2").agg(F.collect_list("fp").alias("fps"))
            .select("fps").mapInArrow(compare, "a long, b long")
        )
        found = materialise(found.distinct(), "links")
        edges = found if edges is None else edges.unionByName(found)
        if sizes["most"] <= bucket:
            break
        level = materialise(members.where(F.col("n") > bucket).select("k1", "k2", "free", "fp"), "large")
        free_bits = half
    if edges is None:
        return distinct_fps.sparkSession.createDataFrame([], "a long, b long")
    return edges


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, bucket: int = BUCKET, mark: Column | None = None) -> DataFrame:
    """One row per input row: doc_id, mark, fp (signed long), fingerprint (hex), component_id, root
    (smallest fingerprint of the component)."""
    rows = materialise(fingerprints(docs, id_col, text_col, shingle, mark), "simhash")
    distinct = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")), "distinct")
    roots = materialise(components(links(distinct.select("fp"), radius, bucket)), "roots").withColumnRenamed("node", "fp")
    placed = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    placed = materialise(placed, "placed")
    sizes = placed.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count("*").alias("fps"))
    n_fps, n_rows = placed.agg(F.count("*"), F.sum("n")).first()
    labelled = materialise(join_counted(placed, materialise(sizes, "components"), ["root"], "fps", n_fps or 0).select("fp", "n", "root", "component_id"), "labelled")
    return join_counted(rows, labelled, ["fp"], "n", n_rows or 0).select(
        "doc_id", "mark", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "root")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each component, all columns as they came.

    The row with the smallest doc_id stays; of rows that share it, the one
    with the smallest digest.  A component of null doc_ids keeps one row too.
    """
    (mark,) = unused(docs, "__near_key")
    key = row_key(F.col(id_col), F.col(text_col))
    rows = simhash_components(docs, id_col, text_col, shingle, radius, mark=key)
    first = rows.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    keep = materialise(first.groupBy("root").agg(F.min("mark").alias(mark), F.count("*").alias("n")), "near_kept")
    found = docs.withColumn(mark, key).join(keep.select(mark), mark, "left_semi")
    if keep.where("n > 1").limit(1).count():  # a doc_id repeats: rows of equal text may too
        found = first_of_each(found, mark)
    return found.drop(mark)
