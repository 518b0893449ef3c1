"""Fuzzy line deduplication by MinHash.

A line (white space collapsed) is the set of its SPAN-character shingles from
each character position, so every character of every word counts; a line
shorter than that is one shingle.  Equal lines collapse first, by a 128-bit
hash.  The signature is one-permutation MinHash: BINS ranges of the shingle
hashes, each with its smallest hash (an empty range takes that of the next),
and every KEYS-th range in a band of four, KEYS bands.  Candidates are verified
by the exact Jaccard similarity of their shingle sets, components come from
distributed contraction (``common.components``), and each component keeps its
first line: smallest doc_id, then smallest line number.

Splitting, signatures and the comparison run in numpy over Arrow batches; all
meeting, counting, joining and contraction is DataFrame work.  (As DataFrame
functions alone the signatures and comparisons cost over three times the CPU
budget; see the README.)

No group is expanded into all pairs of rows.  Up to SMALL lines of a band are
compared inside one row, of which only (line, component) rows come.  A larger
band is dealt into blocks, and each two blocks (FINE lines) are compared inside
one row, so every two lines that share a band are compared, whatever its size.
At similarity 0.8 a pair shares a band with probability above 0.999.  A task
holds one slice of documents, or the lines of one row's band, at a time.

Every line that is not blank takes part.  Defined results: null
text counts as empty; blank lines always stay; rows that repeat doc_id
and text are treated as one document, and rows that repeat a doc_id with other
text as versions of it (a line first seen there stays in each); a null doc_id
sorts last; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise, shuffles_dropped
from .common import HOT_KEYS, components, join_counted, slices

SPAN = 9  # characters of a shingle
BINS, KEYS = 64, 16
SMALL = 512
FINE = 2048  # lines in two blocks of a larger band
BUCKETS = 1 << 16  # in which band keys are counted to find the hot ones
CHARS = 1 << 19  # characters whose shingles are hashed at a time (a longer line stands alone)
CELLS = 1 << 24  # of a matrix of lines by shingles
#: Elements of about 20 bytes up to which a measured table is broadcast; above, the join shuffles.
BROADCAST_ELEMENTS = 500_000

_CONTROL = re.compile(r"[\t\x0b\x0c\r]")
_SPACES = dict.fromkeys((9, 11, 12, 13), " ")
_BASE = 0x9E3779B97F4A7C15
_POWERS = [np.uint64(pow(_BASE, k, 1 << 64)) for k in (1, 2, 4, 8)]
_MIX = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


# ------------------------------------------------------------- lines and their shingles


def collapsed(text: str) -> str:
    """``text`` with each run of ASCII white space but line feeds as one space."""
    if _CONTROL.search(text):
        text = text.translate(_SPACES)
    while "  " in text:
        text = text.replace("  ", " ")
    return text


def lines_of(text: str) -> list[str]:
    return [x.strip(" ") for x in collapsed(text).split("\n")]


def line_ids(lines: list[str]) -> np.ndarray:
    """Two 64-bit hashes of each line."""
    return np.frombuffer(b"".join(xxhash.xxh3_128_digest(x.encode()) for x in lines), dtype="<i8").reshape(-1, 2)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def shingle_hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(number of shingles of each line, their 64-bit hashes in line order, repeats included).

    A short line is filled up with line feeds, which no line holds.
    """
    padded = [x if len(x) >= SPAN else x.ljust(SPAN, "\n") for x in lines]
    chars = np.frombuffer("".join(padded).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    lengths = np.fromiter(map(len, padded), dtype=np.int64, count=len(padded))
    two = chars[:-1] * _POWERS[0] + chars[1:]
    four = two[:-2] * _POWERS[1] + two[2:]
    eight = four[:-4] * _POWERS[2] + four[4:]
    hashes = _mixed(eight[:-1] * _POWERS[0] + chars[8:])
    whole = np.ones(len(hashes), dtype=bool)  # but not the windows over the end of a line
    ends = np.cumsum(lengths)[:-1]
    whole[(ends[:, None] - np.arange(1, SPAN)).ravel()] = False
    return lengths - SPAN + 1, hashes[whole]


def band_keys(lines: list[str]) -> np.ndarray:
    """KEYS band keys of each line."""
    counts, hashes = shingle_hashes(lines)
    low, bits = np.uint64(34), np.uint64(40)
    line = np.repeat(np.arange(len(lines), dtype=np.uint64), counts)
    ordered = np.sort((line << bits) | (hashes >> np.uint64(24)))  # line, range (6 bits), rest
    place = (ordered >> low).astype(np.int64)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    smallest = np.zeros(len(lines) * BINS, dtype=np.uint64)
    held = np.zeros(len(lines) * BINS, dtype=bool)
    smallest[place[first]] = (ordered[first] & np.uint64((1 << 34) - 1)) | ((ordered[first] >> low & np.uint64(BINS - 1)) << low)
    held[place[first]] = True
    smallest, held = smallest.reshape(-1, BINS).T.copy(), held.reshape(-1, BINS).T.copy()
    for at in range(2 * BINS - 2, -1, -1):  # twice round: the last ranges take from the first
        here, after = at % BINS, (at + 1) % BINS
        smallest[here] = np.where(held[here], smallest[here], smallest[after])
        held[here] |= held[after]
    keys = np.empty((len(lines), KEYS), dtype=np.uint64)
    for k in range(KEYS):
        key = np.full(len(lines), k + 1, dtype=np.uint64)
        for at in range(k, BINS, KEYS):
            key = _mixed(key * _POWERS[0] + smallest[at])
        keys[:, k] = key
    return keys.view(np.int64)


def _portions(sizes: Iterator[int], most: int) -> Iterator[slice]:
    """Stretches whose sizes add up to ``most``, or of a single larger one."""
    start, held, n = 0, 0, 0
    for n, size in enumerate(sizes, 1):
        if held and held + size > most:
            yield slice(start, n - 1)
            start, held = n - 1, 0
        held += size
    if n > start:
        yield slice(start, n)


# ------------------------------------------------------------------- the lines of a table


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(text_col), F.lit(""))


def _doc_hash(docs: DataFrame, id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col).cast("long"), _text(text_col))


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), _doc_hash(docs, id_col, text_col).alias("doc_hash"), _text(text_col).alias("text"))


def _taken(batch: pa.RecordBatch) -> tuple[pa.RecordBatch, list[str]]:
    """(doc_id, doc_hash, line_no, lid1, lid2) of the lines of a batch that are not blank, and the lines."""
    of, no, lines = [], [], []
    for row, text in enumerate(batch.column("text").to_pylist()):
        for k, line in enumerate(lines_of(text)):
            if line:
                of.append(row)
                no.append(k)
                lines.append(line)
    ids = line_ids(lines)
    rows = batch.select(["doc_id", "doc_hash"]).take(pa.array(of, pa.int64()))
    columns = [*rows.columns, pa.array(no, pa.int32()), pa.array(ids[:, 0].copy()), pa.array(ids[:, 1].copy())]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "doc_hash", "line_no", "lid1", "lid2"]), lines


def all_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All lines that are not blank: doc_id, doc_hash, line_no, lid1, lid2."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield _taken(batch)[0]

    return _narrow(docs, id_col, text_col).mapInArrow(split, "doc_id long, doc_hash long, line_no int, lid1 long, lid2 long")


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The same lines with their band keys m0, m1, ..."""
    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows, lines = _taken(batch)
            for part in _portions(map(len, lines), CHARS):
                keys = band_keys(lines[part])
                of = rows.slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays([*of.columns, *[pa.array(keys[:, k].copy()) for k in range(KEYS)]], [*of.schema.names, *[f"m{k}" for k in range(KEYS)]])

    columns = ", ".join(f"m{k} long" for k in range(KEYS))
    return _narrow(docs, id_col, text_col).mapInArrow(signed, f"doc_id long, doc_hash long, line_no int, lid1 long, lid2 long, {columns}")


def _order() -> Column:
    """(doc_id, line_no) as one exact decimal: a fixed-width minimum."""
    last = F.lit("9223372036854775808").cast("decimal(20,0)")
    return (F.coalesce(F.col("doc_id").cast("decimal(20,0)"), last) * F.lit("10000000000").cast("decimal(11,0)") + F.col("line_no")).cast("decimal(38,0)")


def _sized(df: DataFrame, elements: int) -> DataFrame:
    return F.broadcast(df) if elements <= BROADCAST_ELEMENTS else df


# ------------------------------------------------------------------------- comparison


def _shared(of: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """How many ids each two of ``n`` lines share; (line, id) rows are distinct and ids ordered."""
    both = np.zeros((n, n), dtype=np.int64)
    for part in range(0, ids[-1] + 1, max(1, CELLS // n)):
        a, b = np.searchsorted(ids, [part, part + max(1, CELLS // n)])
        cells = np.zeros((n, ids[b - 1] - part + 1), dtype=np.float32)  # sums below 2 ** 24 are exact
        cells[of[a:b], ids[a:b] - part] = 1
        both += (cells @ cells.T).astype(np.int64)
    return both


def similar(lines: list[str]) -> np.ndarray:
    """Which two lines have a Jaccard similarity of 0.8 or more, in whole numbers."""
    return _alike(*shingle_hashes(lines))


def _alike(counts: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The same from the number of shingles of each line and their hashes in line order."""
    n = len(counts)
    of = np.repeat(np.arange(n), counts)
    order = np.lexsort((of, hashes))
    of, hashes = of[order], hashes[order]
    new = np.diff(hashes, prepend=~hashes[:1]) != 0
    fresh = new | (np.diff(of, prepend=-1) != 0)  # a line's repeats of a shingle count once
    of, new = of[fresh], new[fresh]
    sizes = np.bincount(of, minlength=n)
    ids = np.cumsum(new) - 1
    common = (np.bincount(ids) > 1)[ids]  # others are of one line
    if not common.any():
        return np.zeros((n, n), dtype=bool)
    if n == 2:
        both = np.array([[0, 1], [1, 0]]) * (common.sum() // 2)
    else:
        _, dense = np.unique(ids[common], return_inverse=True)
        both = _shared(of[common], dense, n)
    return 5 * both >= 4 * (sizes[:, None] + sizes[None, :] - both)


def labels(linked: np.ndarray) -> np.ndarray:
    """The smallest index in the component of each line."""
    label = np.arange(len(linked))
    while True:
        least = np.minimum(label, np.where(linked, label[None, :], len(linked)).min(axis=1))
        least = least[least]
        if (least == label).all():
            return label
        label = least


def _linked(lid: np.ndarray, linked: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(line, smallest line of its component) of the lines that are not the smallest."""
    label = labels(linked)
    at = np.flatnonzero(label != np.arange(len(label)))
    if len(at):
        yield pa.RecordBatch.from_arrays([pa.array(lid[at]), pa.array(lid[label[at]])], ["a", "b"])


def _within(members: DataFrame) -> DataFrame:
    """(member, smallest line of its component) in groups (key; lid, set) of lines given by their shingles."""
    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):  # one group at a time
                group = batch.column("m")[row].values
                sets = group.field("set")
                counts = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
                yield from _linked(group.field("lid").to_numpy(zero_copy_only=False), _alike(counts, sets.flatten().to_numpy(zero_copy_only=False)))

    listed = members.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("lid", "set"))).alias("m")).where(F.size("m") > 1)
    return listed.select("m").mapInArrow(compared, "a long, b long")


def _within_texts(members: DataFrame) -> DataFrame:
    """(member, smallest line of its component) in groups (key; lid, block, line), without
    comparing lines of one block (not null)."""
    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):  # one group at a time
                group = batch.column("m")[row].values
                lid = group.field("lid").to_numpy(zero_copy_only=False)
                linked = similar(group.field("line").to_pylist())
                block = group.field("block")
                if not block.null_count:
                    own = block.to_numpy(zero_copy_only=False)
                    linked &= own[:, None] != own[None, :]
                yield from _linked(lid, linked)

    listed = members.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("lid", "block", "line"))).alias("m")).where(F.size("m") > 1)
    return listed.select("m").mapInArrow(compared, "a long, b long")


def _compared(met: DataFrame, lines: DataFrame, total: int) -> DataFrame:
    """Links of the lines that meet under a key (key, lid; n: how many meet, counted if absent).

    Keys often bring the same lines together: groups are made distinct as ids
    before their lines (lid, line) join them.
    """
    sized = met
    if "n" not in met.columns:
        counts = materialise(met.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "bands")
        sized = join_counted(met, counts, ["key"], "n", total)
    none = F.lit(None).cast("long")
    small = sized.where(F.col("n") <= SMALL).select("key", none.alias("lo"), none.alias("hi"), "lid", none.alias("block"))
    width = F.ceil(F.col("n") / (FINE // 2))
    large = sized.where(F.col("n") > SMALL).select("key", "lid", width.alias("width"), F.pmod(F.xxhash64("lid"), width).alias("own"))
    dealt = large.select("key", "lid", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("width") - 1)).alias("other"))
    # in the group of a block with itself all lines are compared, in the others only across
    dealt = dealt.select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "lid", F.when(F.col("own") != F.col("other"), F.col("own")).alias("block"))
    listed = small.unionByName(dealt).groupBy("key", "lo", "hi").agg(F.sort_array(F.collect_list(F.struct("lid", "block"))).alias("ls")).select("ls").distinct()
    members = listed.select(F.xxhash64("ls").alias("key"), F.explode("ls").alias("x")).select("key", "x.lid", "x.block")
    return materialise(_within_texts(members.join(lines, "lid")).distinct(), "line_links")


def _lines_of(wanted: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(lid, line) of ``wanted`` distinct lines (lid1, lid2, doc_hash, line_no: an occurrence),
    read again from the texts.

    A document is joined once, with the numbers of its wanted lines, and no
    other line is looked at.  No array is longer than its document has lines.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            lids, lines = [], []
            for text, want in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist()):
                raw = text.split("\n")
                for w in want:  # another document of the same hash has other lines
                    line = collapsed(raw[w["line_no"]]).strip(" ") if w["line_no"] < len(raw) else ""
                    if tuple(line_ids([line])[0]) == (w["lid1"], w["lid2"]):
                        lids.append(w["lid1"])
                        lines.append(line)
            yield pa.RecordBatch.from_arrays([pa.array(lids, pa.int64()), pa.array(lines, pa.string())], ["lid", "line"])

    per_doc = materialise(wanted.groupBy("doc_hash").agg(F.collect_list(F.struct("line_no", "lid1", "lid2")).alias("wanted")), "wanted_docs")
    elements = per_doc.agg(F.sum(F.size("wanted") + 1)).first()[0] or 0
    found = _narrow(docs, id_col, text_col).join(_sized(per_doc, elements), "doc_hash").select("text", "wanted").mapInArrow(read, "lid long, line string")
    return found.dropDuplicates(["lid"])


def _met(keyed: DataFrame) -> tuple[DataFrame, int]:
    """(key, lid, n) of the rows of ``keyed`` (key, lid) whose key n > 1 of them hold, and their number.

    Rows move once, whatever the input's size.  Hot keys stay out of that exchange:
    they are counted exactly among the rows of the few buckets that hold more
    than one in HOT_KEYS of all rows, so fewer than HOT_KEYS keys are broadcast.
    """
    bucket = F.pmod("key", F.lit(BUCKETS))
    buckets = materialise(keyed.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n")), "key_buckets")
    limit = max(SMALL, (buckets.agg(F.sum("n")).first()[0] or 0) // HOT_KEYS)
    full, rest, hot = buckets.where(F.col("n") > limit), keyed, None
    if not full.isEmpty():
        near = keyed.join(F.broadcast(full.select("bucket")), bucket == F.col("bucket"), "left_semi")
        counts = materialise(near.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > limit), "hot_keys")
        hot = keyed.join(F.broadcast(counts), "key").select("key", "lid", "n")
        rest = keyed.join(F.broadcast(counts.select("key")), "key", "left_anti")
    met = rest.select("key", "lid", F.count("*").over(Window.partitionBy("key")).alias("n")).where("n > 1")
    met = materialise(met if hot is None else met.unionByName(hot), "met")
    return met, met.count()


def line_links(distinct: DataFrame, lines: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Verified links (a, b) between distinct lines, by their lid1."""
    keyed = distinct.select(F.col("lid1").alias("lid"), F.explode(F.array_distinct(F.array(*[F.col(f"m{k}") for k in range(KEYS)]))).alias("key"))
    met, total = _met(keyed)
    if not total:
        return distinct.sparkSession.createDataFrame([], "a long, b long")
    wanted = met.select(F.col("lid").alias("lid1")).distinct().join(distinct.select("lid1", "lid2", "first"), "lid1")
    # rows that repeat an id and a line number with the same line differ in the document: one is enough
    at = lines.select("lid1", "lid2", "doc_hash", "line_no", _order().alias("first")).join(wanted, ["lid1", "lid2", "first"])
    at = at.groupBy("lid1", "lid2", "line_no").agg(F.min("doc_hash").alias("doc_hash"))
    texts = materialise(_lines_of(at, docs, id_col, text_col), "candidates")
    return _compared(met, texts, total)


# ----------------------------------------------------------------------------- result


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, doc_hash, drop): the numbers of the lines each document loses."""
    with shuffles_dropped(docs.sparkSession):
        return _repeated_lines(docs, id_col, text_col)


def _repeated_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    lines = materialise(all_lines(docs, id_col, text_col), "lines")
    distinct = materialise(
        signatures(docs, id_col, text_col).groupBy("lid1", "lid2").agg(F.min(_order()).alias("first"), F.count("*").alias("n"), *[F.min(f"m{k}").alias(f"m{k}") for k in range(KEYS)]),
        "distinct_lines")
    roots = materialise(components(line_links(distinct, lines, docs, id_col, text_col)), "line_roots")
    joined = distinct.select("lid1", "lid2", "first", "n").join(roots.withColumnRenamed("node", "lid1"), "lid1", "left")
    placed = materialise(joined.select(
        "lid1", "lid2", "first", "n", F.coalesce("root", "lid1").alias("c1"), F.when(F.col("root").isNull(), F.col("lid2")).otherwise(0).alias("c2")), "placed_lines")
    kept = materialise(placed.groupBy("c1", "c2").agg(F.min("first").alias("keep"), F.sum("n").alias("copies"), F.count("*").alias("kinds")).where("copies > 1"), "kept_lines")
    kinds = placed.count()
    repeated = materialise(join_counted(placed.drop("first"), kept.select("c1", "c2", "keep", "kinds"), ["c1", "c2"], "kinds", kinds).select("lid1", "lid2", "keep", "n"), "repeated")
    total = repeated.agg(F.sum("n")).first()[0] or 0
    dropped = join_counted(lines.withColumn("first", _order()), repeated, ["lid1", "lid2"], "n", total).where("first <> keep")
    return materialise(dropped.groupBy("doc_id", "doc_hash").agg(F.collect_set("line_no").alias("drop")), "dropped")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, text (without the dropped lines)."""
    dropped = repeated_lines(docs, id_col, text_col).select(F.col("doc_id").alias("__id"), F.col("doc_hash").alias("__hash"), "drop")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), _text(text_col).alias("text"), _doc_hash(docs, id_col, text_col).alias("__doc_hash"))
    same = (F.col("__doc_hash") == F.col("__hash")) & F.col("doc_id").eqNullSafe(F.col("__id"))
    joined = rows.join(dropped, same, "left").withColumn("lines", F.split("text", "\n"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "drop")
    text = F.when(F.col("drop").isNull(), F.col("text")).otherwise(F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n"))
    return joined.select("doc_id", F.size("lines").cast("long").alias("n_lines"), F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"), text.alias("text"))
