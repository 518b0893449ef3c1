"""Exact deduplication by composable polynomial fingerprints.

A text (white-space runs collapsed) is cut into fixed chunks of bytes.  Each
chunk has a polynomial hash modulo two primes; the hash of a concatenation is
``hash(left) * base**len(right) + hash(right)``, so the chunks of a huge
document are hashed independently of each other (one matrix product) and
combined by length-shifted arithmetic.  Texts with equal (fingerprints, byte
length) form a group only after a chunkwise comparison: (group, chunk number,
chunk bytes) is aggregated in Spark, which compares the bytes themselves,
collapses copies before the shuffle (a group with a third of all rows sends
one row per task and chunk) and never holds a group in one task.  Groups in
which two chunks differ are split by the digest of the text.

Defined results: null text counts as empty; a null doc_id sorts after every
other; of rows with equal texts the smallest doc_id stays, and of rows that
also repeat the doc_id the first in the written fingerprint table stays, so a
group always keeps exactly one row.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import BLANKS, first_of_each, id_and_text, join_counted, slices, unused

PRIMES = (2147483647, 2147483629)
BASES = (911382323, 972663749)
CHUNK = 1 << 16
ROWS_SCHEMA = "doc_id long, uid long, fp1 long, fp2 long, n_bytes long, text_sha256 string"
_RUN = re.compile(rb"[ \t-\r]+")
_BLANK = b" \t\n\r\x0b\x0c"


def normalise(text: bytes) -> bytes:
    """Replace each run of ASCII white space by one space."""
    if not text:
        return b""
    body = b" ".join(text.split())
    if not body:
        return b" "
    return (b" " if text[:1] in _BLANK else b"") + body + (b" " if text[-1:] in _BLANK else b"")


class Fingerprint:
    """Polynomial hashes of byte strings that compose by concatenation."""

    def __init__(self, chunk: int = CHUNK, primes=PRIMES, bases=BASES):
        self.chunk, self.primes, self.bases = chunk, primes, bases
        self.powers = []
        for p, b in zip(primes, bases):
            row, x = np.empty(chunk, dtype=np.uint64), 1
            for i in range(chunk - 1, -1, -1):
                row[i] = x
                x = x * b % p
            self.powers.append(row)

    def of_chunks(self, data: bytes) -> list[tuple[int, ...]]:
        """Hashes of the full chunks at once, then of the rest: independent of each other."""
        raw = np.frombuffer(data, dtype=np.uint8)
        full = len(raw) // self.chunk
        out = []
        if full:
            grid = raw[: full * self.chunk].reshape(full, self.chunk).astype(np.uint64) + np.uint64(1)
            out += list(zip(*((grid @ w % np.uint64(p)).tolist() for w, p in zip(self.powers, self.primes))))
        if len(raw) > full * self.chunk:
            rest = raw[full * self.chunk:].astype(np.uint64) + np.uint64(1)
            out.append(tuple(int(rest @ w[-len(rest):]) % p for w, p in zip(self.powers, self.primes)))
        return out

    def join(self, left: tuple[int, ...], right: tuple[int, ...], right_len: int) -> tuple[int, ...]:
        """Hash of left + right from the hashes of both."""
        return tuple(
            (a * pow(base, right_len, p) + b) % p for a, b, base, p in zip(left, right, self.bases, self.primes)
        )

    def of(self, data: bytes) -> tuple[int, ...]:
        total = tuple(0 for _ in self.primes)
        left = len(data)
        for h in self.of_chunks(data):
            size = min(self.chunk, left)
            total = self.join(total, h, size)
            left -= size
        return total


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", primes=PRIMES) -> DataFrame:
    """(doc_id, uid, fp1, fp2, n_bytes, text_sha256) per row, written to the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fp = Fingerprint(primes=primes)
        for batch in slices(batches):
            rows = [(normalise(t.as_py())) for t in batch.column("text")]
            hashes = [fp.of(t) for t in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("uid"),
                    pa.array([h[0] for h in hashes], pa.int64()), pa.array([h[1] for h in hashes], pa.int64()),
                    pa.array([len(t) for t in rows], pa.int64()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in rows], pa.string()),
                ],
                names=["doc_id", "uid", "fp1", "fp2", "n_bytes", "text_sha256"],
            )

    source = id_and_text(docs, id_col, text_col).withColumn("uid", F.monotonically_increasing_id())
    return materialise(source.mapInArrow(run, ROWS_SCHEMA), "fingerprints")


def differing_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", primes=PRIMES) -> DataFrame:
    """(fp1, fp2, n_bytes) of the groups in which some chunk has two contents.

    The chunk itself is a grouping key: Spark compares its bytes, with copies
    collapsed in each task before the shuffle, and a text is never moved or
    held as a whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fp = Fingerprint(primes=primes)
        for batch in slices(batches):
            cols: list[list] = [[], [], [], [], []]
            for value in batch.column("text"):
                text = normalise(value.as_py())
                h = fp.of(text)
                for k, at in enumerate(range(0, len(text), CHUNK)):
                    for col, x in zip(cols, (h[0], h[1], len(text), k, text[at:at + CHUNK])):
                        col.append(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in cols[:4]] + [pa.array(cols[4], pa.binary())],
                names=["fp1", "fp2", "n_bytes", "chunk_no", "chunk"],
            )

    chunks = id_and_text(docs, id_col, text_col).mapInArrow(run, "fp1 long, fp2 long, n_bytes long, chunk_no long, chunk binary")
    contents = chunks.groupBy("fp1", "fp2", "n_bytes", "chunk_no", "chunk").agg(F.count("*").alias("copies"))
    return (
        contents.groupBy("fp1", "fp2", "n_bytes", "chunk_no").agg(F.count("*").alias("contents"))
        .where("contents > 1").select("fp1", "fp2", "n_bytes").distinct()
    )


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", primes=PRIMES) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256,
    uid, fp1, fp2, n_bytes (the last four identify the row and its text)."""
    keys = ["fp1", "fp2", "n_bytes", "part"]
    rows = fingerprints(docs, id_col, text_col, primes).withColumn("part", F.lit(""))
    split = materialise(differing_groups(docs, id_col, text_col, primes), "differing")
    if split.limit(1).count():  # equal fingerprints, different texts: the digest parts them
        known = ["fp1", "fp2", "n_bytes"]
        rows = rows.join(split, known, "left_anti").unionByName(
            rows.join(split, known, "left_semi").withColumn("part", F.col("text_sha256"))
        )
    # (doc_id, uid) as one exact decimal: a fixed-width minimum, hash-aggregated
    last = F.lit("9223372036854775808").cast("decimal(20,0)")
    order = (F.coalesce(F.col("doc_id").cast("decimal(20,0)"), last) * F.lit("1000000000000000000").cast("decimal(19,0)") + F.col("uid")).cast("decimal(38,0)")
    rows = rows.withColumn("order_key", order)
    groups = materialise(
        rows.groupBy(*keys).agg(F.min("order_key").alias("first"), F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")),
        "groups",
    )
    total = groups.agg(F.sum("group_size")).first()[0] or 0
    return join_counted(rows, groups, keys, "group_size", total).select(
        "doc_id", "keep_id", "group_size", (F.col("order_key") == F.col("first")).alias("kept"), "text_sha256",
        "uid", "fp1", "fp2", "n_bytes",
    )


def row_key(doc_id, text):
    """Identity of a row: its doc_id and the digest of its normalised text."""
    body = F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("-")), F.sha2(body, 256))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they came.

    The rows that stay are found by (doc_id, digest of the text); of rows that
    repeat both, the first by a hash of all columns stays.  That ranking runs only
    if such rows exist, which a count over the narrow table tells.
    """
    (mark,) = unused(docs, "__exact_key")
    groups = exact_groups(docs, id_col, text_col).select(
        F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "text_sha256").alias(mark), "kept")
    marked = docs.withColumn(mark, row_key(F.col(id_col), F.col(text_col)))
    found = marked.join(groups.where("kept").select(mark), mark, "left_semi")
    if groups.groupBy(mark).count().where("count > 1").limit(1).count():
        found = first_of_each(found, mark)
    return found.drop(mark)
