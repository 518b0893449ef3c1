"""Training-order materialisation: token sequences in a keyed random order.

Documents, each ended by an end token, form one token stream that is cut into
sequences of ``length`` tokens (the last one padded).  A keyed Feistel network
over the smallest even number of bits that holds all sequence numbers, walked
until the result is below their count, permutes them: every sequence has one
global slot, computed and inverted without a table.  Range partitions of slots
(shard = slot // sequences per shard) are written as fixed-stride files: each
record is ``length`` tokens of ``width`` bytes and one line feed, so record r
of a shard starts at r * stride, and reading can go on at any slot.

Three steps: a narrow aggregate counts the tokens of each scan partition (one
row per partition, whatever it holds); a scan knows from it where its documents
stand in the stream, cuts them and sends each piece straight to its shard (the
one shuffle); shards are sorted by slot, joined and written by Spark's text
writer, so task retries, commits and any Hadoop file system work as for every
table.  Many shards can be written in waves, so that the disk holds the shards and a
small part of what they are made from: the pieces are stored by wave, the
ids are deleted if the caller says so, and each wave's pieces and shuffle go when its shards
(in a folder named by the first of them) are there.  Slots spread each document's pieces over all shards, so a hot source
or a very long document makes no hot shard.  A task whose partition differs
from the one counted (the input changed in between) fails instead of writing
wrong offsets.

Defined results: null text counts as empty (its end token alone); a null doc_id is
an id like any other; repeated rows are separate documents; an empty table gives no shard; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise, release, shuffles_dropped
from .common import SLICE_ROWS

LENGTH = 2048
SHARD_BYTES = 8 << 20
WAVE_SHARDS = 16  # a wave has so many shards at least
KEY = 0x5EED
ROUNDS = 6
#: Byte vocabulary: a token is a byte of the UTF-8 text; two bytes that UTF-8 never uses end and pad.
END, PAD = 0xFF, 0xFE


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """A keyed 64-bit mixing function (wrapping arithmetic)."""
    x = x + np.uint64(key)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class Permutation:
    """A keyed permutation of 0 .. size - 1."""

    size: int
    key: int = KEY

    @property
    def half(self) -> int:
        return max(1, (max(1, self.size - 1).bit_length() + 1) // 2)

    def _keys(self) -> list[int]:
        return [int.from_bytes(hashlib.sha256(f"{self.key}:{r}".encode()).digest()[:8], "little") for r in range(ROUNDS)]

    def _network(self, x: np.ndarray, back: bool) -> np.ndarray:
        half, mask = np.uint64(self.half), np.uint64((1 << self.half) - 1)
        left, right = x >> half, x & mask
        if back:
            for k in reversed(self._keys()):
                left, right = right ^ (_mix(left, k) & mask), left
        else:
            for k in self._keys():
                left, right = right, left ^ (_mix(right, k) & mask)
        return (left << half) | right

    def _walk(self, x, back: bool) -> np.ndarray:
        x = np.asarray(x, dtype=np.uint64)
        out = self._network(x, back)
        outside = out >= self.size
        while outside.any():  # cycle-walking: the cycle leads back below size
            out[outside] = self._network(out[outside], back)
            outside = out >= self.size
        return out.astype(np.int64)

    def slot(self, sequence) -> np.ndarray:
        return self._walk(sequence, False)

    def sequence(self, slot) -> np.ndarray:
        return self._walk(slot, True)


@dataclass(frozen=True)
class Layout:
    n_tokens: int
    length: int = LENGTH
    width: int = 1
    key: int = KEY
    shard_bytes: int = SHARD_BYTES
    most_waves: int = 1

    @property
    def sequences(self) -> int:
        return -(-self.n_tokens // self.length)

    @property
    def stride(self) -> int:
        return self.length * self.width + 1

    @property
    def per_shard(self) -> int:
        return max(1, self.shard_bytes // self.stride)

    @property
    def shards(self) -> int:
        return max(1, -(-self.sequences // self.per_shard))

    @property
    def per_wave(self) -> int:
        return -(-self.shards // max(1, min(self.most_waves, self.shards // WAVE_SHARDS)))

    def waves(self, path: str) -> list[tuple[int, int, str]]:
        """(first shard, number of shards, folder) of each wave of shards under ``path``."""
        firsts = range(0, self.shards, self.per_wave)
        return [(k, min(self.per_wave, self.shards - k), f"{path}/from-{k:05d}" if len(firsts) > 1 else path) for k in firsts]

    @property
    def order(self) -> Permutation:
        return Permutation(self.sequences, self.key)


def byte_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the UTF-8 bytes of each text are its token ids, one byte each."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("ids"))


def _partitions(tokens: DataFrame, width: int) -> DataFrame:
    """Per scan partition: documents, tokens with end tokens, and a check on its doc_ids."""
    n = (F.octet_length("ids") / width).cast("long") + 1
    return tokens.groupBy(F.spark_partition_id().alias("part")).agg(
        F.count("*").alias("docs"), F.sum(n).alias("tokens"), F.sum(F.coalesce(F.xxhash64("doc_id"), F.lit(0)).bitwiseAND(F.lit(0xFFFFFFFF))).alias("ids_sum"))


def pieces(tokens: DataFrame, width: int = 1, end: int = END, pad: int = PAD, length: int = LENGTH, key: int = KEY, shard_bytes: int = SHARD_BYTES,
           id_width: int | None = None, waves: int = 1) -> tuple[DataFrame, Layout]:
    """(slot, at, shard, compressed piece) rows that make up all sequences, and the layout.

    ``width`` is the bytes of a token in the shards, ``id_width`` those in ``tokens`` and
    in the pieces (the same if None): narrow ids are widened when a shard is written.  ``waves``: at most
    so many, see above.
    """
    spark = tokens.sparkSession
    record, width = width, id_width or width
    if record < width:
        raise ValueError("shard tokens must be at least as wide as the ids")
    known, before = [], 0
    for r in _partitions(tokens, width).orderBy("part").collect():  # one row per scan partition
        known.append((r["part"], before, r["docs"], r["tokens"], r["ids_sum"]))
        before += r["tokens"]
    layout = Layout(before, length, record, key, shard_bytes, waves)
    starts = spark.createDataFrame(pa.Table.from_arrays(  # from Arrow: no Python worker is started for it
        [pa.array(c, t) for c, t in zip(list(zip(*known)) or [()] * 5, [pa.int32()] + [pa.int64()] * 4)], ["part", "start", "docs", "tokens", "ids_sum"]))
    end_bytes, pad_bytes = end.to_bytes(width, "little"), pad.to_bytes(width, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, at, docs, sums, want = layout.order, None, 0, 0, None
        pack = zstandard.ZstdCompressor(level=1).compress  # halves what crosses the shuffle
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(lo, SLICE_ROWS)
                if at is None:
                    want = tuple(part.column(c)[0].as_py() for c in ("start", "docs", "tokens", "ids_sum"))
                    at = want[0]
                seqs, ats, data = [], [], []
                for ids in part.column("ids"):
                    stream, done = ids.as_py() + end_bytes, 0
                    while done < len(stream):
                        seq, within = divmod(at, length)
                        piece = stream[done:done + (length - within) * width]
                        seqs.append(seq)
                        ats.append(within)
                        data.append(pack(piece))
                        done += len(piece)
                        at += len(piece) // width
                docs += part.num_rows
                sums += sum(part.column("mark").to_pylist())
                if at == layout.n_tokens and layout.n_tokens % length:  # the end of the stream is padded
                    seqs.append(at // length)
                    ats.append(at % length)
                    data.append(pack(pad_bytes * (length - at % length)))
                slots = order.slot(seqs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slots), pa.array(ats, pa.int32()), pa.array((slots // layout.per_shard).astype(np.int32)), pa.array(data, pa.binary())],
                    names=["slot", "at", "shard", "piece"])
        if want is not None and want[1:] != (docs, at - want[0], sums):
            raise RuntimeError("the scan's partitions changed after they were counted; run again")

    marked = tokens.select("ids", F.coalesce(F.xxhash64("doc_id"), F.lit(0)).bitwiseAND(F.lit(0xFFFFFFFF)).alias("mark"), F.spark_partition_id().alias("part"))
    placed = marked.join(F.broadcast(starts), "part").select("ids", "mark", "start", "docs", "tokens", "ids_sum")
    return placed.mapInArrow(run, "slot long, at int, shard int, piece binary"), layout


def _from(first: int, last: int) -> list[str]:
    """File name patterns of the five-digit (or longer) numbers from ``first`` to ``last``."""
    low, out = f"{first:05d}", []
    for length in range(len(low), len(f"{last:05d}") + 1):
        if length > len(low):
            low = "1" + "0" * (length - 1)
        out.append(low)
        out += [low[:i] + f"[{int(d) + 1}-9]" + "[0-9]" * (length - 1 - i) for i, d in enumerate(low) if d != "9"]
    return out


def write_shards(tokens: DataFrame, path: str, free: bool = False, **options) -> Layout:
    """Write the sequences of ``tokens`` (doc_id, ids) as shards under ``path``; ``options`` as in ``pieces``.

    ``free``: nothing else reads ``tokens``, which ``materialise`` wrote and which may go once it is cut.
    """
    rows, layout = pieces(tokens, **options)
    given, stored = f"<u{options.get('id_width') or layout.width}", f"<u{layout.width}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, held, n, now = layout.length * layout.width, [], 0, None
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for slot, piece in zip(batch.column("slot").to_pylist(), batch.column("piece").to_pylist()):
                if n and slot != now:
                    raise RuntimeError(f"slot {now} has {n} of {size} bytes")
                now = slot
                part = unpack(piece)
                held.append(part if given == stored else np.frombuffer(part, given).astype(stored).tobytes())
                n += len(held[-1])
                if n == size:
                    out.append(b"".join(held))
                    held, n = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
        if n:
            raise RuntimeError(f"slot {now} has {n} of {size} bytes")

    waves = layout.waves(path)
    if len(waves) > 1:
        rows = materialise(rows.withColumn("wave", F.floor(F.col("shard") / layout.per_wave).cast("int")), "pieces", compression="none", by="wave")
        if free:
            release(tokens)
    with shuffles_dropped(tokens.sparkSession):
        for wave, (first, n, folder) in enumerate(waves):
            own = rows.where(F.col("wave") == wave) if len(waves) > 1 else rows
            shards = own.repartitionById(n, F.col("shard") - first).sortWithinPartitions("slot", "at").select("slot", "piece")
            shards.mapInArrow(run, "value binary").select(F.col("value").cast("string")).write.option("compression", "none").text(folder)
            if len(waves) > 1:
                release(rows, f"wave={wave}")
    return layout


def read_shards(spark: SparkSession, path: str, layout: Layout, first_slot: int = 0) -> DataFrame:
    """(slot, shard, byte_offset, sequence, n_tokens, ids) from ``first_slot`` on, in slot order within a shard.

    Shards before the one that holds ``first_slot`` are neither listed nor opened: the
    file names that a read takes are made from the shard numbers.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                folder, name = path.rsplit("/", 2)[1:]
                shard = firsts.get(folder, 0) + int(name.split("-")[1])
                records = np.frombuffer(content.as_buffer(), np.uint8)
                records = records[:len(records) // layout.stride * layout.stride].reshape(-1, layout.stride)
                begin, size = shard * layout.per_shard, layout.stride - 1
                for lo in range(max(0, first_slot - begin), len(records), SLICE_ROWS):
                    hi = min(lo + SLICE_ROWS, len(records))
                    slots = np.arange(begin + lo, begin + hi)
                    seqs = layout.order.sequence(slots)
                    ids = pa.Array.from_buffers(pa.binary(size), hi - lo, [None, pa.py_buffer(records[lo:hi, :size].copy())])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(slots), pa.array(np.full(hi - lo, shard, np.int32)), pa.array(np.arange(lo, hi) * layout.stride), pa.array(seqs),
                         pa.array(np.minimum(layout.length, layout.n_tokens - seqs * layout.length)), ids.cast(pa.binary())],
                        names=["slot", "shard", "byte_offset", "sequence", "n_tokens", "ids"])

    begin, waves, parts = first_slot // layout.per_shard, layout.waves(path), []
    firsts = {folder.rsplit("/", 1)[1]: first for first, _, folder in waves} if len(waves) > 1 else {}
    waves = [(max(0, begin - first), n, folder) for first, n, folder in waves if first + n > begin or first + n == layout.shards]
    for these in (waves[:1], waves[1:]):  # only the first of them is read in part
        if these:
            names = ",".join(_from(these[0][0], max(n for _, n, _ in these)))
            # as it is scanned: each column expression would copy whole shards in the JVM
            parts.append(spark.read.format("binaryFile").option("pathGlobFilter", f"part-{{{names}}}-*").load([folder for _, _, folder in these]).select("path", "content"))
    return reduce(DataFrame.unionAll, parts).mapInArrow(run, "slot long, shard int, byte_offset long, sequence long, n_tokens long, ids binary")
