"""Grouping of spelling variants by PartEnum signatures.

Words (runs of letters, counted over all documents) that differ by one
inserted, deleted or replaced code point are near.  A word is taken as the
binary vector of its letter multiset: the bit (letter, k) is set when the letter
occurs more than k times.  One edit changes at most two bits, so near words have
vectors within Hamming distance two.  The bits are dealt into PARTS parts (the
common ones evenly by their counts, others by a hash); whatever two bits differ,
all the other parts agree, so for one of the choices of PARTS - 2 parts both
words have the same projection.  Each choice gives one exact signature per word;
words that share a signature meet in an equi-join, whose condition verifies the
Hamming and the edit distance.  Signatures are 64-bit hashes of projections: a
collision adds a candidate, never a result.

A word's form is its near word with the largest count (ties: the first in
code-point order) if that count is at least twice its own; counts at least
double along forms, so forms end, and pointer doubling finds the last one in
as many rounds as the logarithm of the longest chain.

Every join here is between tables that grow with the vocabulary and is told to
merge (``shuffled``): Spark sizes a table of signed words like the file of words,
28 times too low, and words and pairs by their compressed files, so below its
limit it would send them whole through the driver.

Defined results: a null text has no words; a null id stands as the empty text
in the checksum; rows that repeat an id count like others; an empty table gives
no rows.  Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import lower_ascii
from .merkle import CRC_SQL, crc_of_bytes

LETTERS = "A-Za-zÀ-ÿ"
PARTS = 8        # parts of the bits; two of them may differ
COMMON = 4       # occurrences of a letter whose bits are dealt by their counts
LEAST_LENGTH, LEAST_COUNT, EVERY = 5, 3, 97
LEFT_OUT = list(combinations(range(PARTS), 2))
_WORD64 = (1 << 64) - 1


def without_point(run: Column, at: Column) -> Column:
    """``run`` without its code point at place ``at`` (from 0)."""
    at = at.cast("int")
    return F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))


def vocabulary(docs: DataFrame, every: int = EVERY, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): the words of whole texts; in one of ``every`` (document, run) pairs the
    checksum drops a code point of the run."""
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all("text", F.lit(f"[{LETTERS}]+"), F.lit(0))).alias("run"),
    ).where(F.length("run") >= least_length)
    hashed = runs.select(lower_ascii(F.col("run")).alias("run"), "id").select(
        "run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    word = F.when(F.col("h") % every == 0, without_point(F.col("run"), F.col("h") % F.length("run"))).otherwise(F.col("run"))
    words = hashed.select(word.alias("word")).where(F.length("word") >= least_length)
    return materialise(words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count), "vocabulary")


def shuffled(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """The join of two tables of which neither is broadcast, however small Spark takes them to be."""
    return left.join(right.hint("merge"), key, how)


# ---- signatures ----------------------------------------------------------------


def _mixed(x: int) -> int:
    """A fixed 64-bit mix of an integer."""
    x = (x + 0x9E3779B97F4A7C15) & _WORD64
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _WORD64
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & _WORD64
    return x ^ (x >> 31)


def bits(word: str) -> list[tuple[str, int]]:
    """The bits set in a word's vector: (letter, k) for k below the letter's count."""
    return [(letter, k) for letter, count in Counter(word).items() for k in range(count)]


def common_bits(words: DataFrame) -> dict[tuple[str, int], int]:
    """How many words have each bit (letter, k) with k < COMMON: at most COMMON per letter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for word in batch.column("word").to_pylist():
                seen.update(b for b in bits(word) if b[1] < COMMON)
        yield pa.RecordBatch.from_arrays(
            [pa.array([b[0] for b in seen], pa.string()), pa.array([b[1] for b in seen], pa.int32()), pa.array(list(seen.values()), pa.int64())],
            names=["letter", "k", "n"])

    counted = words.select("word").mapInArrow(run, "letter string, k int, n long").groupBy("letter", "k").agg(F.sum("n").alias("n"))
    return {(r["letter"], r["k"]): r["n"] for r in counted.collect()}


def dealt(counts: dict[tuple[str, int], int], total: int) -> dict[tuple[str, int], int]:
    """Common bits dealt to the parts so that each part tells words apart about as well as
    the others: the most telling bits first, each to the part that has least so far.  Which
    part a bit is in changes the number of candidates, never the pairs found."""

    def telling(b) -> float:
        p = counts[b] / max(1, total)
        return -log(p * p + (1 - p) * (1 - p))

    parts, out = [0.0] * PARTS, {}
    for b in sorted(counts, key=lambda b: (-telling(b), b)):
        at = parts.index(min(parts))
        parts[at] += telling(b)
        out[b] = at
    return out


class Signer:
    """Signatures of words: one 64-bit sum of bit hashes per choice of PARTS - 2 parts
    (bits are distinct, so a sum stands for the set), and a 64-bit sketch of each word:
    its vector folded to 32 bits, and 16 bits each of its first and last ``end`` letters."""

    def __init__(self, part_of: dict[tuple[str, int], int], end: int):
        self.part_of, self.end, self.known, self.ends = part_of, end, {}, {}

    def bit(self, b: tuple[str, int]) -> tuple[int, int, int]:
        if (found := self.known.get(b)) is None:
            h = _mixed(ord(b[0]) << 32 | b[1])
            found = self.known[b] = (self.part_of.get(b, h % PARTS), _mixed(h), 1 << (h >> 59))
            if len(self.known) > 1 << 16:
                self.known.clear()
        return found

    def letters(self, letters: str) -> int:
        if (found := self.ends.get(letters)) is None:
            found = self.ends[letters] = _mixed(sum(ord(c) << 16 * i for i, c in enumerate(letters))) >> 48
        return found

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(words, choices) signatures and the sketches."""
        sums, sketch = np.zeros((len(words), PARTS), dtype=np.uint64), np.zeros(len(words), dtype=np.uint64)
        for row, word in enumerate(words):
            parts, mask = [0] * PARTS, 0
            for b in bits(word):
                part, h, place = self.bit(b)
                parts[part] += h
                mask |= place
            sums[row] = [x & _WORD64 for x in parts]
            sketch[row] = self.letters(word[:self.end]) << 48 | self.letters(word[len(word) - self.end:]) << 32 | mask
        left, right = np.array(LEFT_OUT).T
        sigs = sums.sum(axis=1, dtype=np.uint64)[:, None] - sums[:, left] - sums[:, right]
        sigs += np.arange(len(LEFT_OUT), dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019)
        sigs = (sigs ^ (sigs >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return sigs.view(np.int64), sketch.view(np.int64)


def signed(words: DataFrame, part_of: dict[tuple[str, int], int], end: int) -> DataFrame:
    """(sig, sketch, word, n): every signature of every word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(part_of, end)
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                piece = batch.slice(at, 2048)
                sigs, sketch = signer.of(piece.column("word").to_pylist())
                rows = np.repeat(np.arange(piece.num_rows), len(LEFT_OUT))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sigs.reshape(-1)), pa.array(sketch[rows]), piece.column("word").take(pa.array(rows)), piece.column("n").take(pa.array(rows))],
                    names=["sig", "sketch", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "sig long, sketch long, word string, n long")


def near_pairs(words: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """(a, b, n_a, n_b), a < b: all pairs of ``words`` at edit distance one, once each.

    Words of one signature are compared by their sketches first: folding can only
    lower a Hamming distance, and one edit leaves the first or the last half of
    ``least_length`` letters alone.  Then their letters are compared.
    """
    sigs = signed(words, dealt(common_bits(words), words.count()), least_length // 2)
    left = sigs.select("sig", F.col("sketch").alias("s_a"), F.col("word").alias("a"), F.col("n").alias("n_a"))
    right = sigs.select("sig", F.col("sketch").alias("s_b"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    differ = F.col("s_a").bitwiseXOR(F.col("s_b"))
    an_end = (F.shiftrightunsigned(differ, 48) == 0) | (differ.bitwiseAND(0xFFFF << 32) == 0)
    near = an_end & (F.bit_count(differ.bitwiseAND(0xFFFFFFFF)) <= 2) & (F.col("a") < F.col("b")) & (F.levenshtein("a", "b", 1) == 1)
    return materialise(shuffled(left, right, "sig").where(near).select("a", "b", "n_a", "n_b").distinct(), "near_words")


# ---- forms ---------------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: the end of their chain, by pointer doubling."""
    now = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = materialise(shuffled(now, further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        now = step.select("word", "root")
        if not step.where("moved").limit(1).count():
            return now


def variants(docs: DataFrame, every: int = EVERY, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root."""
    words = vocabulary(docs, every, least_length, least_count)
    pairs = near_pairs(words, least_length)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("other_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("other_n")))
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best"))
    judged = shuffled(words, best, "word", "left")
    has = -F.col("best.less") >= 2 * F.col("n")
    judged = materialise(judged.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has, F.col("best.form")).alias("form"), F.when(has, -F.col("best.less")).alias("form_n")), "forms")
    ends = roots(judged.where("form IS NOT NULL"))
    return shuffled(judged, ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BYTES = ("flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), "
          "lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [192 | (ord(c) >> 6), 128 | (ord(c) & 63)] END))")

SQL = f"""
WITH RECURSIVE {CRC_SQL.strip()},
runs AS (SELECT doc_id, translate(run, '{_UPPER}', '{_LOWER}') AS run, count(*) AS c
         FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
         WHERE length(run) >= {LEAST_LENGTH} GROUP BY ALL),
hashed AS (SELECT run, c, {crc_of_bytes(_BYTES)} AS h FROM runs, crc_table),
spelt AS (SELECT CASE WHEN h % {EVERY} = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, c FROM hashed),
words AS (SELECT word, sum(c)::BIGINT AS n FROM spelt WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(c) >= {LEAST_COUNT}),
cut AS (SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS less FROM words, unnest(range(1, length(word) + 1)) t(i)),
pairs AS (
  SELECT a.word AS word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.less = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.less = b.word),
best AS (SELECT word, count(*) AS n_near, max(other_n) AS most FROM pairs GROUP BY word),
first AS (SELECT word, min(other) AS form FROM pairs JOIN best USING (word) WHERE other_n = most GROUP BY word),
judged AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 2 * n THEN form END AS form, CASE WHEN most >= 2 * n THEN most END AS form_n
  FROM words LEFT JOIN best USING (word) LEFT JOIN first USING (word)),
chain(word, root) AS (
  SELECT word, word FROM judged
  UNION ALL
  SELECT chain.word, judged.form FROM chain JOIN judged ON judged.word = chain.root WHERE judged.form IS NOT NULL),
ends AS (SELECT chain.word, root FROM chain JOIN judged ON judged.word = chain.root WHERE judged.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM judged JOIN ends USING (word)
"""
