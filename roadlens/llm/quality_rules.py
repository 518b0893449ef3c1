"""Quality by weak supervision, in DataFrame operations only.

Rules vote good, bad or abstain on each text.  Expectation-maximisation over
the counts of vote patterns (at most 3 ** rules rows, whatever the input)
estimates each rule's accuracy and the share of good texts; a text's posterior
probability of being good follows from its votes and decides, instead of all
rules having to pass.

Scale: one scan writes a narrow table of counts per text (arrays never leave a
row, no shuffle); the patterns are one map-side combined aggregate; the
posterior is a column expression.

Repeated three-word windows are found inside the row: window hashes carry
their position in the low bits, sorting brings equal ones together, equal
neighbours are compared word by word, and the positions left are merged.

Defined results: null text counts as empty; a text under MIN_WORDS words or
with more than half of its words in repeated windows fails the base; an empty
table gives an empty result; repeated rows are judged alike; extra columns are
ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import BLANKS

MIN_WORDS = 50
SYMBOLS = r"[#*$%&|<>]"
STEPS = 60


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words
    and the counts that only rules use (n_lines, n_upper, n_distinct, n_ends, n_bars)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).select(
        "doc_id", "text",
        F.array_remove(F.split("text", BLANKS), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    n = F.size("words")
    width = F.greatest(F.lit(1), F.ceil(F.log2((n + 1).cast("double")))).cast("int")  # bits of a position
    hashed = base.select(
        "doc_id", "text", "words", "lines", width.alias("width"),
        F.when(n > 2, F.transform(
            F.slice("words", 1, F.greatest(n - 2, F.lit(0))),
            lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)),
        )).otherwise(F.array().cast("array<long>")).alias("hashes"),
    )
    packed = hashed.select(
        "doc_id", "text", "words", "lines", "width",
        F.sort_array(F.transform("hashes", lambda h, i: F.call_function("shiftleft", F.call_function("shiftright", h, F.col("width")), F.col("width")).bitwiseOR(i.cast("long")))).alias("packed"),
    )

    def same(x: Column, other: Column) -> Column:
        def window(v, k):
            return F.get("words", (v.bitwiseAND(mask) + k).cast("int"))

        mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("width")) - 1
        alike = F.call_function("shiftright", x, F.col("width")) == F.call_function("shiftright", other, F.col("width"))
        return F.coalesce(alike & (window(x, 0) == window(other, 0)) & (window(x, 1) == window(other, 1)) & (window(x, 2) == window(other, 2)), F.lit(False))

    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("width")) - 1
    repeated = F.filter("packed", lambda x, j: same(x, F.get("packed", j + 1)) | same(x, F.get("packed", j - 1)))
    placed = packed.select("doc_id", "text", "words", "lines", F.sort_array(F.transform(repeated, lambda x: x.bitwiseAND(mask))).alias("at"))
    covered = F.aggregate(
        F.transform("at", lambda x, j: F.coalesce(F.least(F.lit(3).cast("long"), F.get("at", j + 1) - x), F.lit(3).cast("long"))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    n = F.size("words").cast("long")
    return placed.select(
        "doc_id", n.alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.length(F.regexp_replace("text", r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        F.regexp_count("text", F.lit(r"[.!?][\x20\x09-\x0D]")).cast("long").alias("n_ends"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>!]{2,}|[|]")).cast("long").alias("n_bars"),
    )


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """Votes: 1 good, -1 bad, 0 abstain."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "word_length": _vote(F.col("word_chars").between(3 * n, 9 * n), (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 14 * n)),
        "symbols": _vote(50 * F.col("n_symbols") <= chars, 15 * F.col("n_symbols") > chars),
        "marks": _vote(20 * F.col("n_bars") <= n, 5 * F.col("n_bars") > n),
        "upper": _vote(6 * F.col("n_upper") <= chars, 3 * F.col("n_upper") > chars),
        "lines": _vote((F.col("n_lines") > 2) & (F.col("n_dup_lines") == 0), 3 * F.col("n_dup_lines") > F.col("n_lines")),
        "repeats": _vote(10 * F.col("n_repeat_words") <= n, 3 * F.col("n_repeat_words") > n),
        "variety": _vote(3 * F.col("n_distinct") >= n, 8 * F.col("n_distinct") < n),
        "sentences": _vote((5 * F.col("n_ends") <= n) & (100 * F.col("n_ends") >= n), 3 * F.col("n_ends") > n),
    }


def estimate(patterns: list[tuple[tuple[int, ...], int]], steps: int = STEPS) -> tuple[float, list[tuple[float, float]]]:
    """(share of good texts, per rule its accuracy on good and on bad texts) by EM
    over vote patterns and their counts.

    Accuracy is the chance of the right vote given that the rule votes;
    abstaining tells nothing.  A rule may see one kind of bad text only, so its
    accuracy on bad texts may be low, but never so low that its votes would
    turn against their meaning.  The start takes a text with any bad vote for
    probably bad.
    """
    m = len(patterns[0][0]) if patterns else 0
    total = sum(c for _, c in patterns)
    prior, accuracy = 0.8, [(0.9, 0.5)] * m
    good = [0.1 if -1 in votes else 0.95 for votes, _ in patterns]
    for _ in range(steps if total else 0):
        prior = min(0.98, max(0.02, sum(g * c for g, (_, c) in zip(good, patterns)) / total))
        for r in range(m):
            seen = {(cls, v): 1.0 if cls == v else 0.5 for cls in (1, -1) for v in (1, -1)}  # a little prior evidence
            for g, (votes, c) in zip(good, patterns):
                if votes[r]:
                    seen[1, votes[r]] += c * g
                    seen[-1, votes[r]] += c * (1 - g)
            on_good = min(0.999, max(0.6, seen[1, 1] / (seen[1, 1] + seen[1, -1])))
            on_bad = min(0.999, max(1 - on_good, seen[-1, -1] / (seen[-1, 1] + seen[-1, -1])))
            accuracy[r] = on_good, on_bad
        good = [_posterior(votes, prior, accuracy) for votes, _ in patterns]
    return prior, accuracy


def evidence(on_good: float, on_bad: float) -> dict[int, float]:
    """Log-odds that a vote adds."""
    return {1: math.log(on_good / (1 - on_bad)), -1: math.log((1 - on_good) / on_bad), 0: 0.0}


def _posterior(votes, prior: float, accuracy: list[tuple[float, float]]) -> float:
    z = math.log(prior / (1 - prior)) + sum(evidence(*a)[v] for v, a in zip(votes, accuracy))
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, the base counts, base_failed, kept, posterior."""
    votes = rules()
    rows = materialise(counts(docs, id_col, text_col).withColumns({f"vote_{k}": v.cast("byte") for k, v in votes.items()}), "quality")
    names = [f"vote_{k}" for k in votes]
    patterns = [(tuple(r[:-1]), r["count"]) for r in rows.groupBy(*names).count().collect()]  # at most 3 ** rules rows
    prior, accuracy = estimate(sorted(patterns))
    logit = F.lit(math.log(prior / (1 - prior)))
    for name, a in zip(names, accuracy):
        adds = evidence(*a)
        logit = logit + F.when(F.col(name) > 0, adds[1]).when(F.col(name) < 0, adds[-1]).otherwise(0.0)
    posterior = 1 / (1 + F.exp(-logit))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & (posterior >= 0.5)).alias("kept"), posterior.alias("posterior"))
