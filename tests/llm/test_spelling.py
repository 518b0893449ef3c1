"""Spelling variants against a plain version that compares every two words."""

import random
import re
import zlib
from collections import Counter
from itertools import combinations

from pyspark.sql import functions as F

from roadlens.llm import spelling as S


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(a == b[:i] + b[i + 1:] for i in range(len(b)))


def plain(rows, least_length=5, least_count=3, every=97):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            c = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if c % every == 0:
                run = run[:c % len(run)] + run[c % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}
    others = {w: [] for w in words}
    for a, b in combinations(words, 2):
        if near(a, b):
            others[a].append(b)
            others[b].append(a)
    form = {}
    for w, n in words.items():
        best = min(others[w], key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(others[w]), words.get(form[w])))
    return sorted(out)


def run(df, **kw):
    return sorted(tuple(r) for r in S.variants(df, **kw).select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_like_every_two_words_compared(spark):
    r = random.Random(3)
    base = ["anthem", "wälder", "strasse", "ÿouléx", "banana", "x×y÷zz", "Ärzte", "letter"]
    rows = []
    for i in range(400):
        words = []
        for _ in range(30):
            w = list(r.choice(base))
            for _ in range(r.choice([0, 0, 0, 1, 1, 2])):
                at = r.randrange(len(w))
                w[at:at + r.choice([0, 1])] = r.choice(["", "a", "é", "T", "nn"])
            words.append("".join(w))
        rows.append((i, r.choice([" ", "1", "-", "\n", "Ā"]).join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = plain(rows)
    assert run(df) == want
    assert any(w[1] is not None for w in want) and any(w[1] is not None and w[1] != w[2] for w in want)  # forms and chains


def test_odd_rows(odd, odd_rows, empty):
    clash = odd.withColumns({c: F.lit(1) for c in ("word", "run", "sig", "sketch", "h", "form", "id", "moved", "next")})
    assert run(clash, every=3) == plain(odd_rows, every=3)
    assert run(empty) == []


def test_short_words(spark):
    rows = [(i, "ab abc bc b a abd ac acb é éa") for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for least in (1, 2, 3):
        assert run(df, least_length=least, every=5) == plain(rows, least, every=5)


def test_a_word_of_one_letter_many_times(spark):
    long = "a" * 30_000
    rows = [(i, f"{long} {long}a {long[:-5]}b") for i in range(4)]
    assert run(spark.createDataFrame(rows, "doc_id long, text string"), every=10**9) == plain(rows, every=10**9)


def test_chains_are_followed_to_their_end(spark):
    chain = [("w%04d" % i, "w%04d" % (i + 1)) for i in range(100)] + [("x", "w0050")]
    got = {r["word"]: r["root"] for r in S.roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert set(got.values()) == {"w0100"} and len(got) == 101


def test_near_words_always_share_a_signature():
    r = random.Random(4)
    signer = S.Signer({}, 2)
    for _ in range(500):
        a = "".join(r.choice("abcdeé") for _ in range(r.randint(5, 12)))
        at = r.randrange(len(a))
        b = a[:at] + r.choice(["", "x", a[at] + "y"]) + a[at + 1:]
        sigs, sketch = signer.of([a, b])
        assert set(sigs[0]) & set(sigs[1])
        differ = int(sketch[0] ^ sketch[1]) & S._WORD64
        assert bin(differ & 0xFFFFFFFF).count("1") <= 2 and (differ >> 48 == 0 or differ >> 32 & 0xFFFF == 0)


def test_no_table_goes_through_the_driver(spark, monkeypatch):
    """Spark takes these tables for far smaller than they are: no join may broadcast one."""
    written, write = [], S.materialise
    monkeypatch.setattr(S, "materialise", lambda df, name: written.append(df) or write(df, name))
    rows = [(i, "waters water watr harbour harbor harbours") for i in range(9)] + [(i, "water harbour") for i in range(30)]
    df = S.variants(spark.createDataFrame(rows, "doc_id long, text string"), every=10**9)
    plans = [x._jdf.queryExecution().executedPlan().toString() for x in [*written, df]]
    assert sum("SortMergeJoin" in x for x in plans) >= 4 and not any("Broadcast" in x for x in plans)
    assert sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()) == plain(rows, every=10**9)
