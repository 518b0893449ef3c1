"""op9 against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from roadlens.llm import line_dedup as L


def words(x):
    return re.findall(r"[^\x20\x09-\x0D]+", x)


def without_copies(rows):
    """Links by exact Jaccard over all pairs of lines, one line per component."""
    first, sets, up = {}, {}, {}
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        for n, x in enumerate((t or "").split("\n")):
            if w := words(x):
                key = " ".join(w)
                first.setdefault(key, (i, n))
                sets.setdefault(key, frozenset(key[k:k + 9] for k in range(max(1, len(key) - 8))))
                up.setdefault(key, key)

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    held = defaultdict(list)
    for key, s in sets.items():
        for o, both in Counter(o for x in s for o in held[x]).items():
            if 5 * both >= 4 * (len(s) + len(sets[o]) - both):
                up[find(key)] = find(o)
        for x in s:
            held[x].append(key)
    keep = {}
    for key, at in first.items():
        root = find(key)
        keep[root] = min(keep.get(root, at), at, key=lambda a: (a[0] is None, a[0] or 0, a[1]))
    return sorted(((i, "\n".join(x for n, x in enumerate((t or "").split("\n")) if not words(x) or keep[find(" ".join(words(x)))] == (i, n))) for i, t in rows), key=str)


def kept(df):
    return sorted(((r.doc_id, r.text) for r in L.deduplicated(df).collect()), key=str)


def test_one_changed_word_and_long_words(spark):
    line = "the harvest of the northern valleys was carried over the mountain road before the first snow of that long winter closed every pass between them"
    url = "seen at https://example.org/a/very/long/path/that/goes/on/"
    tail = "of five words or more"
    rows = [(1, line), (2, line.replace("road", "path")), (3, f"{url}{'x' * 60} {tail}"), (4, f"{url}{'y' * 60} {tail}"), (5, "x" * 40 + " " + tail), (6, "x" * 30 + "y" * 10 + " " + tail)]
    want = [(1, line), (2, "")] + rows[2:]
    assert kept(spark.createDataFrame(rows, "doc_id long, text string")) == want == without_copies(rows)


def test_short_and_unspaced_lines(spark):
    script = "".join(chr(0x4E00 + k * 37 % 900) for k in range(120))
    rows = [(1, "Les.\n\nRead more"), (2, "Les.\n \nRead more\nRead less"), (3, script), (4, script[:60] + chr(0x5F00) + script[61:]), (5, "Les"), (6, "12345678a"), (7, "12345678b")]
    want = [(1, "Les.\n\nRead more"), (2, " \nRead less"), (3, script), (4, "")] + rows[4:]
    assert kept(spark.createDataFrame(rows, "doc_id long, text string")) == want == without_copies(rows)


def large_bands():
    """Sixty-word lines: near copies of a passage, chains of edits, and the passage among other words."""
    r = random.Random(8)
    names = ["".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(300)]
    passage, rows = [r.choice(names) for _ in range(60)], []
    line = list(passage)
    for k in range(90):  # each differs in one word from the one before
        line[r.randrange(60)] = r.choice(names)
        rows.append((k, " ".join(line)))
    for k in range(90, 150):
        line = list(passage)
        for _ in range(r.randrange(1, 5)):
            line[r.randrange(60)] = r.choice(names)
        rows.append((k, " ".join(line)))
    for k in range(150, 180):
        rows.append((k, " ".join([r.choice(names) for _ in range(30)] + passage + [r.choice(names) for _ in range(30)])))
    return rows


@pytest.mark.parametrize("small, fine", [(4, 6), (16, 32)])
def test_every_two_lines_of_a_large_band_are_compared(spark, monkeypatch, small, fine):
    monkeypatch.setattr(L, "SMALL", small)
    monkeypatch.setattr(L, "FINE", fine)
    rows = large_bands()
    assert kept(spark.createDataFrame(rows, "doc_id long, text string")) == without_copies(rows)


def test_one_large_band_in_full(spark, monkeypatch):
    """One key for all lines: the links are those of all pairs."""
    monkeypatch.setattr(L, "SMALL", 4)
    monkeypatch.setattr(L, "FINE", 6)
    texts = sorted({t for _, t in large_bands()})
    sets = {k: {t[i:i + 9] for i in range(len(t) - 8)} for k, t in enumerate(texts)}
    up = {k: k for k in sets}

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for a in sets:
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                up[find(a)] = find(b)
    met = spark.createDataFrame([(1, k) for k in sets], "key long, lid long")
    found = L._compared(met, spark.createDataFrame(list(enumerate(texts)), "lid long, line string"), len(sets))
    got = {r.node: r.root for r in L.components(found).collect()}
    want = {k: find(k) for k in sets}
    groups = lambda of: {frozenset(x for x in of if of[x] == v) for v in of.values()}
    assert groups(got) == {g for g in groups(want) if len(g) > 1}


def test_lines_on_data(small):
    assert kept(small) == without_copies([(r.doc_id, r.text) for r in small.collect()])


def test_comparison_and_recall():
    """Verified pairs are those of exact sets; of the pairs at 0.8 to 0.9 nearly all share a band."""
    r = random.Random(3)
    names = ["".join(r.choice("abcdefgh\u00e9\U0001F600") for _ in range(r.randrange(2, 9))) for _ in range(200)]
    lines = ["a", "b", "ab", "123456789", "1234567890", "aaaaaaaaaaaaaaaaaaaaaaaa", "aaaaaaaaaaaa"]
    for _ in range(60):
        line = [r.choice(names) for _ in range(40)]
        for _ in range(5):
            line[r.randrange(40)] = r.choice(names)
            lines.append(" ".join(line))
    sets = [{x[k:k + 9] for k in range(max(1, len(x) - 8))} for x in lines]
    near = np.array([[5 * len(a & b) >= 4 * len(a | b) for b in sets] for a in sets]) & ~np.eye(len(sets), dtype=bool)
    got = L.similar(lines)
    assert ((got & ~np.eye(len(sets), dtype=bool)) == near).all()
    assert all((L.similar([lines[a], lines[b]])[0, 1] == near[a, b]) for a in range(0, 60) for b in range(a))
    keys = [set(k) for k in L.band_keys(lines).tolist()]
    pairs = [(a, b) for a, b in np.argwhere(near) if len(sets[a] & sets[b]) < 0.9 * len(sets[a] | sets[b])]
    assert len(pairs) > 50 and sum(bool(keys[a] & keys[b]) for a, b in pairs) >= 0.99 * len(pairs)


def test_cells_in_stretches(monkeypatch):
    lines = sorted({t for _, t in large_bands()})
    whole = L.similar(lines)
    monkeypatch.setattr(L, "CELLS", 1000)
    assert (L.similar(lines) == whole).all() and whole.any()
