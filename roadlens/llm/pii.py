"""Personal data: exact patterns plus a character BiLSTM with CRF transitions.

Base spans (email, ip, card, phone) come from scans that are linear in the
text.  The method adds spans: a bidirectional LSTM over characters, trained in
numpy on labelled spans, gives tag scores; a linear-chain CRF ties the tags of
neighbours.  Texts are read whole in overlapping windows; where windows
overlap their scores are averaged by distance from the window's edge, and one
Viterbi pass per region decides globally, so no window border cuts a span.
Every span that passes the exact check of its kind holds a digit, "@" or a
written-out one ("(at)", "[at]"), so regions open at these; a region goes CONTEXT
characters beyond them, and at least over the whole name and host around an "@".
An added span must pass the exact check of its kind and touch no base span.

Training: the labelled spans are the base spans of about ``sample_rows`` rows
chosen by the hash of doc_id, at most ``sample`` windows with and as many
without a span, plus rewritten copies of the spans (other separators, without
country code, written-out "@").  Both bounds are parameters.

Defined results: null text counts as empty (no spans); offsets are code points,
end exclusive; repeated rows give repeated rows; without any labelled span the
base spans are the result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import id_and_text, slices

KINDS = ("email", "ip", "card", "phone")
CONTEXT = 24
WINDOW = 64
STRIDE = 32
SAMPLE = 600
SAMPLE_ROWS = 20_000
HIDDEN = 16
EMBED = 12
EPOCHS = 10
COPIES = 3  # written-out copies of a labelled address
N_TAGS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind

# the patterns of the base contract; a lookbehind or a possessive run keeps each scan linear
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_AT = r"(?:@|[(\[] ?at ?[)\]])"
_DOT = r"(?:\.| dot | ?(?:\[\.\]|\(dot\)|\[dot\]) ?)"
_HOST = rf"[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)"
_TRIGGER = re.compile(r"[0-9@]+|[(\[] ?at ?[)\]]")
_AFTER = re.compile(rf" ?{_HOST}*+")
_WRITTEN = re.compile(rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?{_AT} ?{_HOST}++")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        x = int(ch)
        if i % 2:
            x = x * 2 - 9 * (x > 4)
        total += x
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def base_spans(text: str) -> list[Span]:
    """The base spans of a text, by start, then kind."""
    out: list[Span] = []
    at, end = text.find("@"), 0
    while at >= 0:  # an address can only surround its "@"
        if m := _DOMAIN.match(text, at + 1):
            start = at
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                out.append(("email", start, m.end()))
                end = m.end()
        at = text.find("@", max(at + 1, end))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(d := x.lstrip("0")) <= 3 and int(d or "0") <= 255 for x in m[0].split(".")):
                out.append(("ip", m.start(), m.end()))
        for m in _CARD.finditer(text):
            if 12 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                out.append(("card", m.start(), m.end()))
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                out.append(("phone", m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


# ---- characters and regions -------------------------------------------------

_LETTER, _OTHER = 128, 129
N_CHARS = 131  # ASCII, letters beyond it, others, padding
PAD = 130


def char_ids(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    return np.where(codes < 128, codes, np.where(codes < 0x2000, _LETTER, _OTHER))


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches within CONTEXT of a trigger, and over the whole address around it, merged, in order."""
    out: list[tuple[int, int]] = []
    for m in _TRIGGER.finditer(text):
        a, b = m.span()
        if not m[0].isdigit():
            a -= a > 0 and text[a - 1] == " "
            while a > 0 and text[a - 1] in _LOCAL:
                a -= 1
            if after := _AFTER.match(text, b):
                b = after.end()
        a, b = max(0, min(m.start() - CONTEXT, a - 1)), min(len(text), max(m.end() + CONTEXT, b + 1))
        while out and a <= out[-1][1]:
            a, b = min(a, out[-1][0]), max(b, out[-1][1])
            out.pop()
        out.append((a, b))
    return out


# ---- the network --------------------------------------------------------------

def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _lstm(x, w, u, b):
    """States of an LSTM over x (time, batch, in) and what its gradient needs."""
    steps, n, h = x.shape[0], x.shape[1], u.shape[0]
    gates = x @ w + b
    hidden, cell = np.zeros((n, h), x.dtype), np.zeros((n, h), x.dtype)
    out, kept = np.empty((steps, n, h), x.dtype), []
    for t in range(steps):
        z = gates[t] + hidden @ u
        s = _sigmoid(z[:, :3 * h])
        i, f, o, g = s[:, :h], s[:, h:2 * h], s[:, 2 * h:], np.tanh(z[:, 3 * h:])
        before = cell
        cell = f * cell + i * g
        tc = np.tanh(cell)
        kept.append((i, f, o, g, before, tc, hidden))
        hidden = o * tc
        out[t] = hidden
    return out, kept


def _lstm_gradient(x, w, u, d_out, kept):
    steps, n, h = d_out.shape
    dz_all = np.empty((steps, n, 4 * h), x.dtype)
    du, dh, dc = np.zeros_like(u), np.zeros((n, h), x.dtype), np.zeros((n, h), x.dtype)
    for t in range(steps - 1, -1, -1):
        i, f, o, g, before, tc, prev = kept[t]
        dh = dh + d_out[t]
        dc = dc + dh * o * (1 - tc * tc)
        dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
        dz_all[t] = dz
        du += prev.T @ dz
        dh, dc = dz @ u.T, dc * f
    flat = dz_all.reshape(-1, 4 * h)
    return dz_all @ w.T, x.reshape(-1, x.shape[2]).T @ flat, du, flat.sum(axis=0)


def allowed() -> np.ndarray:
    """Transitions that BIO tags may take (from, to); tag 2k+1 begins kind k, 2k+2 goes on."""
    ok = np.ones((N_TAGS, N_TAGS), bool)
    for to in range(2, N_TAGS, 2):
        ok[:, to] = False
        ok[[to - 1, to], to] = True
    return ok


_BAN = np.where(allowed(), 0.0, -1e4).astype(np.float32)
_BAN_START = np.array([-1e4 if t and t % 2 == 0 else 0.0 for t in range(N_TAGS)], np.float32)


@dataclass
class Tagger:
    params: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, seed: int = 11) -> Tagger:
        draw = np.random.default_rng(seed)

        def make(*shape, scale=0.2):
            return (draw.standard_normal(shape) * scale).astype(np.float32)

        p = {"embed": make(N_CHARS, EMBED), "out": make(2 * HIDDEN, N_TAGS), "out_b": np.zeros(N_TAGS, np.float32), "trans": np.zeros((N_TAGS, N_TAGS), np.float32)}
        for side in ("f", "b"):
            p |= {f"w{side}": make(EMBED, 4 * HIDDEN), f"u{side}": make(HIDDEN, 4 * HIDDEN), f"c{side}": np.zeros(4 * HIDDEN, np.float32)}
            p[f"c{side}"][HIDDEN:2 * HIDDEN] = 1.0  # remember at first
        return cls(p)

    def scores(self, ids: np.ndarray, keep: bool = False):
        """Tag scores (batch, time, tags) of windows of character ids (batch, time)."""
        p, x = self.params, self.params["embed"][ids.T]
        ahead, kept_f = _lstm(x, p["wf"], p["uf"], p["cf"])
        back, kept_b = _lstm(x[::-1], p["wb"], p["ub"], p["cb"])
        states = np.concatenate([ahead, back[::-1]], axis=2)
        out = (states @ p["out"] + p["out_b"]).transpose(1, 0, 2)
        return (out, (x, states, kept_f, kept_b)) if keep else out

    def gradient(self, ids: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss (negative log-likelihood of the tag paths, a mean) and its gradient."""
        p = self.params
        emit, (x, states, kept_f, kept_b) = self.scores(ids, keep=True)
        n, steps, _ = emit.shape
        trans = p["trans"] + _BAN
        # forward and backward sums of the CRF, in logs
        alpha, beta = np.empty_like(emit), np.zeros_like(emit)
        alpha[:, 0] = emit[:, 0] + _BAN_START
        for t in range(1, steps):
            alpha[:, t] = emit[:, t] + _log_sum(alpha[:, t - 1][:, :, None] + trans, axis=1)
        for t in range(steps - 2, -1, -1):
            beta[:, t] = _log_sum(trans + (emit[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
        z = _log_sum(alpha[:, -1], axis=1)
        d_emit = np.exp(alpha + beta - z[:, None, None])
        d_trans = np.zeros_like(trans)
        for t in range(1, steps):
            pair = alpha[:, t - 1][:, :, None] + trans + (emit[:, t] + beta[:, t])[:, None, :] - z[:, None, None]
            d_trans += np.exp(pair).sum(axis=0)
        rows = np.arange(n)[:, None]
        path = emit[rows, np.arange(steps)[None, :], tags].sum(axis=1) + trans[tags[:, :-1], tags[:, 1:]].sum(axis=1)
        d_emit[rows, np.arange(steps)[None, :], tags] -= 1
        np.add.at(d_trans, (tags[:, :-1], tags[:, 1:]), -1)
        d_out = (d_emit / n).transpose(1, 0, 2).astype(np.float32)
        g = {"trans": d_trans / n, "out_b": d_out.sum(axis=(0, 1)), "out": states.reshape(-1, 2 * HIDDEN).T @ d_out.reshape(-1, N_TAGS)}
        d_states = d_out @ p["out"].T
        dx_f, g["wf"], g["uf"], g["cf"] = _lstm_gradient(x, p["wf"], p["uf"], d_states[:, :, :HIDDEN], kept_f)
        dx_b, g["wb"], g["ub"], g["cb"] = _lstm_gradient(x[::-1], p["wb"], p["ub"], d_states[::-1, :, HIDDEN:], kept_b)
        g["embed"] = np.zeros_like(p["embed"])
        np.add.at(g["embed"], ids.T, dx_f + dx_b[::-1])
        return float((z - path).mean()), g

    def decode(self, emit: list[np.ndarray]) -> list[np.ndarray]:
        """Best tag path of each region (time, tags), regions of like length at once."""
        trans = self.params["trans"] + _BAN
        out: list[np.ndarray] = [np.zeros(0, int)] * len(emit)
        order = sorted(range(len(emit)), key=lambda r: len(emit[r]))
        for at in range(0, len(order), 128):
            part = order[at:at + 128]
            steps = max(len(emit[r]) for r in part)
            grid = np.zeros((len(part), steps, N_TAGS), np.float32)
            for k, r in enumerate(part):
                grid[k, :len(emit[r])] = emit[r]
                grid[k, len(emit[r]):, 1:] = -1e4  # nothing begins in the padding
            best, back = grid[:, 0] + _BAN_START, np.zeros((len(part), steps, N_TAGS), np.int8)
            for t in range(1, steps):
                both = best[:, :, None] + trans
                back[:, t] = both.argmax(axis=1)
                best = both.max(axis=1) + grid[:, t]
            tag = best.argmax(axis=1)
            path = np.empty((len(part), steps), int)
            for t in range(steps - 1, -1, -1):
                path[:, t] = tag
                tag = back[np.arange(len(part)), t, tag]
            for k, r in enumerate(part):
                out[r] = path[k, :len(emit[r])]
        return out


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def _variants(kind: str, text: str, draw: np.random.Generator) -> str:
    """A labelled span in another way of writing."""
    if kind == "email":
        name, host = text.rsplit("@", 1)
        return name + draw.choice(["@", " @ ", "(at)", "[at]", " at "]) + host
    if kind == "phone":
        digits = _digits(text)
        sep = draw.choice(["-", ".", " ", "/"])
        own = digits[-10:]
        body = draw.choice([f"({own[:3]}) {own[3:6]}-{own[6:]}", sep.join([own[:3], own[3:6], own[6:]]), f"({own[:3]}){sep}{own[3:6]}{sep}{own[6:]}"])
        return draw.choice(["", "", "00" + digits[:-10] + sep, digits[:-10] + sep if digits[:-10] else ""]) + body
    if kind == "card":
        digits = _digits(text)
        return draw.choice(["-", " ", ".", "/"]).join(digits[i:i + 4] for i in range(0, len(digits), 4))
    return text.replace(".", draw.choice([".", " . ", "[.]"]))


def _written_out(text: str, draw: np.random.Generator) -> str:
    """An address with its "@" written out, and its dots in half of them."""
    name, host = text.rsplit("@", 1)
    dot = draw.choice([".", ".", ".", " dot ", "(dot)", " (dot) "])
    return name + draw.choice(["(at)", " (at) ", "[at]", " [at] ", " @ "]) + host.replace(".", dot)


def examples(windows: list[tuple[str, list[Span]]], seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Character ids and tags, WINDOW long, of labelled windows and of rewritten ones."""
    draw, ids, tags = np.random.default_rng(seed), [], []
    out = np.random.default_rng(seed + 1)

    def add(text: str, spans: list[Span]):
        row, tag = np.full(WINDOW, PAD), np.zeros(WINDOW, int)
        known = char_ids(text)[:WINDOW]
        row[:len(known)] = known
        for kind, a, b in spans:
            k = 1 + 2 * KINDS.index(kind)
            if b <= WINDOW:
                tag[a:b] = k + 1
                tag[a] = k
        ids.append(row)
        tags.append(tag)

    for text, spans in windows:
        add(text, spans)
        if len(spans) == 1:
            kind, a, b = spans[0]
            new = _variants(kind, text[a:b], draw)
            add(text[:a] + new + text[b:], [(kind, a, a + len(new))])
            if kind == "email":
                for new in (_written_out(text[a:b], out) for _ in range(COPIES)):
                    if a + len(new) <= WINDOW:
                        add(text[:a] + new + text[b:], [(kind, a, a + len(new))])
    return np.array(ids).reshape(-1, WINDOW), np.array(tags).reshape(-1, WINDOW)


def train(ids: np.ndarray, tags: np.ndarray, epochs: int = EPOCHS, batch: int = 64, rate: float = 0.02, seed: int = 3) -> Tagger:
    """Adam over shuffled batches."""
    tagger, draw = Tagger.fresh(), np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in tagger.params.items()}
    second = {k: np.zeros_like(v) for k, v in tagger.params.items()}
    step, total = 0, max(1, epochs * -(-len(ids) // batch))
    for _ in range(epochs):
        order = draw.permutation(len(ids))
        for at in range(0, len(order), batch):
            part = order[at:at + batch]
            _, g = tagger.gradient(ids[part], tags[part])
            size = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
            step += 1
            now = rate * (1 - 0.9 * step / total)
            for k, v in g.items():
                v = v * min(1.0, 5.0 / (size + 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * v
                second[k] = 0.99 * second[k] + 0.01 * v * v
                tagger.params[k] = (tagger.params[k] - now * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    return tagger


# ---- reading texts ------------------------------------------------------------

def region_scores(tagger: Tagger, parts: list[np.ndarray], batch: int = 512) -> list[np.ndarray]:
    """Tag scores of whole regions, overlapping windows reconciled: each position
    is the mean of its windows, weighted by the distance to the window's edge."""
    sums = [np.zeros((len(p), N_TAGS), np.float32) for p in parts]
    weights = [np.zeros((len(p), 1), np.float32) for p in parts]
    todo = [(r, at) for r, p in enumerate(parts) for at in range(0, max(1, len(p) - WINDOW + STRIDE), STRIDE)]
    ramp = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(np.float32)[:, None]
    for k in range(0, len(todo), batch):
        some = todo[k:k + batch]
        grid = np.full((len(some), WINDOW), PAD)
        for row, (r, at) in zip(grid, some):
            piece = parts[r][at:at + WINDOW]
            row[:len(piece)] = piece
        for got, (r, at) in zip(tagger.scores(grid), some):
            n = min(WINDOW, len(parts[r]) - at)
            sums[r][at:at + n] += got[:n] * ramp[:n]
            weights[r][at:at + n] += ramp[:n]
    return [s / w for s, w in zip(sums, weights)]


def holds(kind: str, text: str) -> bool:
    """Exact check of an added span."""
    digits = _digits(text)
    if kind == "email":
        return _WRITTEN.fullmatch(text) is not None
    if kind == "ip":
        return re.fullmatch(r"[0-9]{1,3}(?:(?:\.| \. |\[\.\])[0-9]{1,3}){3}", text) is not None and all(int(x) <= 255 for x in re.findall(r"[0-9]+", text))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits) and re.fullmatch(r"[0-9]{4}(?:[ ./-][0-9]{2,6}){2,4}", text) is not None
    return 9 <= len(digits) <= 15 and re.fullmatch(r"(?:\+?[0-9]{1,5}[ ./-]?)?(?:\([0-9]{2,4}\)[ ./-]?|[0-9]{2,4}[ ./-])[0-9]{2,4}(?:[ ./-][0-9]{2,5}){1,3}", text) is not None


def all_spans(texts: list[str], tagger: Tagger | None) -> tuple[list[list[Span]], list[list[Span]]]:
    """(base spans, base and added spans) of each text."""
    base = [base_spans(t) for t in texts]
    if tagger is None:
        return base, base
    where = [(k, a, b) for k, t in enumerate(texts) for a, b in regions(t)]
    emit = region_scores(tagger, [char_ids(texts[k][a:b]) for k, a, b in where])
    both = [list(s) for s in base]
    for (k, a, b), path in zip(where, tagger.decode(emit)):
        starts = np.flatnonzero(path % 2 == 1)
        for s in starts.tolist():
            e = s + 1
            while e < len(path) and path[e] == path[s] + 1:
                e += 1
            kind, text = KINDS[path[s] // 2], texts[k]
            lo, hi = a + s, a + e
            while lo < hi and text[lo] in " .,;:-/":
                lo += 1
            while hi > lo and text[hi - 1] in " .,;:-/(":
                hi -= 1
            if kind == "email":  # the whole address that the tagged part belongs to
                lo, hi = next((m.span() for m in _WRITTEN.finditer(text, a, b) if m.start() < hi and m.end() > lo), (lo, hi))
            edge = text[lo - 1:lo] + text[hi:hi + 1]
            clear = all(hi <= x or lo >= y for _, x, y in base[k])
            if clear and not any(c.isalnum() or c == "_" for c in edge) and holds(kind, text[lo:hi]) and (kind, lo, hi) not in both[k]:
                both[k].append((kind, lo, hi))
    return base, [sorted(s, key=lambda x: (x[1], KINDS.index(x[0]))) for s in both]


def _labelled(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """At most ``most`` windows with and ``most`` without spans, those of smallest digest."""
    held: dict[bool, list] = {True: [], False: []}
    for batch in slices(batches):
        for value in batch.column("text"):
            text = value.as_py()
            spans = base_spans(text)
            for a, b in regions(text):
                a = max(a, min((x for _, x, _ in spans if a <= x < b), default=a) - CONTEXT)
                window = text[a:a + WINDOW]
                inside = [(k, x - a, y - a) for k, x, y in spans if a <= x and y <= a + WINDOW]
                if any(x < a + WINDOW and y > a and not (a <= x and y <= a + WINDOW) for _, x, y in spans) or any(p[2] > q[1] for p, q in zip(inside, inside[1:])):
                    continue  # a span is cut, or two overlap: not one clean path of tags
                order = -int.from_bytes(hashlib.md5(window.encode()).digest()[:7], "big")
                heap = held[bool(inside)]
                item = (order, window, written(inside))
                if len(heap) < most:
                    heapq.heappush(heap, item)
                elif item > heap[0]:
                    heapq.heapreplace(heap, item)
    rows = [(bool(k), -o, w, s) for k, heap in held.items() for o, w, s in heap]
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.bool_()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.string()), pa.array([r[3] for r in rows], pa.string())],
        names=["has", "digest", "window", "spans"])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, sample_rows: int = SAMPLE_ROWS, epochs: int = EPOCHS) -> Tagger | None:
    """A tagger from the base spans of a bounded sample; None without any."""
    every = max(1, -(-docs.count() // sample_rows))
    source = id_and_text(docs, id_col, text_col, binary=False)
    some = source.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0) if every > 1 else source
    found = materialise(some.mapInArrow(lambda b: _labelled(b, sample), "has boolean, digest long, window string, spans string"), "labelled")
    windows: list[tuple[str, list[Span]]] = []
    for has in (True, False):
        for r in found.where(F.col("has") == has).select("digest", "window", "spans").distinct().orderBy("digest", "window").limit(sample).collect():
            spans = [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in r["spans"].split(",") if x)]
            windows.append((r["window"], spans))
    if not any(s for _, s in windows):
        return None
    return train(*examples(windows), epochs=epochs)


def detected(docs: DataFrame, tagger: Tagger | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            base, both = all_spans([t.as_py() for t in batch.column("text")], tagger)
            counts = [pa.array([sum(s[0] == k for s in row) for row in base], pa.int64()) for k in KINDS]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *counts, pa.array([hashlib.sha256(written(s).encode()).hexdigest() for s in base], pa.string()), pa.array(list(map(written, both)), pa.string())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    fields = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return id_and_text(docs, id_col, text_col, binary=False).mapInArrow(run, fields)
