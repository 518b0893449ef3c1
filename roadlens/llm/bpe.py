"""BPE encoding and decoding as streaming transducers.

Encoder: text arrives in pieces of any size and ids leave as soon as they are
stable; memory does not grow with the text.  White space ends a run of words,
so whole words are emitted at once (with a bounded table of recent words).  A
word longer than the buffer is cut inside: ``lookahead`` symbols, computed from
the merge list, are enough to know that earlier tokens cannot change.

Sufficient lookahead.  Merges apply in rank order.  Take two texts that agree
up to a point; call the front the last token border left of which both agree.
A merge (u, v) moves the front by |u| only if it straddles it, and every later
merge (u2, v2) that moves it again has a higher rank and a v2 that starts with
u, for the token at the front starts with u in both texts.  The longest sum of
|u| over such chains bounds the move; one pass over the merge list finds it.

Decoder: an incremental state machine from ids to bytes to text.  As the
vocabulary names no decoder, the library joins token strings by spaces
(``mode="join"``); ``mode="bytes"`` restores the bytes of byte-level tokens and
emits a character once its UTF-8 sequence is complete.

Defined results: null counts as empty (no ids, empty text); strings of special
tokens in a text become those tokens, as in the library; extra columns are
ignored; repeated rows give repeated rows.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, slices

PIECE = 1 << 16      # characters fed at a time
LIMIT = 4096         # characters of a word held back before it is cut inside
RECENT = 200_000     # words remembered per generation (two generations)
END = "</w>"         # fixed value: the vocabulary's mark of a word's end

#: Unicode white space, as the vocabulary's patterns see it.
_SPACE = "\t-\r \x85\xa0" + "".join(map(chr, [0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_SPLIT = re.compile(f"[{_SPACE}]+")
_ODD = re.compile("[\x1c-\x1f]")  # str.split() alone takes these for white space
#: The vocabulary's contractions.
_CONTRACTION = re.compile("'(?:[rv]e|ll|[stmd])", re.IGNORECASE | re.ASCII)
#: A word of plain Latin-1 characters (no apostrophe, no "<") and its runs.
_PLAIN = re.compile("[!-&(-;=-~\xc0-\xd6\xd8-\xf6\xf8-\xff]{1,64}")
_PIECES = re.compile("[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[!-/:-@\\[-`{-~]+")


def byte_letters() -> list[str]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow at 256."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


@lru_cache(maxsize=1)
def composing() -> frozenset[str]:
    """Characters that normalisation may join to what stands before them, marks excepted."""
    second = {chr(x) for x in (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))}
    for cp in range(0x110000):
        parts = unicodedata.decomposition(chr(cp)).split()
        if len(parts) == 2 and parts[0][0] != "<":
            second.add(chr(int(parts[1], 16)))
    return frozenset(second)


def starts_fresh(ch: str) -> bool:
    """Whether normalised text can be cut before ``ch``."""
    return ch < "\x80" or not unicodedata.combining(ch) and ch not in composing() and unicodedata.category(ch) != "Cn"


class Kinds(dict):
    """L letter, N number, W white space, O other, X not in this Python's tables."""

    def __missing__(self, ch: str) -> str:
        c = unicodedata.category(ch)
        self[ch] = "W" if _SPLIT.match(ch) else "X" if c == "Cn" else c[0] if c[0] in "LN" else "O"
        return self[ch]


KIND = Kinds()


class Vocabulary:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.path, self.ids = path, model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks = {m: i for i, m in enumerate(merges)}
        made = {a + b: i for i, (a, b) in enumerate(merges)}
        if len(made) < len(merges) or any(made.get(x, -1) >= i for i, m in enumerate(merges) for x in m):
            raise ValueError("merges must make each token once, from tokens made before")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = re.compile("|".join(map(re.escape, self.special)))
        self.longest_special = max(map(len, self.special), default=1)
        self.letters = byte_letters()
        self.lookahead = sufficient_lookahead(merges)
        self.tokens = [""] * (1 + max(max(self.ids.values()), *self.special.values()))
        for token, i in {**self.ids, **self.special}.items():
            self.tokens[i] = token

    @lru_cache(maxsize=1)  # noqa: B019 - one vocabulary lives as long as its worker
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def sufficient_lookahead(merges: list[tuple[str, str]]) -> int:
    best: dict[str, int] = {}  # left part of a merge -> longest chain that ends with it
    most = 0
    for u, v in merges:
        reach = len(u.removesuffix(END)) + max((best.get(v[:k], 0) for k in range(1, len(v) + 1)), default=0)
        best[u] = max(best.get(u, 0), reach)
        most = max(most, reach)
    return most


def merge(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """Apply merges, lowest rank first and leftmost first."""
    if len(symbols) > 64:
        return _merge_long(symbols, ranks)
    parts, get = list(symbols), ranks.get
    while len(parts) > 1:
        best, at = None, -1
        for i, pair in enumerate(zip(parts, parts[1:])):
            r = get(pair)
            if r is not None and (best is None or r < best):
                best, at = r, i
        if best is None:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


def _merge_long(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """The same with a heap over a linked list."""
    n = len(symbols)
    parts: list[str | None] = list(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := ranks.get((parts[i], parts[i + 1]))) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if parts[i] != a or j >= n or parts[j] != b:
            continue
        parts[i], parts[j] = a + b, None
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for left, right in ((before[i], i), (i, after[i])):
            if left >= 0 and right < n and (r := ranks.get((parts[left], parts[right]))) is not None:
                heapq.heappush(heap, (r, left, parts[left], parts[right]))
    return [p for p in parts if p is not None]


class Encoder:
    """``feed`` and ``finish`` return little-endian unsigned 32-bit ids as bytes."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.reset()

    def reset(self) -> None:
        self.raw, self.run, self.symbols = "", "", []

    def feed(self, text: str) -> bytes:
        self.raw += text
        out = []
        cut = max(self.raw.rfind(" "), self.raw.rfind("\n"))
        if cut >= 0:
            ready, self.raw = self.raw[:cut], self.raw[cut + 1:]
            out.append(self._words(ready))
        while len(self.raw) > LIMIT + 2 * self.vocab.longest_special and (cut := self._cut()):
            ready, self.raw = self.raw[:cut], self.raw[cut:]
            out.append(self._part(ready, False))
        return b"".join(out)

    def finish(self) -> bytes:
        out = self._words(self.raw)
        self.reset()
        return out

    def _words(self, text: str) -> bytes:
        """Ids of text that white space or its end closes."""
        out = []
        if self.run:  # the first word began before
            head = _SPLIT.split(text, maxsplit=1)
            out.append(self._part(head[0], True))
            text = head[1] if len(head) > 1 else ""
        words = _SPLIT.split(text) if _ODD.search(text) else text.split()
        get = self.words.get
        for w in words:
            ids = get(w)
            if ids is None:
                ids = self._new_word(w)
                get = self.words.get
            out.append(ids)
        return b"".join(out)

    def _new_word(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = b"".join(map(self._piece, _PIECES.findall(word.lower()))) if _PLAIN.fullmatch(word) else self._part(word, True)
        if len(self.words) >= RECENT:
            self.older, self.words = self.words, {}
        if len(word) <= 64:
            self.words[word] = ids
        return ids

    def _piece(self, piece: str) -> bytes:
        """Ids of one run of a plain word; the last runs are remembered."""
        ids = self.pieces.get(piece)
        if ids is None:
            symbols = self._letters(piece)
            symbols[-1] += END
            ids = self._ids(merge(symbols, self.vocab.ranks))
            if len(self.pieces) >= RECENT:
                self.pieces = {}
            if len(piece) <= 64:
                self.pieces[piece] = ids
        return ids

    def _cut(self) -> int:
        """Where the waiting text can be cut so that both sides are read as in one piece; 0: nowhere yet."""
        raw, vocab = self.raw, self.vocab
        at = len(raw) - vocab.longest_special
        while at > 0:
            while at > 0 and not starts_fresh(raw[at]):
                at -= 1
            p = raw.rfind("<", max(0, at - vocab.longest_special + 1), at)
            crossing = [m.start() for m in (vocab.special_pattern.match(raw, p) if p >= 0 else None, *(_CONTRACTION.match(raw, q) for q in (at - 2, at - 1) if q >= 0)) if m and m.end() > at]
            if not crossing:
                return at
            at = min(crossing)
        return 0

    def _part(self, text: str, closed: bool) -> bytes:
        """Ids of a part without white space at which it may be cut; ``closed``: the word ends with it."""
        out, at = [], 0
        for m in self.vocab.special_pattern.finditer(text):
            out.append(self._plain(text[at:m.start()], True))
            out.append(array("I", [self.vocab.special[m[0]]]).tobytes())
            at = m.end()
        out.append(self._plain(text[at:], closed))
        return b"".join(out)

    def _plain(self, text: str, closed: bool) -> bytes:
        out: list[bytes] = []
        for run, piece in self._runs(text):
            if self.run and run != self.run:
                out.append(self._close())
            if run == "W":
                continue
            if run in "NC":  # one digit, one contraction: complete as they are
                self.symbols = self._letters(piece)
                out.append(self._close())
                continue
            self.run = run
            self.symbols += self._letters(piece)
            while len(self.symbols) > LIMIT + 2 * self.vocab.lookahead:
                out.append(self._emit_stable())
        if closed and self.run:
            out.append(self._close())
        return b"".join(out)

    def _runs(self, text: str) -> Iterator[tuple[str, str]]:
        """(kind, piece) of the normalised text; a run that began before goes on first."""
        if not text.isascii():
            if any(KIND[c] == "X" for c in text):  # newer than this Python's tables
                yield from self._library_runs(text)
                return
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        at, n = 0, len(text)
        while at < n:
            k = KIND[text[at]]
            if text[at] == "'" and self.run != "O" and (m := _CONTRACTION.match(text, at)):
                yield "C", m[0]
                at = m.end()
                continue
            end = at + 1
            if k in "LOW":
                while end < n and KIND[text[end]] == k:
                    end += 1
            yield k, text[at:end]
            at = end

    def _library_runs(self, text: str) -> Iterator[tuple[str, str]]:
        tool = self.vocab.library()
        back = {c: b for b, c in enumerate(self.vocab.letters)}
        at, text = 0, tool.normalizer.normalize_str(text)
        for token, (a, b) in tool.pre_tokenizer.pre_tokenize_str(text):
            if a > at:
                yield "W", " "
            piece, at = bytes(back[c] for c in token).decode(), b
            yield "L" if self.run == "L" and a == 0 else "O" if self.run == "O" and a == 0 else "C", piece

    def _letters(self, piece: str) -> list[str]:
        letters = self.vocab.letters
        return [letters[b] for b in piece.encode()]

    def _ids(self, tokens: list[str]) -> bytes:
        return array("I", [self.vocab.ids[t] for t in tokens]).tobytes()

    def _close(self) -> bytes:
        symbols, self.symbols, self.run = self.symbols, [], ""
        if not symbols:
            return b""
        symbols[-1] += END
        return self._ids(merge(symbols, self.vocab.ranks))

    def _emit_stable(self) -> bytes:
        """Emit the tokens that no later symbol can change; the last symbol may yet end the word."""
        stable = len(self.symbols) - 1 - self.vocab.lookahead
        tokens, at = [], 0
        for t in merge(self.symbols[:-1], self.vocab.ranks):
            if at + len(t) > stable:
                break
            tokens.append(t)
            at += len(t)
        self.symbols = self.symbols[at:]
        return self._ids(tokens)


class Decoder:
    """Ids to text, piece by piece."""

    def __init__(self, vocab: Vocabulary, mode: str = "join"):
        self.vocab, self.mode = vocab, mode
        self.reset()

    def reset(self) -> None:
        self.begun = False
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: bytes) -> str:
        tokens = list(map(self.vocab.tokens.__getitem__, memoryview(ids).cast("I")))
        if not tokens:
            return ""
        if self.mode == "join":  # token strings are whole characters
            text = " ".join(tokens)
            text, self.begun = (" " + text if self.begun else text), True
            return text
        back = {c: b for b, c in enumerate(self.vocab.letters)}
        data = b"".join(
            t.encode() if t in self.vocab.special else bytes(back[c] for c in t.removesuffix(END)) + b" " * t.endswith(END) for t in tokens)
        return self.state.decode(data)

    def finish(self) -> str:
        text = self.state.decode(b"", final=True)
        self.reset()
        return text


def encoded(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text", extra: list[str] | None = None, mode: str = "join") -> DataFrame:
    """One row per document: doc_id, ids (unsigned 32-bit little-endian bytes), n_tokens,
    ids_sha256, decoded_sha256 and the columns ``extra``."""
    return _transduce(docs, vocab_path, id_col, text_col, mode, with_ids=True, extra=extra or [])


def digests(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text", mode: str = "join") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: nothing of a document is held but its current piece."""
    return _transduce(docs, vocab_path, id_col, text_col, mode, with_ids=False, extra=[])


def _transduce(docs, vocab_path, id_col, text_col, mode, with_ids, extra):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(vocab_path)
        encoder, decoder = Encoder(vocab), Decoder(vocab, mode)
        for batch in slices(batches):
            counts, ids_hex, text_hex, kept = [], [], [], []
            for value in batch.column("text"):
                text, n = value.as_py(), 0
                ids_sum, text_sum, whole = hashlib.sha256(), hashlib.sha256(), []
                for at in range(0, len(text) + 1, PIECE):
                    piece = text[at:at + PIECE]
                    ids = encoder.feed(piece) if at + PIECE <= len(text) else encoder.feed(piece) + encoder.finish()
                    n += len(ids) // 4
                    ids_sum.update(ids)
                    text_sum.update(decoder.feed(ids).encode())
                    if with_ids:
                        whole.append(ids)
                text_sum.update(decoder.finish().encode())
                counts.append(n)
                ids_hex.append(ids_sum.hexdigest())
                text_hex.append(text_sum.hexdigest())
                kept.append(b"".join(whole))
            out = {"doc_id": batch.column("doc_id"), "n_tokens": pa.array(counts, pa.int64()), "ids_sha256": pa.array(ids_hex, pa.string()), "decoded_sha256": pa.array(text_hex, pa.string())}
            if with_ids:
                out["ids"] = pa.array(kept, pa.binary())
            out |= {c: batch.column(c) for c in extra}
            yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    source = id_and_text(docs, id_col, text_col, binary=False) if not extra else docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *extra)
    fields = ["doc_id long", "n_tokens long", "ids_sha256 string", "decoded_sha256 string"] + ["ids binary"] * with_ids
    fields += [f"`{c}` {source.schema[c].dataType.simpleString()}" for c in extra]
    return source.mapInArrow(run, ", ".join(fields))
