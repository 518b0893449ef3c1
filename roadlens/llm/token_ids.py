"""Token ids of whole documents for the materialisation operators, a stretch of texts at a time.

The words of a stretch are split and numbered by Arrow.  Its distinct plain words
are cut into runs, which are looked up in a table, and all runs that it lacks are
merged in one call of the tokenizers library.  Any other word goes through the
streaming encoder.  A document's ids are gathered by word number.
The ids are those of the library on the whole text (white space ends every run,
so words stand alone).

Memory: a long text is read in parts of ``PART`` characters that end at white space,
other texts in stretches of about ``PORTION`` bytes; the tables are emptied at
``KNOWN`` entries, which costs time and never changes ids.

Defined results: a null text counts as empty and has no ids; repeated rows are
separate documents; a null doc_id stays null; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from . import bpe
from .common import id_and_text

PART = 1 << 20     # characters of a text read at a time
PORTION = 4 << 20  # bytes of texts read at a time (a longer one stands alone)
KNOWN = 300_000    # runs, and words that are not plain, remembered
WORDS = 20_000     # distinct words cut into runs at a time
MERGED = 8_000     # runs merged at a time (the library holds far more of a run than its ids)

_RUNS = re.compile(f"{bpe._PIECES.pattern}|\n")
_LETTERS = "[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]"  # any case of the first kind of run
_PLAIN = bpe._PLAIN.pattern.removesuffix("{1,64}")


def id_width(vocab: bpe.Vocabulary, extra: int = 2) -> int:
    """Bytes an id takes, ``extra`` ids past the vocabulary included."""
    return 2 if len(vocab.tokens) + extra <= 1 << 16 else 4


def parts(text: str) -> Iterator[str]:
    """``text`` cut at white space (a blank or a line feed) into parts of about ``PART`` characters."""
    at = 0
    while len(text) - at > PART:
        cut = max(text.rfind(" ", at, at + PART), text.rfind("\n", at, at + PART))
        if cut < 0:  # one long word: to its end
            cut = min((c for c in (text.find(" ", at + PART), text.find("\n", at + PART)) if c >= 0), default=len(text))
        yield text[at:cut]
        at = cut + 1
    yield text[at:]


class BatchEncoder:
    """``encode`` gives the ids of texts as little-endian bytes of ``width`` each."""

    def __init__(self, vocab: bpe.Vocabulary, width: int):
        from tokenizers import Tokenizer, pre_tokenizers

        self.vocab, self.dtype = vocab, np.dtype(f"<u{width}")
        self.one = bpe.Encoder(vocab)
        # the library reads letters that stand for bytes, as its own byte-level step gives them
        self.letters = str.maketrans({chr(b): c for b, c in enumerate(vocab.letters) if chr(b) != " "})
        self.runs = Tokenizer(vocab.library().model)  # merges only: words come as runs of letters
        self.runs.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.ends = np.array([t.endswith(bpe.END) for t in vocab.tokens])
        self.words: dict[str, bytes] = {}  # that are not plain
        self.known: dict[str, bytes] = {}  # by run

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.column(pa.array(texts, pa.string())).to_pylist()

    def column(self, texts: pa.Array) -> pa.Array:
        """The ids of each text of a column without nulls, as binary."""
        odd = pc.any(pc.match_substring_regex(texts, bpe._ODD.pattern)).as_py()  # Arrow takes these for white space
        split = pc.split_pattern_regex(texts, bpe._SPLIT.pattern) if odd else pc.utf8_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()  # with empty words where white space begins or ends a text
        data, starts, sizes = self._words(coded.dictionary)
        at = coded.indices.to_numpy()
        counts = sizes[at]
        ends = np.concatenate([[0], np.cumsum(counts)])
        data = data[np.arange(ends[-1]) + np.repeat(starts[at] - ends[:-1], counts)]
        bounds = ends[np.concatenate([[0], np.cumsum(split.value_lengths().to_numpy())])] * self.dtype.itemsize
        return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)])

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where those of each word start and how many they are."""
        found = [self._portion(words.slice(at, WORDS)) for at in range(0, max(1, len(words)), WORDS)]
        data, starts, sizes = zip(*found)
        before = np.cumsum([0, *map(len, data[:-1])])
        return np.concatenate(data), np.concatenate([s + n for s, n in zip(starts, before)]), np.concatenate(sizes)

    def _portion(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        plain = pc.and_(pc.match_substring_regex(words, f"^{_PLAIN}*$"), pc.less_equal(pc.utf8_length(words), 64)).to_numpy(zero_copy_only=False)
        one = plain & pc.match_substring_regex(words, f"^{_LETTERS}+$").to_numpy(zero_copy_only=False)  # a single run
        words = words.to_numpy(zero_copy_only=False)
        alone = "\n".join(words[one].tolist()).lower().split("\n") if one.any() else []
        more, odd = np.flatnonzero(plain & ~one), np.flatnonzero(~plain)
        pieces = _RUNS.findall("\n".join([*words[more].tolist(), ""]).lower())  # a line feed ends each word
        if len(self.known) > KNOWN:
            self.known = {}
        new = list(set(alone).union(pieces).difference(self.known, "\n"))
        for at in range(0, len(new), MERGED):
            self._merge(new[at:at + MERGED])
        self.known["\n"] = b""
        ids = [*map(self.known.__getitem__, alone), *map(self.known.__getitem__, pieces)]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // self.dtype.itemsize
        ends, sizes, starts = np.cumsum(lengths), np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        sizes[one], starts[one] = lengths[:len(alone)], ends[:len(alone)] - lengths[:len(alone)]
        marks = np.flatnonzero(lengths == 0)  # every run has an id
        first = ends[len(alone) - 1] if alone else 0
        starts[more] = np.concatenate([[first], ends[marks]])[:-1]
        sizes[more] = ends[marks] - starts[more]
        total = ends[-1] if len(ids) else 0
        for k in odd.tolist():
            ids.append(self._odd(words[k]))
            starts[k], sizes[k] = total, len(ids[-1]) // self.dtype.itemsize
            total += sizes[k]
        return np.frombuffer(b"".join(ids), self.dtype), starts, sizes

    def _odd(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            if len(self.words) > KNOWN:
                self.words = {}
            ids = self.words[word] = np.frombuffer(self.one.feed(word) + self.one.finish(), "<u4").astype(self.dtype).tobytes()
        return ids

    def _merge(self, runs: list[str]) -> None:
        letters = " ".join(runs).encode().decode("latin-1").translate(self.letters)
        ids = np.array(self.runs.encode_batch_fast([letters], add_special_tokens=False)[0].ids, dtype=np.int64)
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) != len(runs):
            raise RuntimeError(f"{len(runs)} runs gave {len(cuts)} ends")
        data, at = ids.astype(self.dtype).tobytes(), 0
        for run, cut in zip(runs, (cuts * self.dtype.itemsize).tolist()):
            self.known[run] = data[at:cut]
            at = cut


def _stretches(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first, number) of neighbours whose sizes add up to ``PORTION`` at most, or of a larger one."""
    ends, at = np.cumsum(sizes), 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] - sizes[at] + PORTION, "right")))
        yield at, to - at
        at = to


def token_ids(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): little-endian ids of ``id_width`` bytes, one row per document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = bpe.vocabulary(vocab_path)
        tool = BatchEncoder(vocab, id_width(vocab))
        for batch in batches:
            for at, n in _stretches(pc.binary_length(batch.column("text")).to_numpy().astype(np.int64)):
                part = batch.slice(at, n)
                texts = part.column("text")
                long = pc.greater(pc.utf8_length(texts), PART)
                ids = tool.column(pc.if_else(long, "", texts))
                if pc.any(long).as_py():
                    ids = pa.array([b"".join(tool.encode([p])[0] for p in parts(t.as_py())) if far else own for t, far, own in zip(texts, long.to_pylist(), ids.to_pylist())], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids], names=["doc_id", "ids"])

    return id_and_text(docs, id_col, text_col, binary=False).mapInArrow(run, "doc_id long, ids binary")
