import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from roadlens.llm import bpe as B

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def encode(text, piece):
    e = B.Encoder(B.vocabulary(PATH))
    out = b"".join(e.feed(text[i:i + piece]) for i in range(0, len(text), piece)) + e.finish()
    return np.frombuffer(out, dtype="<u4").tolist()


def test_like_the_library_whatever_the_pieces(library):
    r = random.Random(1)
    letters = list("abcdeEfgh'srvl!?.<|>0129 \n\té́Σ日本ガ각각\U0001F600‍\x1c\x85 ǘñß") + ["<|endoftext|>", "'re", "'LL", " the ", "ing"]
    texts = ["", "  ", "Hello World! it's <|endoftext|> éΣ", "x'''s'''re", "\x1c a\x1db", "İ ᲉꟋ x", "a b　c d e"]
    texts += ["".join(r.choice(letters) for _ in range(r.randint(1, 60))) for _ in range(600)]
    for t in texts:
        want = library.encode(t, add_special_tokens=False).ids
        for piece in (1 << 16, 7, 1):
            assert encode(t, piece) == want, (t, piece)


def test_words_longer_than_the_buffer(library, monkeypatch):
    monkeypatch.setattr(B, "LIMIT", 50)
    r = random.Random(2)
    mixed = list("abcdeEfgh'srvl!?.é́Σ日本각") + ["<|endoftext|>", "'re", "the", "ing", "tion"]
    for k in range(30):
        t = "".join(r.choice(mixed if k % 2 else list("thingaeou") + ["the", "ing"]) for _ in range(r.randint(500, 6000)))
        for piece in (1 << 16, 333):
            assert encode(t, piece) == library.encode(t, add_special_tokens=False).ids


def test_symbols_held_stay_few(monkeypatch):
    vocab, most = B.vocabulary(PATH), 0
    e = B.Encoder(vocab)
    for _ in range(200):
        e.feed("thingoftheword" * 40)
        most = max(most, len(e.symbols) + len(e.raw))
    assert most < 4 * B.LIMIT + 4 * vocab.lookahead


def test_lookahead_is_sufficient():
    """Encodings of extensions agree before the last `lookahead` symbols, on a tiny merge list."""
    merges = [("a", "b"), ("c", "ab"), ("b", "c"), ("ab", "ab"), ("cab", "bc"), ("a", "a")]
    ranks, bound, r = {m: i for i, m in enumerate(merges)}, B.sufficient_lookahead(merges), random.Random(9)
    for _ in range(3000):
        head = [r.choice("abc") for _ in range(r.randint(1, 25))]
        cuts = []
        for _ in range(2):
            at, borders = 0, set()
            for t in B.merge(head + [r.choice("abc") for _ in range(r.randint(0, 10))], ranks):
                at += len(t)
                borders.add(at)
            cuts.append({b for b in borders if b <= len(head) - bound})
        assert cuts[0] == cuts[1]


def test_decoder_is_incremental(library):
    ids = library.encode("Größe, naïve 日本語 it's <|endoftext|> fin.", add_special_tokens=False).ids
    data, vocab = np.array(ids, dtype="<u4").tobytes(), B.vocabulary(PATH)
    d = B.Decoder(vocab)
    assert "".join(d.feed(data[i:i + 4]) for i in range(0, len(data), 4)) + d.finish() == library.decode(ids, skip_special_tokens=False)
    d = B.Decoder(vocab, "bytes")
    text = "".join(d.feed(data[i:i + 4]) for i in range(0, len(data), 4)) + d.finish()
    assert text.split() == "größe , naïve 日本語 it 's <|endoftext|>fin .".split()


def test_documents(odd, odd_rows, empty, small, library):
    for df, rows in ((odd, odd_rows), (small, [(r.doc_id, r.text) for r in small.collect()])):
        want = []
        for i, t in rows:
            ids = library.encode(t or "", add_special_tokens=False).ids
            want.append((i, len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
        got = B.encoded(df, PATH, extra=["source"]).collect()
        assert sorted([(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got], key=str) == sorted(want, key=str)
        assert all(hashlib.sha256(r.ids).hexdigest() == r.ids_sha256 and len(r.ids) == 4 * r.n_tokens for r in got)
    assert B.digests(empty, PATH).count() == 0
