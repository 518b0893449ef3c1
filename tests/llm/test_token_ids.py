"""Token ids in batches: the ids of the library, whatever the text; resuming a read of shards."""

import glob
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from roadlens.llm import bpe, token_ids, training_order

WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "a", "don't stop 'll", "café naïve Å é", "<|endoftext|> x<|startoftext|>y", "12345 a1b2", "漢字 かな",
       "\x1cab\x1d cd", "ΣΑΣ ſs 'ſ", "é ́ x", "a b　c\x85d", "!!!??? --", "x" * 300, "ÀÉ ßÿ ×÷", "👍🏽 ok", "İstanbul"]


TOOL = Tokenizer.from_file(WORDS)
TOOL.no_truncation()
TOOL.no_padding()


def library(text):
    return TOOL.encode(text or "", add_special_tokens=False).ids


def decoded(ids):
    return np.frombuffer(ids, "<u2").tolist()


def test_ids_of_the_library(spark, small):
    rows = [(r.doc_id, r.text) for r in small.collect()]
    rows += [(None, None)] + [(10**9 + i, t) for i, t in enumerate([*ODD, " ".join(ODD), ODD[1]])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = token_ids.token_ids(docs, WORDS).collect()
    assert sorted((r.doc_id or -1, decoded(r.ids)) for r in got) == sorted((i or -1, library(t)) for i, t in rows)
    assert token_ids.token_ids(docs.limit(0), WORDS).count() == 0


def test_long_texts_and_small_tables(monkeypatch):
    monkeypatch.setattr(token_ids, "PART", 50)
    monkeypatch.setattr(token_ids, "KNOWN", 20)
    vocab, pick = bpe.vocabulary(WORDS), random.Random(7)
    encoder = token_ids.BatchEncoder(vocab, token_ids.id_width(vocab))
    for _ in range(200):
        text = "".join(pick.choice(["the", "ing", " ", "\n", "\t", "a'b", "é", "9", ".", "漢", "zq" * 40]) for _ in range(80))
        assert "".join(token_ids.parts(text)).replace(" ", "").replace("\n", "") == text.replace(" ", "").replace("\n", "")
        assert decoded(b"".join(encoder.encode([p])[0] for p in token_ids.parts(text))) == library(text)


def test_narrow_ids_in_wide_records(spark, scratch):
    ids = [np.arange(k, dtype="<u2").tobytes() for k in (0, 1, 5, 300)]
    df = spark.createDataFrame(list(enumerate(map(bytearray, ids))), "doc_id long, ids binary")
    layout = training_order.write_shards(df, f"{scratch}/s", width=4, id_width=2, end=50_000, pad=50_001, length=64)
    rows = sorted(training_order.read_shards(spark, f"{scratch}/s", layout).collect(), key=lambda r: r.sequence)
    tokens = np.frombuffer(b"".join(r.ids[:4 * r.n_tokens] for r in rows), dtype="<u4")
    parts = np.split(tokens, np.flatnonzero(tokens == 50_000) + 1)[:-1]
    assert sorted(p[:-1].tolist() for p in parts) == sorted(np.frombuffer(x, "<u2").tolist() for x in ids)
    with pytest.raises(ValueError):
        training_order.write_shards(df, f"{scratch}/t", width=1, id_width=2)


def test_resume_does_not_open_earlier_shards(spark, odd, scratch):
    path = f"{scratch}/shards"
    layout = training_order.write_shards(training_order.byte_tokens(odd), path, length=100, shard_bytes=1 << 14)
    for k in (0, 1):  # unreadable: the content no longer fits its checksum
        with open(glob.glob(f"{path}/part-{k:05d}-*")[0], "r+b") as f:
            f.write(b"\x00" * 999)
    first = 2 * layout.per_shard + 3
    assert {r.slot for r in training_order.read_shards(spark, path, layout, first).collect()} == set(range(first, layout.sequences))
    with pytest.raises(Exception, match="(?i)checksum"):
        training_order.read_shards(spark, path, layout, layout.per_shard).collect()


def test_patterns_of_shard_numbers():
    import re

    for first, last in ((0, 3), (7, 99), (199, 1200), (99_998, 100_003), (123_456, 123_460)):
        found = [re.compile(p) for p in training_order._from(first, last)]
        near = [*range(max(0, first - 300), last + 1), first // 10, 0]
        assert all(any(p.fullmatch(f"{n:05d}") for p in found) == (n >= first) for n in near)
