"""op3: the sequences hold the token ids of the library."""

import hashlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from roadlens.llm import queries, training_order

SF = "/root/testdata/sf0.001"


def test_sequences_hold_token_ids(spark, small, monkeypatch):
    kept, read = [], training_order.read_shards
    monkeypatch.setattr(training_order, "read_shards", lambda *a, **b: kept.append(read(*a, **b)) or kept[-1])
    out = queries.op3_training_order(spark, SF)
    rows = sorted(kept[0].collect(), key=lambda r: r.sequence)
    ids = np.frombuffer(b"".join(r.ids[:4 * r.n_tokens] for r in rows), dtype="<u4")
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    end = ids.max()
    parts = [p[:-1].tolist() for p in np.split(ids, np.flatnonzero(ids == end) + 1)[:-1]]
    assert sorted(parts) == sorted(library.encode(r.text or "", add_special_tokens=False).ids for r in small.collect())
    assert {r.sequence: r.ids_sha256 for r in out.collect()} == {r.sequence: hashlib.sha256(r.ids).hexdigest() for r in rows}
