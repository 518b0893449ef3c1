import hashlib

import numpy as np

from roadlens.llm import training_order as T


def test_permutation_is_one_to_one_and_inverts():
    for n in (1, 2, 3, 5, 64, 1000, 4097):
        p = T.Permutation(n)
        slots = p.slot(np.arange(n))
        assert sorted(slots.tolist()) == list(range(n)) and (p.sequence(slots) == np.arange(n)).all()
    assert (T.Permutation(1000, 1).slot(np.arange(1000)) != T.Permutation(1000, 2).slot(np.arange(1000))).any()


def test_round_trip_and_resume(spark, odd, odd_rows, empty, scratch):
    path = f"{scratch}/shards"
    layout = T.write_shards(T.byte_tokens(odd), path, length=100, shard_bytes=1 << 14)
    rows = T.read_shards(spark, path, layout).collect()
    assert sorted(r.slot for r in rows) == list(range(layout.sequences)) and layout.shards > 3
    assert all(len(r.ids) == 100 and r.byte_offset == r.slot % layout.per_shard * layout.stride and r.shard == r.slot // layout.per_shard for r in rows)
    stream = b"".join(r.ids[:r.n_tokens] for r in sorted(rows, key=lambda r: r.sequence))
    assert sorted(stream.split(b"\xff")[:-1]) == sorted((t or "").encode() for _, t in odd_rows)
    rest = T.read_shards(spark, path, layout, first_slot=777).collect()
    assert {r.slot for r in rest} == set(range(777, layout.sequences))
    again = T.write_shards(T.byte_tokens(empty), f"{scratch}/none")
    assert again.sequences == 0 and T.read_shards(spark, f"{scratch}/none", again).count() == 0


def test_wide_tokens(spark, scratch):
    ids = [np.arange(k, dtype="<u4").tobytes() for k in (0, 1, 5, 300)]
    df = spark.createDataFrame(list(enumerate(map(bytearray, ids))), "doc_id long, ids binary")
    layout = T.write_shards(df, f"{scratch}/wide", width=4, end=50_000, pad=50_001, length=64)
    rows = sorted(T.read_shards(spark, f"{scratch}/wide", layout).collect(), key=lambda r: r.sequence)
    tokens = np.frombuffer(b"".join(r.ids[:4 * r.n_tokens] for r in rows), dtype="<u4")
    parts = np.split(tokens, np.flatnonzero(tokens == 50_000) + 1)[:-1]
    assert sorted(hashlib.sha256(p[:-1].tobytes()).hexdigest() for p in parts) == sorted(hashlib.sha256(x).hexdigest() for x in ids)
