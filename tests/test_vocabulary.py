"""F20 without state: the word table equals the batch word set, whatever is replayed or folded."""

import os
import re

from pyspark.sql import functions as F

from roadlens.operators import ingest as I
from roadlens.sinks import keyed_table as KT
from roadlens.sources import streams as SRC
from roadlens.streaming import vocabulary as V

TEXTS = ["the road is  closed\nthe road", "open road", "", "the bridge is closed", "open open\nford", "is it the ford", None, "last"]


def _first(texts):
    seen = {}
    for k, t in enumerate(texts):
        for w in re.split("[ \n]", t) if t is not None else []:
            seen.setdefault(f"Word:{w}", k)
    return sorted((w, 1, k) for w, k in seen.items())


def _read(spark, path):
    return sorted(tuple(r) for r in V.read_vocabulary(spark, path).collect())


def _add(spark, path, k):
    V.add_words(spark.createDataFrame([(TEXTS[k],), (TEXTS[k],)], "value string"), path, k)


def test_loads_replays_and_folding(spark, scratch):
    path = os.path.join(scratch, "words")
    for k in range(len(TEXTS)):
        _add(spark, path, k)
        _add(spark, path, k)  # replayed before the next one
        if k in (2, 5):
            KT.compact(spark, path, V.KEYS, V.ORDER, 4)
            _add(spark, path, k)  # replayed after it has been folded
        assert _read(spark, path) == _first(TEXTS[: k + 1])
    assert {r.key for r in V.sightings_since(spark, path, 3).collect()} == {w for w, _, k in _first(TEXTS) if k >= 3}


def test_only_touched_buckets_are_read(spark, scratch):
    path = os.path.join(scratch, "words")
    V.add_words(spark.createDataFrame([(" ".join(f"w{i}" for i in range(400)),)], "value string"), path, 0)
    KT.compact(spark, path, V.KEYS, V.ORDER, 16)
    one = spark.createDataFrame([("Word:w7",)], "key string")
    found = KT.candidates(one, path, V.KEYS, before=1)
    assert found.where(F.col("key") == "Word:w7").count() == 1
    assert len({re.search(r"_bucket=(\d+)", f)[1] for f in found.inputFiles()}) == 1


def test_stream_without_state(spark, scratch):
    src, path = os.path.join(scratch, "lines"), os.path.join(scratch, "words")
    os.makedirs(src)

    def run():
        q = V.vocabulary_stream(SRC.read_lines(spark, src, max_files=1), path, os.path.join(scratch, "ck"), compact_every=2, buckets=4)
        q.awaitTermination(300)
        assert q.exception() is None
        return q

    for k, t in enumerate(TEXTS[:4]):
        with open(os.path.join(src, f"{k}.txt"), "w") as fh:
            fh.write(t)
    q = run()
    assert not q.lastProgress["stateOperators"]
    with open(os.path.join(src, "late.txt"), "w") as fh:  # after a restart
        fh.write("the last word")
    run()
    want = {r.key for r in I.distinct_words(spark.read.text(src)).collect()}
    got = _read(spark, path)
    assert {w for w, _, _ in got} == want and len(got) == len(want)
    assert KT.complete(spark, path, "manifest=")
