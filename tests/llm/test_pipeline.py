import hashlib
import re
from collections import Counter

import corpus_pipeline
import numpy as np
from tokenizers import Tokenizer

from roadlens.llm import mixing, ranker
from tests.llm.test_copies import Sets, plain_fingerprint

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, small):
    rows = {r.doc_id: r for r in small.collect()}
    model = ranker.fit(small, spark.read.parquet(f"{SF}/labels.parquet"))
    keep = {r.doc_id for r in ranker.scored(small, model).where("predicted = 1").collect()}
    first = {}
    for i in sorted(keep):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", rows[i].text), i)
    keep, sets = sorted(first.values()), Sets()
    fps = {i: plain_fingerprint(rows[i].text) for i in keep}
    for k, a in enumerate(keep):
        sets.find(a)
        for b in keep[:k]:
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                sets.join(a, b)
    keep = sorted({sets.find(i) for i in keep})
    left = spark.createDataFrame([rows[i] for i in keep], small.schema)
    copies = {r.doc_id: r.copies for r in mixing.mix(left).collect()}
    library, want = Tokenizer.from_file(corpus_pipeline.VOCABULARY), Counter()
    for i in keep:
        ids = library.encode(rows[i].text, add_special_tokens=False).ids
        want[i, len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()] += copies[i]
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == +want


def test_stages_keep_columns_and_odd_rows(spark, odd, empty):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "exact_dedup", "simhash_near_dedup", "source_mixing", "bpe_encoding"]
    for docs in (odd, empty):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns, name
            out.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()
