"""The registered queries: one per operator, with SQL where SQL can express it."""

import re

import pytest

import __spark_entry__ as E
from roadlens.llm.queries import ORACLE, QUERIES
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"
COLUMNS = {
    1: {"doc_id", "keep_id", "group_size", "kept", "text_sha256"},
    2: {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    3: {"slot", "shard", "byte_offset", "sequence", "n_tokens", "ids_sha256"},
    4: {"doc_id", "size", "source_size", "target", "taken"},
    5: {"doc_id", "fingerprint", "component_id"},
    6: {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"},
    7: {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    8: {"doc_id", "held_out", "score", "predicted"},
    9: {"doc_id", "n_lines", "n_dropped", "text_sha256"},
    10: {"page_id", "url", "text", "n_chars"},
    11: {"word", "form", "root", "n", "n_near", "form_n"},
    12: {"doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"},
    13: {"query_id", "rank", "vec_id", "score"},
}


def test_one_query_per_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())
    assert set(ORACLE) <= set(E.oracle_sql()) and "pipeline" not in E.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_like_its_sql(spark, name):
    assert compare(spark, SF, [name], con=duck(SF), verbose=False)[name][0] == "OK"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns_and_rows(spark, name):
    n = int(re.match(r"op(\d+)_", name)[1])
    df = QUERIES[name](spark, SF)
    assert COLUMNS[n] <= set(df.columns)
    if n not in (3, 11, 13):  # a row per sequence, word, and hit
        assert df.count() == spark.read.parquet(f"{SF}/{'pages' if n == 10 else 'documents'}.parquet").count()


def test_native_queries_run_no_python(spark):
    for name in (q for q in QUERIES if q.startswith(("op2_", "op4_", "op9_"))):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
