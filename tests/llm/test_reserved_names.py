"""Extra columns named like the operators' own, and rows that tie in id and text."""

from pyspark.sql import functions as F

from roadlens.llm import exact_dedup, mixing, simhash

OWN = ["__mix_null", "__mix_source", "__mix_rate", "__mix_n", "__mix_copies", "__mix_copy", "__exact_key", "__exact_rank", "__near_key", "__near_rank", "__place", "__MIX_RATE_"]


def test_columns_come_back_as_they_were(odd):
    docs = odd.withColumns({c: F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for c in OWN})
    for result in (mixing.emit(docs), exact_dedup.drop_exact_copies(docs), simhash.drop_near_copies(docs)):
        assert result.columns == docs.columns
        for r in result.collect():
            assert all(r[c] == c + ("-" if r["doc_id"] is None else str(r["doc_id"])) for c in OWN)


def test_rows_that_tie_in_id_and_text_leave_the_same_one_each_time(spark):
    rows = [(1, "a b c", k) for k in range(50)] + [(2, "d e f", 1), (None, "a b c", 7)]
    for operator in (exact_dedup.drop_exact_copies, simhash.drop_near_copies):
        seen = {tuple(sorted(map(str, operator(spark.createDataFrame(rows, "doc_id long, text string, extra int").repartition(n)).collect()))) for n in (1, 3, 5)}
        assert len(seen) == 1
