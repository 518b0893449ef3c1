"""A5: a line is split once, whatever is asked of its fields."""

from pyspark.sql import functions as F

from roadlens import schemas as S
from roadlens.operators import ingest as I

KEY_AT = {S.VIOLATION_COLUMNS.index(k) for k in S.VIOLATION_KEY}


def _line(agency, known=True):
    return ",".join(f"Agency {agency}" if k == 2 else f"f{k}" if known or k not in KEY_AT else "" for k in range(35))


def test_conditions_do_not_split_again(spark):
    lines = [_line("3"), _line("7"), _line("5"), _line("9", known=False), _line("x"), None, "short,line"]
    rows = I.normalise_violations(spark.createDataFrame([(x,) for x in lines], "value string"))
    kept = I.upsert_latest(rows.withColumn("seq", F.expr("try_cast(substring(agency, 8) AS BIGINT)")), S.VIOLATION_KEY, ["seq"])
    assert [r.agency for r in kept.collect()] == ["Agency 7"]
    assert rows.count() == len(lines) and I.upsert_rejects(rows, S.VIOLATION_KEY).count() == 3
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1
