import duckdb

from roadlens.llm import mixing as M


def duck(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    if rows:
        con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    return sorted(con.execute(M.SQL).fetchall(), key=str)


def found(df):
    return sorted(((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in M.mix(df).collect()), key=str)


def test_like_sql(odd, empty, small):
    for df in (odd, small, empty):
        assert found(df) == duck([(r.doc_id, r.text, r.source) for r in df.collect()])


def test_caps_are_reshared(spark):
    rows = [(k, "w " * n, s) for k, (n, s) in enumerate([(1, "a"), (2, "b"), (1000, "c"), (10, "d"), (5, "e"), (700, None), (0, "f")])]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert found(df) == duck(rows)
    out = M.mix(df).collect()
    assert all(r.target <= 3 * r.source_size and r.taken <= 3 * r.size for r in out)
    assert abs(sum(r.target for r in out) - sum(r.size for r in out)) < 1e-6


def test_taken_comes_near_target(spark):
    df = spark.range(20_000).selectExpr("id AS doc_id", "repeat('w ', 1 + cast(id % 50 as int)) AS text", "concat('s', id % 3) AS source")
    sums = M.mix(df).groupBy("target").sum("taken").collect()
    assert len(sums) == 3 and all(abs(r["sum(taken)"] / r.target - 1) < 0.03 for r in sums)


def test_emit_repeats_rows_as_mixed(odd, empty):
    out = M.emit(odd)
    assert out.columns == odd.columns
    assert out.count() == sum(r.copies for r in M.mix(odd).collect())
    assert M.emit(empty).count() == 0


def test_many_sources_rank_without_one_window(spark):
    df = spark.range(500).selectExpr("false AS is_null", "lpad(cast(id * 7 % 500 as string), 4, '0') AS source", "id AS source_size")
    got = {r.source: r["rank"] for r in M.ranked_sources(df).collect()}
    assert got == {s: k for k, s in enumerate(sorted(got))}


def test_no_python_in_plans(odd):
    for df in (M.mix(odd), M.emit(odd)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
