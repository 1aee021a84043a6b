import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402

SMOKE = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert "machine_def" in df.columns and df.count() >= 0


def test_every_oracle_has_a_query():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 60


def test_sql_queries_smoke(spark):
    if not os.path.isdir(SMOKE):
        return
    import duckdb

    con = duckdb.connect()
    for t in ("events", "orders", "lineitem", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    for name in ("daily_features", "join_left", "check_missing", "group_split"):
        s = entry.queries()[name](spark, SMOKE)
        d = con.sql(entry.oracle_sql()[name])
        assert sorted(s.columns) == sorted(d.columns)
        assert s.count() == len(d.fetchall())
