import duckdb

import __spark_entry__ as se
from tessera.sources.tables import TABLES


def test_entry_runs(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert "input_count" in df.columns


def test_registry_contract():
    q, o = se.queries(), se.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 80


def _norm(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    def n(v):
        return round(v, 6) if isinstance(v, float) else v
    return sorted((tuple(n(r[i]) for i in order) for r in rows), key=repr)


def test_sample_queries_match_oracle(spark, sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    q, o = se.queries(), se.oracle_sql()
    for name in ("p9_pack_requests", "a1_run_metrics", "j9_comparison", "v3_token_f1",
                 "w1_delta_assembly", "r2_keyword_search"):
        df = q[name](spark, sf_small)
        res = con.execute(o[name])
        assert _norm(df.columns, [tuple(r) for r in df.collect()]) == \
            _norm([d[0] for d in res.description], res.fetchall()), name
