"""Driver contract: entry runs, every query has a callable, oracle keys are queries."""

import duckdb

import __spark_entry__ as E
from conftest import SF001

FAST = ["elements_union", "extract_pdfs", "extract_images", "link_edges", "checksums", "robots_allowed",
        "retry_fold", "cache_asof", "domain_cap", "metadata_first_writer", "kb_search_topk"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["element_id", "url", "type", "parent_url", "parent_id", "depth", "pos", "page_id",
                          "job_id"]


def test_contract_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 30


def test_queries_match_oracle_sf0001(spark):
    con = duckdb.connect()
    for t in ["pages", "events", "documents", "benchmark"]:
        con.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    q, o = E.queries(), E.oracle_sql()
    for k in FAST:
        df = q[k](spark, SF001)
        got = sorted(tuple(str(r[c]) for c in sorted(df.columns)) for r in df.collect())
        cur = con.execute(o[k])
        cols = [d[0] for d in cur.description]
        idx = sorted(range(len(cols)), key=lambda i: cols[i])
        want = sorted(tuple(str(r[i]) for i in idx) for r in cur.fetchall())
        assert sorted(df.columns) == sorted(cols), k
        assert got == want, k
