"""Every registered query with SQL equals DuckDB's answer."""

import duckdb
import pytest

import __spark_entry__ as entry
from tessera.plans import catalog, detections, stage_queries  # noqa: F401

S = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{S}/{t}.parquet'")
    return con


def same(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", catalog.ORACLE_SQL)
def test_query_equals_sql(spark, duck, name):
    got = catalog.QUERIES[name](spark, S)
    want = duck.sql(catalog.ORACLE_SQL[name])
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    at = [list(want.columns).index(c) for c in cols]
    rows = sorted(str([same(r[i]) for i in at]) for r in want.fetchall())
    assert sorted(str([same(r[c]) for c in cols]) for r in got.collect()) == rows and rows


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["nearest_per_label", "n_objects", "top_25"])
def test_large_tables_are_dealt(spark, tmp_path, monkeypatch, name):
    """Tables that count as large are dealt into partitions of bounded size, with the same results; lines of unknown parts are lines still."""
    con = duckdb.connect()
    for t in ("lineitem", "part", "orders"):
        replaced = "* replace (l_partkey + if(l_orderkey % 5 = 0, 1000000, 0) as l_partkey)" if t == "lineitem" else "*"
        con.sql(f"copy (select {replaced} from '{S}/{t}.parquet') to '{tmp_path}/{t}.parquet' (format parquet)")
        con.sql(f"create view {t} as select * from '{tmp_path}/{t}.parquet'")
    monkeypatch.setattr(detections, "DEALT_BYTES", 4096)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        n = -(-(tmp_path / "lineitem.parquet").stat().st_size // 4096)
        found = catalog.QUERIES[name](spark, str(tmp_path))
        rows = sorted(map(str, con.sql(catalog.ORACLE_SQL[name]).project(", ".join(found.columns)).fetchall()))
        assert sorted(str(tuple(r)) for r in found.collect()) == rows and rows
        assert f", {n}), REPARTITION_BY_NUM" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
