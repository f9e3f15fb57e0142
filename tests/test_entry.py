import os

import duckdb

import __spark_entry__ as entry_mod
from scripts.oracle_check import TABLES, value_hash
from tests.conftest import SF_SMALL

SLOW = {"als_tune", "op1_quality", "op3_mixing", "op8_suffix_dedup", "pipeline", "als_user_recs", "als_product_recs", "als_rmse"}


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert [f.name for f in df.schema.fields] == ["product_id", "rec_product_id", "score", "rank"]


def test_oracle_keys_are_registered():
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


def test_every_oracle_query_matches_duckdb_at_small_scale(spark):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs = entry_mod.queries()
    for name, sql in entry_mod.oracle_sql().items():
        got = qs[name](spark, SF_SMALL).toPandas()
        want = con.execute(sql).df()
        assert sorted(got.columns) == sorted(want.columns), name
        assert len(got) == len(want), name
        assert value_hash(got) == value_hash(want), name


def test_queries_without_oracle_run(spark):
    qs = entry_mod.queries()
    for name in set(qs) - set(entry_mod.oracle_sql()) - SLOW:
        assert qs[name](spark, SF_SMALL).count() >= 0
