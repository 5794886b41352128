import __spark_entry__ as E

from core_helpers import SF_SMALL


def test_registry_shapes():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 40


def test_entry_runs(spark):
    df = E.entry(spark)
    from tabulon.schema import PROJECTS_SCHEMA

    assert df.columns == PROJECTS_SCHEMA.names
    assert df.count() > 0


def test_a_few_queries_match_oracle(spark):
    import duckdb

    con = duckdb.connect()
    for t in ("orders", "lineitem", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for name in ("upsert_update_insert", "dedupe_keep_last", "date_mixed_formats", "column_profile"):
        got = sorted(map(tuple, E.queries()[name](spark, SF_SMALL).collect()), key=repr)
        want = sorted(con.sql(E.oracle_sql()[name]).fetchall(), key=repr)
        assert got == want, name
