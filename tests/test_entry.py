import pytest

import __spark_entry__ as entry_mod


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "relative_demand_score" in df.columns


def test_every_oracle_has_a_query():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 40


@pytest.mark.parametrize("name", ["mart_mobility_overview", "fact_zone_hourly_demand", "pending_files"])
def test_oracle_parity_small(spark, name):
    import duckdb
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("events", "nation", "region"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    got = sorted(tuple(r) for r in entry_mod.queries()[name](spark, sf).collect())
    exp_rel = con.sql(entry_mod.oracle_sql()[name])
    cols = entry_mod.queries()[name](spark, sf).columns
    exp = sorted(tuple(r) for r in con.sql(f"SELECT {', '.join(cols)} FROM ({exp_rel.sql_query()})").fetchall())
    assert got == exp


def test_entry_module_imports_without_a_session():
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import __spark_entry__ as e; assert len(e.queries()) >= 40 and len(e.oracle_sql()) >= 40"
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
