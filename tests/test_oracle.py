"""Every DuckDB counterpart that is handed out is SQL which DuckDB can bind on the smallest tables."""

import os

import pytest

pytest.importorskip("public_tokenizers")
import __spark_entry__  # noqa: E402

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")
def test_oracle_sql_runs():
    con = pytest.importorskip("duckdb").connect()
    for name in os.listdir(DIR):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{DIR}/{name}{'/*.parquet' if os.path.isdir(f'{DIR}/{name}') else ''}'")
    handed_out = __spark_entry__.oracle_sql()
    assert set(handed_out) <= set(__spark_entry__.queries())
    for name, sql in handed_out.items():
        assert isinstance(sql, str), name
        con.execute(f"EXPLAIN {sql}")
