"""A registered query's rows against its DuckDB SQL."""

import duckdb

from layerkit.llm import oracles
from tests.llm.conftest import SF


def check_sql(name, df):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    rel = con.sql(oracles.oracle_sql()[name])
    assert sorted(rel.columns) == sorted(df.columns)
    got = sorted((tuple(r[c] for c in rel.columns) for r in df.collect()), key=str)
    assert got == sorted(rel.fetchall(), key=str)
