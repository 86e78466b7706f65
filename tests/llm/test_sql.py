"""Training-data queries against their DuckDB SQL."""

import duckdb
import pytest

import data
from tidelot.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, name, folder):
    path = data.DATA.parent / folder
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}/{table}.parquet'")
    cursor = connection.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    frame = QUERIES[name](spark, str(path))
    assert sorted(frame.columns) == sorted(names)
    shown = lambda rows: sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows)
    assert shown(frame.select(*names).collect()) == shown(cursor.fetchall())
