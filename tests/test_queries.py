"""Every named query against its SQL twin in DuckDB."""

from __future__ import annotations

import duckdb
import pytest
from conftest import DATA

from lattica.plans.catalogue_queries import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in ("customer", "embeddings", "events"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    rows = QUERIES[name](spark, DATA).toPandas()
    assert len(rows)
    if name in ORACLE_SQL:
        other = db.sql(ORACLE_SQL[name]).df()
        columns = sorted(rows.columns)
        assert columns == sorted(other.columns)
        plain = lambda df: sorted(tuple(v.item() if hasattr(v, "item") else v for v in r) for r in df[columns].itertuples(index=False))
        assert plain(rows) == plain(other)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
