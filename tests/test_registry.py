"""Every query with SQL gives the SQL's rows on sf0.001; every other one runs and has rows."""

import math

import duckdb
import pytest

from loomframe.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return str(v)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, db, name):
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rows = sorted(repr([plain(v) for v in r]) for r in df.select(*columns).collect())
    if name not in catalog.ORACLES:
        assert rows
        return
    rel = db.sql(catalog.ORACLES[name])
    assert sorted(rel.columns) == columns
    names = ", ".join(f'"{c}"' for c in columns)
    assert rows == sorted(repr([plain(v) for v in r]) for r in db.sql(f"SELECT {names} FROM ({catalog.ORACLES[name]}) q").fetchall())
