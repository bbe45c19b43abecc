"""Every core query runs over the smallest tables and equals its SQL in DuckDB."""

import glob
import importlib
import os
import pkgutil

import duckdb
import pandas as pd
import pytest

import voxmill.plans

MODULES = [importlib.import_module(f"voxmill.plans.{m.name}") for m in pkgutil.iter_modules(voxmill.plans.__path__) if m.name.endswith("_queries")]
QUERIES = {n: f for m in MODULES for n, f in m.queries().items()}
SQL = {n: q for m in MODULES for n, q in m.oracle_sql().items()}


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def plain(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
        return None
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if hasattr(v, "tzinfo") and v.tzinfo:
        return str(v.replace(tzinfo=None))
    return str(v) if hasattr(v, "isoformat") or type(v).__name__ == "Decimal" else v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf, duck):
    df = QUERIES[name](spark, sf)
    got = [tuple(r) for r in df.collect()]
    if name in SQL:
        c = duck.execute(SQL[name])
        columns = [x[0] for x in c.description]
        assert sorted(df.columns) == sorted(columns)
        want = c.fetchall()
        a, b = rows(df.columns, got), rows(columns, want)
        numbers = [(float(x), float(y)) for p, q in zip(a, b) for x, y in zip(p, q) if isinstance(x, (int, float)) and not isinstance(x, bool) and y is not None]
        assert len(a) == len(b)
        assert a == b or all(abs(x - y) < 1e-6 * max(1, abs(x)) for x, y in numbers) and [[str(x) for x in r if isinstance(x, str)] for r in a] == [[str(x) for x in r if isinstance(x, str)] for r in b]


def test_entry_names_every_query():
    import __spark_entry__ as entry

    assert set(SQL) <= set(QUERIES) <= set(entry.queries())
    assert "align_filter" in entry.queries()
