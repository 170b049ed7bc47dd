"""Every query with SQL gives the SQL's rows."""

import importlib.util
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

DATA = Path("/root/testdata/sf0.001")
NAMES = [n for n in entry.oracle_sql() if n in entry.queries()]


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return round(v, 6) if isinstance(v, float) else str(v) if isinstance(v, (list, dict)) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
@pytest.mark.parametrize("name", NAMES)
def test_rows_equal_sql(spark, duck, name):
    df = entry.queries()[name](spark, str(DATA))
    got = duck.execute(entry.oracle_sql()[name])
    names = [c[0] for c in got.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted((tuple(str(_value(v)) for _, v in sorted(zip(names, r))) for r in got.fetchall()))
    have = sorted(tuple(str(_value(r[c])) for c in sorted(df.columns)) for r in df.collect())
    assert have == want


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_llm_is_optional():
    root = Path(entry.__file__).parent / "bookloom"
    assert importlib.util.find_spec("bookloom.plans.catalogue")
    assert not [p for p in root.rglob("*.py") if "llm" not in p.parts and "bookloom.llm" in p.read_text()]
