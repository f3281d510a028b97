"""Every query with SQL against DuckDB on the smallest tables; the others run and keep their shape."""

import glob
import os

import duckdb
import pytest

from linefold.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def plain(rows):
    """Rows as sorted text, numbers of any type alike."""

    def one(v):
        if isinstance(v, bool) or v is None:
            return str(v)
        try:
            return repr(float(v)) if not isinstance(v, str) else v
        except (TypeError, ValueError):
            return str(v)

    return sorted(tuple(map(one, r)) for r in rows)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_against_duckdb(spark, con, name):
    df = catalogue.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    quoted = ", ".join(f'"{c}"' for c in cols)
    want = con.execute(f"SELECT {quoted} FROM ({catalogue.ORACLE_SQL[name]})").fetchall()
    assert plain(df.select(*cols).collect()) == plain(want)


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL)))
def test_without_sql(spark, name):
    assert catalogue.QUERIES[name](spark, SF).count() > 0
