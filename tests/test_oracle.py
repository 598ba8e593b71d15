"""Every registered analysis against its DuckDB twin on the same Parquet tables."""

import hashlib
import math

import duckdb
import pytest

from tablecraft.plans import oracle_sql, queries
from tablecraft.sources.tables import TABLES

ORACLE = oracle_sql()
ROWS_ONLY = sorted(set(queries()) - set(ORACLE))


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if hasattr(v, "item"):
        v = v.item()
    return repr(float(v)) if isinstance(v, float) else str(v)


def digest(pdf):
    cols = sorted(pdf.columns)
    rows = sorted("|".join(_norm(v) for v in r) for r in pdf[cols].itertuples(index=False, name=None))
    return len(rows), cols, hashlib.sha256("\n".join(rows).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def test_every_query_has_a_twin_or_is_a_fit():
    assert set(ROWS_ONLY) <= {"predict_class", "tune_forest", "linear_svm", "boosted_trees"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, sf_dir, duck, name):
    got = digest(queries()[name](spark, sf_dir).toPandas())
    want = digest(duck.execute(ORACLE[name]).df())
    assert got[0] == want[0], f"row count {got[0]} != {want[0]}"
    assert got[1] == want[1], f"columns {got[1]} != {want[1]}"
    assert got[2] == want[2], "values differ"


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["country", "count"]
    assert len(rows) > 0
    counts = [r["count"] for r in rows]
    assert counts == sorted(counts, reverse=True)
