"""Every registered query with an oracle against DuckDB on the same parquet (sf0.001)."""
import math

import duckdb
import pytest

import __spark_entry__ as entry
from cinerank.plans import registry
from cinerank.sources.fixtures import BASE_TABLES
from conftest import SF001, SF01

NAMES = sorted(registry.oracle_sql())
#: Their oracles hold that a trained network reaches the gate, for which sf0.001 is too small.
TRAINED = ("fit_ncf", "fit_neumf", "training_run")


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    def norm(v):
        return float(f"{v:.9g}") if isinstance(v, float) and not math.isnan(v) else v
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def con(sf_dir):
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in BASE_TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return c


def test_every_query_with_oracle_is_registered():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    sf_dir = SF01 if name in TRAINED else SF001
    df = entry.queries()[name](spark, sf_dir)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    cur = con(sf_dir).execute(entry.oracle_sql()[name])
    dcols, drows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(cols) == sorted(dcols)
    assert _canon(cols, rows) == _canon(dcols, drows)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["movie_id", "title", "genres", "rating_count", "mean_rating"]
    df.collect()
