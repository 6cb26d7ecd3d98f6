"""Every key with a SQL oracle matches DuckDB on the smoke tables."""

import tempfile

import duckdb
import pytest

import __spark_entry__ as E
from compare import frame, same
from conftest import SMOKE

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute(f"SET temp_directory='{tempfile.mkdtemp(prefix='duck-', dir='/tmp')}'")
    c.execute("SET max_temp_directory_size='4GB'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_matches_oracle(spark, con, key):
    got = frame(E.queries()[key](spark, SMOKE))
    want = con.execute(E.oracle_sql()[key]).df()
    same(got, want)


def test_every_key_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "campaignId_gender_stas" in df.columns
