"""Driver contract and the SQL oracle for every registered query (sf0.001)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as E  # noqa: E402
from reviewlake.oracle import all_sql  # noqa: E402
from reviewlake.registry import all_queries  # noqa: E402
from oracle_check import TABLES, rows_of_duck, rows_of_spark  # noqa: E402


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["sport_category", "avg_rating", "rating_count", "avg_rating_2dp", "band_color", "rank"]
    assert df.count() > 0


def test_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    own = set(all_queries())
    assert len(own) >= 95 and own <= set(q)
    assert own <= set(o)                     # every query of the library has its SQL


@pytest.fixture(scope="module")
def duck(sf):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(all_sql()))
def test_oracle(spark, sf, duck, name):
    scols, srows = rows_of_spark(E.queries()[name](spark, sf))
    dcols, drows = rows_of_duck(duck, E.oracle_sql()[name])
    assert scols == dcols
    assert srows == drows and srows          # an empty result checks nothing


def test_optional_modules(tmp_path, monkeypatch):
    monkeypatch.syspath_prepend(str(tmp_path))
    (tmp_path / "broken_module.py").write_text("import no_such_dependency\n")
    assert E._optional("no_such_module_here") is None
    with pytest.raises(ModuleNotFoundError):
        E._optional("broken_module")


def test_wrapper_presents_engine_neutral_types(spark, sf):
    df = E.queries()["store_projection"](spark, sf)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert types["rating"] == "double" and types["sentiment_score"] == "double"
    assert types["review_date"] == "timestamp_ntz" and types["ingested_at"] == "timestamp_ntz"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
