"""Every registered query against its DuckDB oracle (order-insensitive)."""

import pytest

from isotherm.plans.catalog import ORACLE_SQL, QUERIES
from tools.verify import compare, duckdb_connection

from .conftest import SF_CHECK, SF_SMALL


@pytest.fixture(scope="module")
def con_small():
    return duckdb_connection(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle_sf0001(spark, con_small, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), con_small, ORACLE_SQL[name])
    assert ok, msg


@pytest.mark.parametrize("name", ["seasonal_avg", "station_datapoints", "global_year_means",
                                  "year_change", "region_summary_many", "station_country",
                                  "readings_ingest"])
def test_query_matches_oracle_sf001(spark, name):
    ok, msg = compare(QUERIES[name](spark, SF_CHECK), duckdb_connection(SF_CHECK), ORACLE_SQL[name])
    assert ok, msg


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["YEAR", "SEASON", "AVG_SEASONAL_TEMP"]
    rows = df.collect()
    assert len(rows) > 0
    # ordered by year, then season name
    keys = [(r.YEAR, r.SEASON) for r in rows]
    assert keys == sorted(keys)
    assert set(QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
    assert set(QUERIES) == set(ORACLE_SQL)
