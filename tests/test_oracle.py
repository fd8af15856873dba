"""Every registered query against its SQL, over the whole tables."""

from __future__ import annotations

import pytest
from compare import rows_of_spark, rows_of_sql, sql_engine
from conftest import TESTDATA

import __spark_entry__ as driver
from monsoon.plans import queries as registered

WITHOUT_SQL: set[str] = set()
NAMES = sorted(registered.registry())  # the optional parts have tests of their own


@pytest.fixture(scope="module", params=["sf0.001", "sf0.01"])
def sf_dir(request):
    return f"{TESTDATA}/{request.param}"


@pytest.fixture(scope="module")
def engine(sf_dir):
    con = sql_engine(sf_dir)
    yield con
    con.close()


@pytest.mark.parametrize("name", NAMES)
def test_same_rows(spark, engine, sf_dir, name):
    names, rows = rows_of_spark(driver.queries()[name](spark, sf_dir))
    if name in WITHOUT_SQL:
        assert rows
        return
    assert (names, rows) == rows_of_sql(engine, driver.oracle_sql()[name])


def test_every_query_has_sql():
    assert set(NAMES) - set(driver.oracle_sql()) == WITHOUT_SQL
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    result = driver.entry(spark)
    assert result.columns == [
        "kode_kota",
        "nama_kota",
        "suhu_avg",
        "suhu_tertinggi",
        "suhu_terendah",
        "jumlah_event",
    ]
    means = [row.suhu_avg for row in result.collect()]
    assert len(means) == 6 and means == sorted(means, reverse=True)
