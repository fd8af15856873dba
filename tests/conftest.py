from __future__ import annotations

import json
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from monsoon.session import session  # noqa: E402

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata")

OBSERVATIONS = [
    ("JKT", "Jakarta", 30.5, 80, 10.0, 3, "2026-05-06T12:34:56.123456"),
    ("JKT", "Jakarta", 35.0, 90, 40.0, 3, "2026-05-06 12:40:00"),
    ("JKT", "Jakarta", None, 91, 10.0, 3, "2026-05-06 13:00:00"),
    ("SBY", "Surabaya", 35.1, 50, 5.0, 0, "2026-05-06 23:59:59"),
    ("SBY", "Surabaya", 36.0, 95, 41.0, 0, "garbage"),
    ("DPS", "Denpasar", None, None, None, 1, None),
]
FIELDS = "kode_kota nama_kota temperature humidity wind_speed weather_code timestamp".split()


@pytest.fixture(scope="session")
def spark():
    spark = session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def weather_dir(tmp_path):
    """Two batch files, each a JSON array on one line."""
    records = [dict(zip(FIELDS, row)) for row in OBSERVATIONS]
    path = tmp_path / "api"
    path.mkdir()
    (path / "2026-05-06_14-00-00.json").write_text(json.dumps(records[:4]))
    (path / "2026-05-06_14-02-00.json").write_text(json.dumps(records[4:]))
    return str(path)


@pytest.fixture
def weather(spark, weather_dir):
    from monsoon.sources.weather import weather_files

    return weather_files(spark, weather_dir)


@pytest.fixture
def no_weather(spark, tmp_path):
    from monsoon.sources.weather import weather_files

    empty = tmp_path / "empty"
    empty.mkdir()
    return weather_files(spark, str(empty))


def tuples(df) -> list[tuple]:
    return [tuple(row) for row in df.collect()]
