from __future__ import annotations

import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sigmawatch.session import local_session  # noqa: E402

# The reference's sample file (two devices, one window [60000, 120000)).
SENSOR_A = [20.1, 19.9, 20.0, 20.2, 19.8, 20.0, 20.1, 19.9, 20.0, 20.3, 19.7, 20.0, 20.1, 19.9,
            20.0, 95.4]
SENSOR_B = [50.0, 49.8, 50.2, 50.1, 49.9, 50.0, 49.7, 50.3, 50.0, 49.9, 50.1, 50.0, 49.8, 50.2,
            50.0]
SAMPLE_LINE = "Device sensor-A, measurement 95.4 C, time 67500"

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


def sample_rows():
    rows = [("sensor-A", v, 60000 + 500 * i) for i, v in enumerate(SENSOR_A)]
    rows += [("sensor-B", v, 60000 + 500 * i) for i, v in enumerate(SENSOR_B)]
    return rows


def jsonl(rows) -> str:
    return "".join(json.dumps({"deviceId": d, "temperatureC": t, "timestampMillis": ms}) + "\n"
                   for d, t, ms in rows)


def sample_text() -> str:
    return ("# first comment\n"
            "  # second comment, indented\n"
            + jsonl(sample_rows()))


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=8)
    yield s


@pytest.fixture()
def tmp(tmp_path_factory):
    return str(tmp_path_factory.mktemp("sw"))


@pytest.fixture()
def sample_file(tmp):
    path = os.path.join(tmp, "readings.jsonl")
    with open(path, "w") as f:
        f.write(sample_text())
    return path


def readings_df(spark, rows):
    from sigmawatch.sources.readings import READING_SCHEMA, with_event_time
    return with_event_time(spark.createDataFrame(rows, READING_SCHEMA))


def fresh_dir(prefix: str = "sw-") -> str:
    return tempfile.mkdtemp(prefix=prefix, dir="/tmp")
