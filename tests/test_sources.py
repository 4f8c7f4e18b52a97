"""JSON-lines reader and line format."""

from __future__ import annotations

import os
import re

import pytest
from conftest import SAMPLE_LINE, jsonl
from pyspark.sql import functions as F

from sigmawatch.functions.format import anomaly_line
from sigmawatch.plans.jobs import detect_file
from sigmawatch.sinks.lines import LINE, with_lines
from sigmawatch.sources import read_jsonl, write_jsonl


def write(tmp, name, text):
    path = os.path.join(tmp, name)
    with open(path, "w") as f:
        f.write(text)
    return path


# ---- reader -----------------------------------------------------------------------------------

def test_reads_sample_and_skips_comments(spark, sample_file):
    df = read_jsonl(spark, sample_file)
    assert df.count() == 31
    assert df.columns == ["deviceId", "temperatureC", "timestampMillis", "ts"]


def test_comment_and_blank_forms(spark, tmp):
    body = jsonl([("x", 1.5, 10)])
    text = "\n   \n# a comment\n  # indented comment\n\t" + body.strip() + "  \n"
    rows = read_jsonl(spark, write(tmp, "c.jsonl", text)).collect()
    assert [(r.deviceId, r.temperatureC, r.timestampMillis) for r in rows] == [("x", 1.5, 10)]


def test_unknown_field_ignored(spark, tmp):
    text = '{"deviceId": "x", "temperatureC": 2.0, "timestampMillis": 5, "x": 1}\n'
    assert read_jsonl(spark, write(tmp, "u.jsonl", text)).count() == 1


@pytest.mark.parametrize("bad", [
    "not json",
    '{"deviceId": "x", "temperatureC": 2.0}',
    '{"deviceId": null, "temperatureC": 2.0, "timestampMillis": 5}',
    '{"deviceId": "x", "temperatureC": NaN, "timestampMillis": 5}',
])
def test_malformed_line_fails_with_text(spark, tmp, bad):
    path = write(tmp, "m.jsonl", jsonl([("ok", 1.0, 1)]) + bad + "\n")
    with pytest.raises(Exception) as err:
        read_jsonl(spark, path).count()
    assert "Malformed reading" in str(err.value) and bad[:8] in str(err.value)


def test_lenient_mode_drops_bad_lines(spark, tmp):
    path = write(tmp, "l.jsonl", jsonl([("ok", 1.0, 1)]) + "not json\n")
    assert read_jsonl(spark, path, strict=False).count() == 1


def test_write_then_read_round_trip(spark, tmp):
    from conftest import readings_df, sample_rows
    out = os.path.join(tmp, "rt")
    write_jsonl(readings_df(spark, sample_rows()).repartition(3), out, header="exported")
    back = read_jsonl(spark, out)
    assert sorted(tuple(r) for r in back.select("deviceId", "temperatureC", "timestampMillis")
                  .collect()) == sorted(sample_rows())
    texts = [open(os.path.join(out, f)).readline() for f in os.listdir(out) if f.startswith("part")]
    assert all(t.startswith("# exported") for t in texts if t)


def test_detect_file_job_prints_golden_line(spark, sample_file, capsys):
    assert detect_file(spark, sample_file, method="two_pass") == 1
    assert capsys.readouterr().out.strip().splitlines()[-1] == SAMPLE_LINE
    assert detect_file(spark, sample_file, method="incremental") == 1


def test_line_rounding_matches_java_format(spark):
    df = spark.createDataFrame([(0.25,), (6.55,), (78.25,)], "v double")
    got = [r[0] for r in df.select(anomaly_line(F.lit("d"), "v", F.lit(7))).collect()]
    assert got == ["Device d, measurement 0.3 C, time 7", "Device d, measurement 6.6 C, time 7",
                   "Device d, measurement 78.3 C, time 7"]
