"""Property tests: both shapes equal an exact (rational) decision; merged statistics equal
direct ones."""

from __future__ import annotations

import math
from fractions import Fraction

from conftest import readings_df
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sigmawatch.operators import detect, merge_stats, window_stats

# Few devices and windows, values from a small set (ties, constant groups, duplicates) plus
# occasional far values; times across three one-minute windows.
reading = st.tuples(
    st.sampled_from(["a", "b", "c"]),
    st.one_of(st.sampled_from([0.0, 0.5, 1.0, 1.5, 20.0, 20.1]),
              st.floats(-1e3, 1e3, allow_nan=False, allow_infinity=False).map(lambda x: round(x, 2))),
    st.integers(0, 179_999),
)
readings = st.lists(reading, min_size=1, max_size=80)

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def rows_of(df):
    return sorted(tuple(r) for r in df.select("deviceId", "temperatureC", "timestampMillis").collect())


def exact_decisions(rows, window_ms, k):
    """Per row: True (outlier), False (not) or None (within 1e-9 of the threshold, where the
    floating-point result may go either way). Decided in rationals:
    ``|x - mean| > k sd  <=>  (x - mean)^2 > k^2 var``."""
    groups = {}
    for r in rows:
        groups.setdefault((r[0], r[2] // window_ms), []).append(r)
    out = {}
    k2 = Fraction(k) ** 2
    for members in groups.values():
        xs = [Fraction(m[1]) for m in members]  # the exact binary value of each double
        n = len(xs)
        mean = sum(xs) / n
        var = sum((x - mean) ** 2 for x in xs) / n
        for m, x in zip(members, xs):
            if n < 2 or max(xs) == min(xs):
                verdict = False
            else:
                lhs, rhs = (x - mean) ** 2, k2 * var
                verdict = None if abs(lhs - rhs) <= rhs * Fraction(1, 10**9) else lhs > rhs
            out.setdefault(m, []).append(verdict)
    return out


@SETTINGS
@given(rows=readings, k=st.sampled_from([1.0, 2.0, 3.0]))
def test_shapes_equal_exact_decision(spark, rows, k):
    df = readings_df(spark, rows)
    decisions = exact_decisions(rows, 60_000, k)
    must = sorted(m for m, vs in decisions.items() for v in vs if v is True)
    may = sorted(m for m, vs in decisions.items() for v in vs if v is None)
    for method in ("incremental", "two_pass"):
        got = rows_of(detect(df, "deviceId", "ts", "temperatureC", "1 minute", k, method))
        extra, allowed = list(got), list(may)   # fresh copies for each method
        for m in must:
            assert m in extra, (method, m, rows)
            extra.remove(m)
        for m in extra:
            assert m in allowed, (method, m, rows)
            allowed.remove(m)


@SETTINGS
@given(rows=readings)
def test_merge_equals_direct(spark, rows):
    df = readings_df(spark, rows)
    fine = window_stats(df, "deviceId", "ts", "temperatureC", "1 minute")
    merged = {r.deviceId: r for r in merge_stats(fine, "deviceId", "3 minutes").collect()}
    direct = {r.deviceId: r for r in window_stats(df, "deviceId", "ts", "temperatureC", "3 minutes").collect()}
    assert merged.keys() == direct.keys()
    for key, m in merged.items():
        d = direct[key]
        assert (m.n, m.lo, m.hi) == (d.n, d.lo, d.hi)
        assert math.isclose(m.mean, d.mean, rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(m.stddev, d.stddev, rel_tol=1e-7, abs_tol=1e-7)
