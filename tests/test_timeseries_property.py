"""hourly_aggregates against a brute-force implementation of the definitions."""

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from assetlake.operators.timeseries import hourly_aggregates

H = 3600000


def brute(points, is_step):
    """Per hour: stats of the points, plus integrals over the signal clipped to the hour."""
    pts = sorted(points)
    out = {}

    def value_at(t):
        # value of the signal at t (None before the first point / after the last one)
        for (t0, v0), (t1, v1) in zip(pts, pts[1:]):
            if t0 <= t < t1:
                return v0 if is_step else v0 + (v1 - v0) * (t - t0) / (t1 - t0)
        if pts and t == pts[-1][0]:
            return pts[-1][1]
        return None

    for h in sorted({t - t % H for t, _ in pts}):
        vals = [v for t, v in pts if h <= t < h + H]
        n = len(vals)
        mean = sum(vals) / n
        first_t = min(t for t, _ in pts if h <= t < h + H)
        before = [(t, v) for t, v in pts if t < h]
        if first_t == h:
            interp = step = [v for t, v in pts if t == h][0]
        elif before:
            interp, step = value_at(h), before[-1][1]
        else:
            interp = step = None
        T = S1 = S2 = TV = 0.0
        for (t0, v0), (t1, v1) in zip(pts, pts[1:]):
            a, b = max(t0, h), min(t1, h + H)
            if is_step:
                if h <= t1 < h + H:
                    TV += abs(v1 - v0)
            if b <= a:
                continue
            va = v0 if is_step else v0 + (v1 - v0) * (a - t0) / (t1 - t0)
            vb = v0 if is_step else v0 + (v1 - v0) * (b - t0) / (t1 - t0)
            dt = b - a
            T += dt
            S1 += (va + vb) / 2 * dt
            S2 += (va * va + va * vb + vb * vb) / 3 * dt
            if not is_step:
                TV += abs(vb - va)
        out[h] = dict(count=n, sum=sum(vals), min=min(vals), max=max(vals), average=mean,
                      discrete_variance=sum((v - mean) ** 2 for v in vals) / n,
                      interpolation=interp, step_interpolation=step,
                      continuous_variance=max(0.0, S2 / T - (S1 / T) ** 2) if T > 0 else None,
                      total_variation=TV)
    return out


series = st.lists(st.tuples(st.integers(0, 6 * H), st.integers(-50, 50).map(float)),
                  min_size=1, max_size=25, unique_by=lambda p: p[0])


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pts=series, is_step=st.booleans())
def test_matches_brute_force(spark, pts, is_step):
    df = spark.createDataFrame([(1, "s", t, v, is_step) for t, v in pts],
                               "id long, external_id string, timestamp long, value double, is_step boolean")
    got = {r["hour"]: r.asDict() for r in hourly_aggregates(df).collect()}
    want = brute(pts, is_step)
    assert set(got) == set(want)
    for h, w in want.items():
        for k, v in w.items():
            g = got[h][k]
            if v is None:
                assert g is None, (h, k)
            else:
                assert g == pytest.approx(v, rel=1e-9, abs=1e-6), (h, k, g, v)
