"""Window edges, large offsets and silences against the clipping SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F

from assetlake.operators.timeseries import HOUR_MS, hourly_aggregates
from assetlake.plans.oracle import hourly
from assetlake.plans.publish import publish_ts_points_hour

DDL = "id long, external_id string, timestamp long, value double, is_step boolean"
H = HOUR_MS
YEAR = 365 * 24 * H


def points(offset=0.0):
    shape = [(0, 1.0), (H // 2, 4.0), (H - 1, 2.5), (H, 7.0), (3 * H + 17, 3.0), (3 * H + 900_000, 3.25), (11 * H + 5, 9.0), (11 * H + 5 + YEAR, 1.0), (11 * H + 6 + YEAR, 2.0)]
    return [(s, f"s{s}", t + 100 * H, v + offset, bool(s % 2)) for s in (1, 2) for t, v in shape] + [(3, None, 5 * H + 1, 6.0, False), (4, "e", 6 * H, 6.0, True)]


def expected(rows, where="true"):
    con = duckdb.connect()
    con.execute("CREATE TABLE pts (id BIGINT, external_id VARCHAR, timestamp BIGINT, value DOUBLE, is_step BOOLEAN)")
    con.executemany("INSERT INTO pts VALUES (?, ?, ?, ?, ?)", rows)
    return {(r[0], r[1]): r[2:] for r in con.execute("WITH " + hourly("SELECT * FROM pts", where).strip() + """
        SELECT id, hour, average, min, max, count, sum, interpolation, step_interpolation, continuous_variance, discrete_variance, total_variation FROM hourly""").fetchall()}


COLUMNS = ["id", "hour", "average", "min", "max", "count", "sum", "interpolation", "step_interpolation", "continuous_variance", "discrete_variance", "total_variation"]


@pytest.mark.parametrize("offset", [0.0, 1e9, -1e9])
def test_large_offsets(spark, offset):
    want = expected(points(offset))
    got = {(r[0], r[1]): tuple(r)[2:] for r in hourly_aggregates(spark.createDataFrame(points(offset), DDL)).select(*COLUMNS).collect()}
    assert got.keys() == want.keys()
    for k, row in got.items():
        for c, a, b in zip(COLUMNS[2:], row, want[k], strict=True):
            if "variance" in c and offset and b is not None:
                assert a == pytest.approx(b, rel=1e-5, abs=1e-6), (k, c)  # the offset must not drown a variance of about 1
            else:
                assert (a is None) == (b is None) and (b is None or a == pytest.approx(b, rel=1e-9, abs=1e-9)), (k, c)


class Tenant:
    def __init__(self, spark, rows):
        self.points = spark.createDataFrame([(*r[:4], None) for r in rows], "id long, external_id string, timestamp long, value double, value_string string")
        self.heads = spark.createDataFrame([(i, "series", False, s, []) for i, s in sorted({(r[0], r[4]) for r in rows})],
                                           "id long, name string, is_string boolean, is_step boolean, security_categories array<long>")

    def ts_points(self):
        return self.points

    def ts_headers(self):
        return self.heads


@pytest.mark.parametrize("window", [(103 * H + 40, None), (103 * H + 40, 111 * H + 1), (104 * H, 110 * H), (101 * H, 103 * H + 100)])
def test_points_outside_the_window_count_at_its_edges(spark, window):
    rows = points()
    lo, hi = window
    lo, hi = lo - lo % H, None if hi is None else hi - hi % H
    want = expected(rows, f"hour >= {lo}" + ("" if hi is None else f" AND hour <= {hi}"))
    out = publish_ts_points_hour(Tenant(spark, rows), "2024-01-01T00:00:00Z", window, neighbours=True)
    got = {(r.id, r.hour): tuple(r[c] for c in COLUMNS[2:]) for r in out.withColumn("hour", F.unix_millis("timestamp")).collect()}
    assert got.keys() == want.keys()
    for k in got:
        assert got[k] == pytest.approx(want[k], rel=1e-9, abs=1e-9)


def test_silences_of_hours_are_filled_and_of_years_are_not(spark):
    df = spark.createDataFrame(points(), DDL)
    plain = {(r.id, r.hour): r for r in hourly_aggregates(df).collect()}
    filled = hourly_aggregates(df, fill_empty=True, max_gap_ms=24 * H).collect()
    assert len(filled) == len({(r.id, r.hour) for r in filled})
    rows = {(r.id, r.hour): r for r in filled}
    assert all(rows[k] == plain[k] for k in plain)
    new = rows.keys() - plain.keys()
    assert new == {(s, (100 + h) * H) for s in (1, 2) for h in (2, 4, 5, 6, 7, 8, 9, 10)}
    linear, step = rows[2, 102 * H], rows[1, 102 * H]
    slope = (3.0 - 7.0) / (2 * H + 17)
    assert linear.interpolation == pytest.approx(7 + slope * H) and linear.step_interpolation == 7.0 and linear["count"] == 0
    assert linear.total_variation == pytest.approx(-slope * H) and linear.continuous_variance == pytest.approx((slope * H) ** 2 / 12)
    assert (step.interpolation, step.total_variation, step.continuous_variance, step.average, step.external_id) == (7.0, 0.0, 0.0, None, "s1")
    years = hourly_aggregates(df, fill_empty=True, max_gap_ms=2 * YEAR)
    assert years.count() == len(rows) + 2 * (365 * 24 - 1)
    with pytest.raises(ValueError):
        hourly_aggregates(df, fill_empty=True)
