"""Hourly aggregates on hand-built series with known answers."""

import pytest

from assetlake.operators.timeseries import hourly_aggregates

H = 3600000
SCHEMA = "id long, external_id string, timestamp long, value double, is_step boolean"


def _agg(spark, rows):
    out = hourly_aggregates(spark.createDataFrame(rows, SCHEMA)).collect()
    return {(r["id"], r["hour"]): r for r in out}


def test_linear_two_hours(spark):
    # points at 0:30 (v=0) and 1:30 (v=60): line through the hour boundary at 1:00 (v=30)
    out = _agg(spark, [(1, "a", 30 * 60000, 0.0, False), (1, "a", H + 30 * 60000, 60.0, False)])
    h0, h1 = out[(1, 0)], out[(1, H)]
    assert h0["count"] == 1 and h0["average"] == 0.0 and h0["discrete_variance"] == 0.0
    assert h0["interpolation"] is None and h0["step_interpolation"] is None
    assert h1["interpolation"] == pytest.approx(30.0) and h1["step_interpolation"] == 0.0
    # hour 0 covers 0:30-1:00 from 0 to 30; hour 1 covers 1:00-1:30 from 30 to 60
    assert h0["total_variation"] == pytest.approx(30.0) and h1["total_variation"] == pytest.approx(30.0)
    # variance of a linear ramp 0..30 over the piece = 30^2/12
    assert h0["continuous_variance"] == pytest.approx(75.0)
    assert h1["continuous_variance"] == pytest.approx(75.0)


def test_step_series_and_gap(spark):
    # step series: 5 at 0:00, 9 at 3:15 (gap of three hours)
    out = _agg(spark, [(2, "s", 0, 5.0, True), (2, "s", 3 * H + 15 * 60000, 9.0, True)])
    h0, h3 = out[(2, 0)], out[(2, 3 * H)]
    assert set(out) == {(2, 0), (2, 3 * H)}       # no rows for empty hours
    assert h0["interpolation"] == 5.0 and h0["total_variation"] == 0.0
    assert h0["continuous_variance"] == pytest.approx(0.0)
    assert h3["interpolation"] == 5.0 and h3["step_interpolation"] == 5.0
    assert h3["total_variation"] == pytest.approx(4.0)


def test_point_on_the_hour_and_counts(spark):
    rows = [(3, "p", 2 * H, 1.0, False), (3, "p", 2 * H + 1000, 3.0, False), (3, "p", 2 * H + 2000, 2.0, False)]
    out = _agg(spark, rows)
    h = out[(3, 2 * H)]
    assert h["interpolation"] == 1.0 and h["count"] == 3 and h["sum"] == 6.0
    assert h["min"] == 1.0 and h["max"] == 3.0 and h["total_variation"] == pytest.approx(3.0)


def test_count_sums_to_points(spark, tenants):
    from pyspark.sql import functions as F
    src, _ = tenants
    pts = src.ts_points().filter(F.col("value").isNotNull()).join(
        src.ts_headers().select("id", "is_step"), "id")
    total = hourly_aggregates(pts).agg(F.sum("count")).first()[0]
    assert total == pts.count()


def test_duplicate_timestamps_are_reduced(spark):
    rows = [(4, "d", 1000, 1.0, False), (4, "d", 1000, 5.0, False), (4, "d", 2000, 2.0, False)]
    h = _agg(spark, rows)[(4, 0)]
    assert h["count"] == 2 and h["max"] == 5.0 and h["total_variation"] == pytest.approx(3.0)


def test_batches_at_most_n(spark):
    from pyspark.sql import functions as F
    from assetlake.operators.batching import batch_rows
    df = spark.range(0, 1000).withColumnRenamed("id", "x")
    for spread in (1, 7):
        out = batch_rows(df, F.pmod(F.col("x"), F.lit(3)), "x", 20, spread=spread)
        sizes = [r[0] for r in out.select(F.size("items")).collect()]
        assert max(sizes) <= 20 and sum(sizes) == 1000


def test_time_weighted_average(spark):
    rows = [(5, "w", 0, 0.0, False), (5, "w", H // 2, 10.0, False), (5, "w", H, 10.0, False)]
    out = {(r["id"], r["hour"]): r for r in hourly_aggregates(
        spark.createDataFrame(rows, SCHEMA), time_weighted=True).collect()}
    # ramp 0->10 over the first half (mean 5), flat 10 over the second half: 7.5
    assert out[(5, 0)]["average"] == pytest.approx(7.5)


def test_variance_of_a_series_with_a_large_offset(spark):
    rows = [(6, "o", k * 60000, 1e9 + 0.01 * (k % 2), False) for k in range(120)]
    out = _agg(spark, rows)
    # a triangle wave between 1e9 and 1e9 + 0.01: variance 0.01^2 / 12
    assert out[(6, 0)]["continuous_variance"] == pytest.approx(0.01 ** 2 / 12, rel=1e-3)
    assert out[(6, H)]["continuous_variance"] == pytest.approx(0.01 ** 2 / 12, rel=1e-3)


def test_cluster_settings():
    from assetlake.session import cluster_settings
    conf = cluster_settings(100 * 1024 ** 4, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600


@pytest.mark.parametrize("window", [(3 * H, None), (3 * H, 5 * H - 1), (3 * H + 600_000, 4 * H + 10)])
def test_published_hours_have_segments_over_the_window_edges(spark, window):
    """The job's buckets are those of the whole history, cut to the window's hours afterwards."""
    from types import SimpleNamespace

    from assetlake.plans.jobs import PUBLISH
    from assetlake.plans.params import RUN_TIME

    rows = [(i, f"e{i}", t, float(v), i == 2) for i in (1, 2) for t, v in
            [(0, 1), (H + 900_000, 9), (3 * H + 300_000, 2), (3 * H + 900_000, 4), (4 * H + 5, 7), (6 * H + 70, 30), (6 * H + 70, 31), (9 * H, 1)]]
    rows += [(3, "e3", 3 * H + 5, 8.0, False), (4, "e4", H, 1.0, False), (4, "e4", 8 * H, 3.0, False)]
    points = spark.createDataFrame(rows, SCHEMA)
    heads = spark.createDataFrame([(i, f"e{i}", f"n{i}", False, i == 2, []) for i in range(1, 5)],
                                  "id long, external_id string, name string, is_string boolean, is_step boolean, security_categories array<long>")
    src = SimpleNamespace(ts_points=lambda: points.drop("is_step"), ts_headers=lambda: heads)
    names = ["average", "max", "min", "count", "sum", "interpolation", "step_interpolation", "continuous_variance", "discrete_variance", "total_variation"]
    last = window[1] if window[1] is not None else 100 * H
    want = {(r["id"], r["hour"]): [r[n] for n in names] for r in hourly_aggregates(points).collect() if 3 * H <= r["hour"] <= last}
    got = {(r["id"], int(r["ms"])): [r[n] for n in names]
           for r in PUBLISH["ts_points_hour"](src, RUN_TIME, window=window).selectExpr("*", "unix_millis(timestamp) ms").collect()}
    assert got.keys() == want.keys() and len(got) >= 5
    for k, v in want.items():
        assert got[k] == [x if x is None else pytest.approx(x) for x in v], k
    assert got[1, 3 * H][names.index("interpolation")] is not None
