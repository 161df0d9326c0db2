"""Hourly time-series aggregates.

Definitions (per series, points sorted by time, one point per millisecond):

* bucket ``H`` = the hour containing the point; a row is produced for every
  bucket holding at least one point.
* average / max / min / count / sum / discrete_variance (population) over the
  points of the bucket.
* segments join consecutive points. Linear series interpolate between the
  two points; step series (``is_step``) hold the left value until the next
  point. A segment is clipped to each bucket it overlaps.
* interpolation = value at ``H`` (the point at ``H`` if there is one, else the
  segment covering ``H``; NULL before the first point).
  step_interpolation = value of the last point at or before ``H``.
* continuous_variance = S2/T - (S1/T)^2 over the clipped segment pieces of
  the bucket, with T = covered time, S1 = integral of v, S2 = integral of v^2,
  both taken around the bucket's first value, so a large offset doesn't cancel.
* total_variation = sum of |change| over the pieces of the bucket (linear), or
  the sum of the jumps at points inside the bucket (step).

Plan: points are partitioned by (series, hour); one window inside each
partition gives the within-hour segments and the same partitioning serves
the per-bucket aggregate (no second shuffle). A series-hour holds at most
3.6 M points (millisecond resolution), so even a series that owns a third
of all rows is spread over many tasks. The segments that cross bucket edges
are then stitched with a window over the bucket table (one row per output
row), partitioned by series.

``fill_empty`` adds the buckets without points between two points of a series
that are at most ``max_gap_ms`` apart: count 0, the aggregates of points NULL,
interpolations, variance and variation those of the one segment that crosses
the bucket. A bucket row generates the empty ones behind it, at most
``max_gap_ms / bucket_ms`` rows; longer silences stay without rows, and so do
the time before the first and after the last point.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HOUR_MS = 3600000


def _lin(v0, t0, v1, t1, t):
    """Linear value at ``t`` between (t0, v0) and (t1, v1)."""
    return v0 + (v1 - v0) * (t - t0).cast("double") / (t1 - t0).cast("double")


def _piece(va, vb, dt):
    """Integrals of a linear piece: (dt, int v, int v^2)."""
    dtd = dt.cast("double")
    return dtd, (va + vb) / 2 * dtd, (va * va + va * vb + vb * vb) / 3 * dtd


def hourly_aggregates(points: DataFrame, bucket_ms: int = HOUR_MS, dedup: bool = True,
                      time_weighted: bool = False, fill_empty: bool = False, max_gap_ms: int | None = None) -> DataFrame:
    """``points(id, external_id, timestamp, value, is_step)`` -> one row per (id, bucket).

    ``average`` is the mean of the bucket's points; with ``time_weighted`` it is
    the integral of the (linear or step) signal over the covered part of the
    bucket divided by the covered time (S1/T).

    With ``dedup`` several points of one series at the same millisecond are
    reduced to one (the largest value). The single hash partitioning on
    (id, hour) serves the dedup aggregate, the within-hour window and the
    bucket aggregate, so the points are shuffled once.
    """
    if fill_empty and max_gap_ms is None:
        raise ValueError("fill_empty needs max_gap_ms, the longest silence to fill")
    t, v = F.col("timestamp"), F.col("value")
    p = points.select("id", "external_id", "timestamp", "value",
                      F.coalesce("is_step", F.lit(False)).alias("is_step"),
                      (t - F.pmod(t, F.lit(bucket_ms))).alias("hour"))
    if dedup:
        p = (p.repartition("id", "hour")
             .groupBy("id", "hour", "timestamp")
             .agg(F.max("external_id").alias("external_id"), F.max("value").alias("value"),
                  F.max("is_step").alias("is_step")))
    w_in = Window.partitionBy("id", "hour").orderBy("timestamp")
    p = p.withColumn("nt", F.lead("timestamp").over(w_in)).withColumn("nv", F.lead("value").over(w_in))
    has_next = F.col("nt").isNotNull()
    step = F.col("is_step")
    nv_eff = F.when(step, v).otherwise(F.col("nv"))  # value at the right end of the piece
    p = p.withColumn("ref", F.first("value", ignorenulls=True).over(w_in))  # the bucket's first value, in every row that has one
    dt_in, s1_in, s2_in = _piece(v - F.col("ref"), nv_eff - F.col("ref"), F.col("nt") - t)
    zero = F.lit(0.0)
    b = p.groupBy("id", "hour").agg(
        F.max("external_id").alias("external_id"),
        F.max("is_step").alias("is_step"),
        F.avg("value").alias("average"),
        F.max("value").alias("max"),
        F.min("value").alias("min"),
        F.count("value").alias("count"),
        F.sum("value").alias("sum"),
        F.var_pop("value").alias("discrete_variance"),
        F.min("timestamp").alias("first_t"),
        F.min_by("value", "timestamp").alias("first_v"),
        F.max("ref").alias("ref"),
        F.max("timestamp").alias("last_t"),
        F.max_by("value", "timestamp").alias("last_v"),
        F.sum(F.when(has_next, dt_in).otherwise(zero)).alias("dt_in"),
        F.sum(F.when(has_next, s1_in).otherwise(zero)).alias("s1_in"),
        F.sum(F.when(has_next, s2_in).otherwise(zero)).alias("s2_in"),
        F.sum(F.when(has_next, F.abs(F.col("nv") - v)).otherwise(zero)).alias("tv_in"),
    )
    w_b = Window.partitionBy("id").orderBy("hour")
    b = (b.withColumn("prev_t", F.lag("last_t").over(w_b)).withColumn("prev_v", F.lag("last_v").over(w_b))
         .withColumn("next_t", F.lead("first_t").over(w_b)).withColumn("next_v", F.lead("first_v").over(w_b)))
    H = F.col("hour")
    step = F.col("is_step")
    first_t, first_v = F.col("first_t"), F.col("first_v")
    last_t, last_v = F.col("last_t"), F.col("last_v")
    prev_t, prev_v = F.col("prev_t"), F.col("prev_v")
    next_t, next_v = F.col("next_t"), F.col("next_v")
    end, ref = H + F.lit(bucket_ms), F.col("ref")
    # piece A: from the last point of the bucket to the bucket end (next point is later)
    a_vb = F.when(step, last_v).otherwise(_lin(last_v, last_t, next_v, next_t, end))
    a_dt, a_s1, a_s2 = _piece(last_v - ref, a_vb - ref, end - last_t)
    has_a = next_t.isNotNull()
    # piece B: from the bucket start to the first point (previous point is earlier)
    b_va = F.when(step, prev_v).otherwise(_lin(prev_v, prev_t, first_v, first_t, H))
    b_vb = F.when(step, prev_v).otherwise(first_v)
    b_dt, b_s1, b_s2 = _piece(b_va - ref, b_vb - ref, first_t - H)
    has_b = prev_t.isNotNull() & (first_t > H)
    T = F.col("dt_in") + F.when(has_a, a_dt).otherwise(zero) + F.when(has_b, b_dt).otherwise(zero)
    S1 = F.col("s1_in") + F.when(has_a, a_s1).otherwise(zero) + F.when(has_b, b_s1).otherwise(zero)
    S2 = F.col("s2_in") + F.when(has_a, a_s2).otherwise(zero) + F.when(has_b, b_s2).otherwise(zero)
    tv_a = F.when(has_a & ~step, F.abs(a_vb - last_v)).otherwise(zero)
    tv_b = (F.when(step & prev_t.isNotNull(), F.abs(first_v - prev_v))
            .when(~step & has_b, F.abs(b_vb - b_va)).otherwise(zero))
    interp = (F.when(first_t == H, first_v)
              .when(prev_t.isNotNull(), F.when(step, prev_v).otherwise(_lin(prev_v, prev_t, first_v, first_t, H))))
    step_interp = F.when(first_t == H, first_v).when(prev_t.isNotNull(), prev_v)
    cvar = F.when(T > 0, F.greatest(F.lit(0.0), S2 / T - (S1 / T) * (S1 / T)))
    average = F.when(T > 0, ref + S1 / T) if time_weighted else F.col("average")
    out = {"average": average, "max": F.col("max"), "min": F.col("min"), "count": F.col("count"), "sum": F.col("sum"),
           "interpolation": interp, "step_interpolation": step_interp, "continuous_variance": cvar,
           "discrete_variance": F.col("discrete_variance"), "total_variation": F.col("tv_in") + tv_a + tv_b}
    if not fill_empty:
        return b.select("id", "external_id", "hour", *[c.alias(k) for k, c in out.items()])
    next_hour = next_t - F.pmod(next_t, F.lit(bucket_ms))
    between = F.when((next_hour - H > bucket_ms) & (next_t - last_t <= F.lit(int(max_gap_ms))),
                     F.sequence(H + F.lit(bucket_ms), next_hour - F.lit(bucket_ms), F.lit(bucket_ms).cast("long")))
    b = b.withColumn("at", F.explode(F.concat(F.array(H), F.coalesce(between, F.array().cast("array<bigint>")))))
    at = F.col("at")
    opens = F.when(step, last_v).otherwise(_lin(last_v, last_t, next_v, next_t, at))
    closes = F.when(step, last_v).otherwise(_lin(last_v, last_t, next_v, next_t, at + F.lit(bucket_ms)))
    empty = {"average": (opens + closes) / 2 if time_weighted else F.lit(None).cast("double"), "count": F.lit(0).cast("long"),
             "interpolation": opens, "step_interpolation": last_v, "continuous_variance": (closes - opens) * (closes - opens) / 12,
             "total_variation": F.abs(closes - opens)}
    return b.select("id", "external_id", at.alias("hour"), *[
        F.when(at == H, c).otherwise(empty.get(k, F.lit(None).cast("double"))).alias(k) for k, c in out.items()])
