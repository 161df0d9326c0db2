"""Data-quality repair rules applied before writing to a target."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import (DESCRIPTION_LIMIT, cap_end_time, clamp_value, clean_file_name,
                                 put_metadata, truncate_text)

# Metadata keys and notes written by the repair rules.
START_KEY = "constraintViolationStartTime_b"
END_KEY = "constraintViolationEndTime_b"
DESCRIPTION_KEY = "constraintViolationDescription"
ORIGINAL_FILE_NAME_KEY = "originalFileName"
START_NEGATIVE_NOTE = "startTime was < 0. Setting startTime to 0L."
END_NEGATIVE_NOTE = "endTime was < 0. Set endTime to be equal to startTime"
START_AFTER_END_NOTE = "startTime was greater than endTime. Changed startTime to be equal to endTime."
DESCRIPTION_NOTE = ("Description length was >500 characters. "
                    "Truncated the description to the first 500 characters.")


def event_rules(df: DataFrame) -> DataFrame:
    """K8-K11, in order, each recording a note in ``metadata``.

    K8  start < 0            => start = 0
    K9  end < 0              => end = start (0 when start is unset)
    K10 start > end, both set => start = end
    K11 description > 500    => first 500 characters
    An unset time compares as 0, so it never triggers K8/K9.
    """
    s0, e0 = F.col("start_time"), F.col("end_time")
    k8 = F.coalesce(s0 < 0, F.lit(False))
    df = (df.withColumn("__k8", k8)
          .withColumn("start_time", F.when(k8, F.lit(0).cast("long")).otherwise(s0)))
    s1 = F.col("start_time")
    k9 = F.coalesce(e0 < 0, F.lit(False))
    df = (df.withColumn("__k9", k9)
          .withColumn("end_time", F.when(k9, F.coalesce(s1, F.lit(0).cast("long"))).otherwise(e0)))
    e1 = F.col("end_time")
    k10 = s1.isNotNull() & e1.isNotNull() & (s1 > e1)
    df = (df.withColumn("__k10", k10)
          .withColumn("start_time", F.when(k10, e1).otherwise(s1)))
    k11 = F.coalesce(F.length("description") > DESCRIPTION_LIMIT, F.lit(False))
    df = (df.withColumn("__k11", k11)
          .withColumn("description", F.when(k11, truncate_text("description")).otherwise(F.col("description"))))
    m = F.col("metadata")
    m = F.when(F.col("__k8"), put_metadata(m, START_KEY, START_NEGATIVE_NOTE)).otherwise(m)
    m = F.when(F.col("__k9"), put_metadata(m, END_KEY, END_NEGATIVE_NOTE)).otherwise(m)
    m = F.when(F.col("__k10"), put_metadata(m, START_KEY, START_AFTER_END_NOTE)).otherwise(m)
    m = F.when(F.col("__k11"), put_metadata(m, DESCRIPTION_KEY, DESCRIPTION_NOTE)).otherwise(m)
    return df.withColumn("metadata", m).drop("__k8", "__k9", "__k10", "__k11")


def cap_event_end(df: DataFrame) -> DataFrame:
    """K6: clamp end_time to the largest accepted instant."""
    return df.withColumn("end_time", cap_end_time("end_time"))


def clamp_points(df: DataFrame, column: str = "value") -> DataFrame:
    """K7: numeric point values clamped to +-1e100."""
    return df.withColumn(column, clamp_value(column))


def clean_file_names(df: DataFrame) -> DataFrame:
    """K12: '/' and '\\' -> '-' in file names; the original name is kept in
    metadata under ``originalFileName`` when it changed."""
    cleaned = clean_file_name("name")
    changed = F.coalesce(cleaned != F.col("name"), F.lit(False))
    return (df.withColumn("metadata", F.when(changed, put_metadata("metadata", ORIGINAL_FILE_NAME_KEY, F.col("name")))
                          .otherwise(F.col("metadata")))
            .withColumn("name", F.when(changed, cleaned).otherwise(F.col("name"))))
