"""Filters and predicates (allow/deny lists, data-set filter, time windows).

Config lists live on the driver (they come from a job config file); short
lists become ``isin`` literals that reach the Parquet scan as pushed
filters, longer ones a semi/anti join against a frame of the list, which is
broadcast only up to the size limit of other dimensions.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import col, full_match
from . import joins
from .joins import list_frame, sized_broadcast

ISIN_MAX = 1000
# Fixed value: start of full-history reads (1971-01-01T00:00:00Z).
FULL_HISTORY_START_MS = 31536000000


def allow_deny(c, allow: list[str], deny: list[str]) -> Column:
    """Deny wins; then "*" or exact membership. Empty allow => nothing.

    NULL keys are handled explicitly, so "*" also admits rows without a key.
    """
    c = col(c)
    kept = (c.isNull() | ~c.isin(list(deny))) if deny else F.lit(True)
    if "*" in allow:
        return kept
    # plain terms, so that both lists reach the scan as pushed filters; a NULL result drops the row like false
    return kept & c.isin(list(allow)) if allow else F.lit(False)


def allow_deny_frame(df: DataFrame, key: str, allow: list[str], deny: list[str]) -> DataFrame:
    """D2-D4, E9 on a frame, with the result of ``allow_deny`` whatever the length of the lists."""
    if len(allow) + len(deny) <= ISIN_MAX:
        return df.filter(allow_deny(key, allow, deny))
    out = df
    if deny:
        out = out.join(_list_side(df, key, deny), key, "left_anti")
    if "*" not in allow:
        out = out.join(_list_side(df, key, allow), key, "left_semi")
    return out


def _list_side(df: DataFrame, key: str, values: list[str]) -> DataFrame:
    """A list as a join side; its size is known here, so the choice needs no job."""
    side = list_frame(df.sparkSession, sorted(set(values)), key)
    small = len(values) <= joins.BROADCAST_MAX_ROWS and sum(len(v.encode()) for v in values) <= joins.BROADCAST_MAX_BYTES
    return F.broadcast(side) if small else side.hint("merge")


def regex_allow_deny(c, allow: list[str], allow_regex: list[str],
                     deny: list[str], deny_regex: list[str]) -> Column:
    """Exact deny -> regex deny -> "*" -> exact allow -> regex allow.

    Regexes must match the whole external id. The exact and the regex allow
    lists are unioned (boolean OR). Rows without an external id are only
    admitted by "*".
    """
    # plain terms as in ``allow_deny``: exact lists reach the scan wherever no regex is joined to them by OR
    c = col(c)
    kept = (c.isNull() | ~c.isin(list(deny))) if deny else F.lit(True)
    for rx in deny_regex:
        kept = kept & (c.isNull() | ~full_match(c, rx))
    if "*" in allow:
        return kept
    allowed = c.isin(list(allow)) if allow else F.lit(False)
    for rx in allow_regex:
        allowed = allowed | full_match(c, rx)
    return kept & allowed


def data_set_filter(df: DataFrame, data_sets: DataFrame, allow: list[str],
                    column: str = "data_set_id") -> DataFrame:
    """Keep rows whose data set external id is allowed. Empty or "*" => all rows."""
    if not allow or "*" in allow:
        return df
    ids = (data_sets.filter(F.col("external_id").isin(list(allow)))
           .select(F.col("id").alias(column)).distinct())
    return df.join(sized_broadcast(ids), column, "left_semi")


def series_security_filter(headers: DataFrame, reserved_prefix: str,
                           drop_string_series: bool = False) -> DataFrame:
    """Drop series with security categories or a reserved name prefix
    (and string series when numeric aggregates are wanted)."""
    cond = (F.size(F.coalesce("security_categories", F.array())) == 0) & \
        ~F.coalesce(F.col("name"), F.lit("")).startswith(reserved_prefix)
    if drop_string_series:
        cond = cond & ~F.coalesce(F.col("is_string"), F.lit(False))
    return headers.filter(cond)


# ------------------------------------------------------------------ windows
def _utc(run_time) -> datetime:
    if isinstance(run_time, str):
        run_time = datetime.fromisoformat(run_time.replace("Z", "+00:00"))
    if run_time.tzinfo is None:
        run_time = run_time.replace(tzinfo=timezone.utc)
    return run_time.astimezone(timezone.utc)


def to_ms(t) -> int:
    return int(_utc(t).timestamp() * 1000)


def window_previous_hour(run_time) -> tuple[int, int]:
    """[trunc_hour(now) - 1h - 10min, now] in epoch millis."""
    now = _utc(run_time)
    start = now.replace(minute=0, second=0, microsecond=0) - timedelta(hours=1, minutes=10)
    return to_ms(start), to_ms(now)


def window_last_days(run_time, days: int = 4) -> tuple[int, None]:
    """[trunc_day(now) - days, open end)."""
    now = _utc(run_time)
    start = now.replace(hour=0, minute=0, second=0, microsecond=0) - timedelta(days=days)
    return to_ms(start), None


def window_config_days(run_time, days: int = 1) -> tuple[int, int]:
    """[trunc_day(now) - N days - 1h, now]; N < 0 => full history from 1971."""
    now = _utc(run_time)
    if days < 0:
        return FULL_HISTORY_START_MS, to_ms(now)
    start = now.replace(hour=0, minute=0, second=0, microsecond=0) - timedelta(days=days, hours=1)
    return to_ms(start), to_ms(now)


def in_window(c, window: tuple[int, int | None]) -> Column:
    """Literal bounds, so the predicate is pushed into the Parquet scan."""
    c = col(c)
    lo, hi = window
    cond = c >= F.lit(lo)
    if hi is not None:
        cond = cond & (c <= F.lit(hi))
    return cond


def filter_window(df: DataFrame, c: str, window: tuple[int, int | None]) -> DataFrame:
    """Time-window filter; on day-partitioned tables (``p_date``) the matching
    partition predicate is added so whole days are pruned before any file is
    opened (Catalyst does not derive it from the timestamp predicate)."""
    df = df.filter(in_window(c, window))
    if "p_date" in df.columns:
        lo, hi = window
        day = lambda ms: datetime.fromtimestamp(ms / 1000, tz=timezone.utc).date().isoformat()
        df = df.filter(F.col("p_date") >= F.lit(day(lo)).cast("date"))
        if hi is not None:
            df = df.filter(F.col("p_date") <= F.lit(day(hi)).cast("date"))
    return df
