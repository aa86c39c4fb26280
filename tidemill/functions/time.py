"""Time columns.

Event times travel as epoch **milliseconds** (LONG).  Wall-clock values are
``TIMESTAMP_NTZ`` so nothing depends on the session time zone: a zone is always an
explicit argument (default ``"UTC"``).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

__all__ = [
    "EPOCH_NTZ", "DAY_MS", "HOUR_MS", "ms_to_wall", "wall_to_ms", "ms_to_date_str",
    "ms_to_datetime_str", "ms_to_date_key", "datetime_str_to_ms", "date_str_to_ms",
    "format_wall", "stat_hour_ms", "stat_day_ms", "day_list", "to_millis",
    "days_since_date", "ms_to_event_time", "json_time_field", "first_present_time",
    "head_element_time", "window_bounds",
]

DAY_MS = 86_400_000
HOUR_MS = 3_600_000


def EPOCH_NTZ() -> Column:  # noqa: N802 - a constant built lazily (needs a session)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ms_to_wall(ms, tz: str = "UTC") -> Column:
    """Epoch ms -> wall clock (TIMESTAMP_NTZ) in zone ``tz``."""
    utc = F.timestamp_add("MILLISECOND", _c(ms), EPOCH_NTZ())
    return utc if tz in ("UTC", "+00:00", "Z") else F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def wall_to_ms(wall, tz: str = "UTC") -> Column:
    """Wall clock (TIMESTAMP_NTZ, read in zone ``tz``) -> epoch ms."""
    w = _c(wall).cast("timestamp_ntz")
    if tz not in ("UTC", "+00:00", "Z"):
        w = F.convert_timezone(F.lit(tz), F.lit("UTC"), w)
    return F.timestamp_diff("MILLISECOND", EPOCH_NTZ(), w)


def ms_to_date_str(ms, tz: str = "UTC") -> Column:
    """epoch ms -> ``yyyy-MM-dd``."""
    return F.date_format(ms_to_wall(ms, tz), "yyyy-MM-dd")


def ms_to_datetime_str(ms, tz: str = "UTC") -> Column:
    """epoch ms -> ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(ms_to_wall(ms, tz), "yyyy-MM-dd HH:mm:ss")


def ms_to_date_key(ms, tz: str = "UTC") -> Column:
    """epoch ms -> ``yyyyMMdd`` (the keyword job's ``cur_date``)."""
    return F.date_format(ms_to_wall(ms, tz), "yyyyMMdd")


def datetime_str_to_ms(s, tz: str = "UTC") -> Column:
    """``yyyy-MM-dd HH:mm:ss`` in zone ``tz`` -> epoch ms."""
    return wall_to_ms(F.to_timestamp_ntz(_c(s), F.lit("yyyy-MM-dd HH:mm:ss")), tz)


def date_str_to_ms(s, tz: str = "UTC") -> Column:
    """``yyyy-MM-dd`` (midnight in ``tz``) -> epoch ms."""
    return wall_to_ms(F.to_date(_c(s)).cast("timestamp_ntz"), tz)


def format_wall(ts, pattern: str) -> Column:
    """format a wall-clock timestamp with a datetime pattern."""
    return F.date_format(_c(ts), pattern)


def stat_hour_ms(ms, tz: str = "UTC") -> Column:
    """truncate the UTC wall clock to the hour, read it in ``tz``, back to ms."""
    return wall_to_ms(F.date_trunc("hour", ms_to_wall(ms, "UTC")).cast("timestamp_ntz"), tz)


def stat_day_ms(ms, tz: str = "UTC") -> Column:
    """as F5 at day granularity."""
    return wall_to_ms(F.date_trunc("day", ms_to_wall(ms, "UTC")).cast("timestamp_ntz"), tz)


def day_list(start_date, end_date) -> Column:
    """inclusive list of days as ``yyyyMMdd`` ints (partition-range helper)."""
    seq = F.sequence(F.to_date(_c(start_date)), F.to_date(_c(end_date)), F.expr("interval 1 day"))
    return F.transform(seq, lambda d: F.date_format(d, "yyyyMMdd").cast("int"))


def to_millis(t) -> Column:
    """a time that is epoch seconds (< 1e10) or ms -> ms."""
    t = _c(t).cast("long")
    return F.when(t < F.lit(10_000_000_000), t * 1000).otherwise(t)


def days_since_date(ms, date_str, tz: str = "UTC") -> Column:
    """whole days between ``ms`` and midnight of ``date_str`` (truncating)."""
    diff = _c(ms) - date_str_to_ms(date_str, tz)
    # Java long division truncates toward zero.
    return F.when(diff >= 0, F.floor(diff / F.lit(DAY_MS))).otherwise(F.ceil(diff / F.lit(DAY_MS))).cast("long")


def ms_to_event_time(ms) -> Column:
    """F18 ``TO_TIMESTAMP_LTZ(ms, 3)``: epoch ms -> TIMESTAMP (for watermarks)."""
    return F.timestamp_millis(_c(ms))


def json_time_field(json_col, field: str, scale_to_ms: int = 1000) -> Column:
    """Read ``field`` (seconds) from a JSON string; missing/invalid -> 0."""
    v = F.get_json_object(_c(json_col), f"$.{field}").try_cast("long")
    return F.coalesce(v, F.lit(0)) * F.lit(scale_to_ms)


def first_present_time(json_col, first: str = "block_timestamp", second: str = "timestamp") -> Column:
    """The first present of two epoch-seconds fields, as ms."""
    a = F.get_json_object(_c(json_col), f"$.{first}").try_cast("long")
    b = F.get_json_object(_c(json_col), f"$.{second}").try_cast("long")
    return F.coalesce(a, b, F.lit(0)) * 1000


def head_element_time(arr_col, field: str = "window_start_time") -> Column:
    """Event time carried by the head element of a list of structs."""
    return F.element_at(_c(arr_col), 1).getField(field)


def window_bounds(window_col: str = "window") -> list[Column]:
    """``stt``, ``edt`` (``yyyy-MM-dd HH:mm:ss``) and ``cur_date`` from a window struct."""
    w = F.col(window_col)
    return [
        F.date_format(w.start, "yyyy-MM-dd HH:mm:ss").alias("stt"),
        F.date_format(w.end, "yyyy-MM-dd HH:mm:ss").alias("edt"),
        F.date_format(w.start, "yyyy-MM-dd").alias("cur_date"),
    ]
