"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(ts: str | Column) -> Column:
    """Whole seconds since 1970 of a timestamp without zone, independent of the session zone."""
    ts = _col(ts).cast("timestamp_ntz")
    days = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def boundary_diff(part: str, start: str | Column, end: str | Column) -> Column:
    """Number of calendar boundaries of ``part`` crossed between two times."""
    start, end = _col(start), _col(end)
    if part == "year":
        return (F.year(end) - F.year(start)).cast("bigint")
    if part == "month":
        months = [F.year(x) * 12 + F.month(x) for x in (start, end)]
        return (months[1] - months[0]).cast("bigint")
    if part == "day":
        return F.datediff(end, start).cast("bigint")
    seconds = {"hour": 3600, "minute": 60, "second": 1}[part]
    steps = [F.floor(epoch_seconds(x) / seconds) for x in (start, end)]
    return steps[1] - steps[0]


def grid_start(ts: str | Column, step_seconds: int) -> Column:
    """Start of the grid cell (counted from midnight) a timestamp falls into."""
    ts = _col(ts)
    day = F.date_trunc("day", ts)
    in_day = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    cell = F.floor(in_day / step_seconds) * step_seconds
    return (day + F.make_dt_interval(secs=cell.cast("decimal(18,6)"))).cast("timestamp_ntz")


def to_zone(ts: str | Column, from_zone: str, to_zone_name: str) -> Column:
    """Wall-clock time in another zone."""
    return F.convert_timezone(F.lit(from_zone), F.lit(to_zone_name), _col(ts).cast("timestamp_ntz"))
