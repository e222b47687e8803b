"""Zone-less time columns: rounding, minute counting, text styles and the reporting window."""

from __future__ import annotations

import calendar
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def stamp_literal(value: datetime) -> Column:
    # As text: a datetime literal would be a zoned timestamp.
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def _drop_seconds(c: Column) -> Column:
    # Interval arithmetic, because date_trunc would go through the session time zone.
    zero = F.lit(0)
    return c - F.make_dt_interval(zero, zero, zero, F.extract(F.lit("SECOND"), c))


def round_to_minute(c) -> Column:
    """Nearest minute, half a minute up; 23:59:30 and later becomes the next midnight."""
    return _drop_seconds(_col(c).cast("timestamp_ntz") + F.expr("INTERVAL '30' SECOND"))


def round_to_second(c) -> Column:
    shifted = _col(c).cast("timestamp_ntz") + F.expr("INTERVAL '0.5' SECOND")
    seconds = F.extract(F.lit("SECOND"), shifted)
    zero = F.lit(0)
    return shifted - F.make_dt_interval(zero, zero, zero, seconds - F.floor(seconds))


def minutes_between(start, end) -> Column:
    """Minute boundaries crossed: 10:00:59 to 10:01:01 is 1."""
    gap = _drop_seconds(_col(end).cast("timestamp_ntz")) - _drop_seconds(
        _col(start).cast("timestamp_ntz")
    )
    return gap.cast("interval minute").cast("int")


def stamp_text(c, style: str = "stamp", blank: bool = True) -> Column:
    """Text of a stamp; null becomes '' unless `blank` is off.

    Styles: "stamp" 2024-03-09 14:05:07, "minute" 2024-03-09 14:05, "us_date" 03/09/2024 and
    "clock" 14:05:07. Built from the zone-less cast, so no session time zone is involved.
    """
    full = _col(c).cast("timestamp_ntz").cast("string")
    if style == "us_date":
        text = F.concat_ws("/", full.substr(6, 2), full.substr(9, 2), full.substr(1, 4))
        text = F.when(full.isNotNull(), text)
    else:
        begin, width = {"stamp": (1, 19), "minute": (1, 16), "clock": (12, 8)}[style]
        text = full.substr(begin, width)
    return F.coalesce(text, F.lit("")) if blank else text


def report_window(
    run_date: date,
    back_days: int,
    fwd_months: int | None = None,
    start: datetime | None = None,
    end: datetime | None = None,
) -> tuple[datetime, datetime]:
    """Closed reporting interval for a run.

    It opens `back_days` before the run date. It closes at the end of the month `fwd_months`
    ahead, or of the run date itself when that is None. The closing bound is the following
    midnight, because a day's last second rounds up to it at minute precision.
    """
    midnight = time()
    if start is None:
        start = datetime.combine(run_date - timedelta(days=back_days), midnight)
    if end is None:
        last = run_date
        if fwd_months is not None:
            months = run_date.year * 12 + run_date.month - 1 + fwd_months
            year, month = divmod(months, 12)
            last = date(year, month + 1, calendar.monthrange(year, month + 1)[1])
        end = datetime.combine(last + timedelta(days=1), midnight)
    return start, end


def report_window_columns(
    run_date, back_days: int, fwd_months: int | None = None
) -> tuple[Column, Column]:
    """The default window of `report_window`, for a column of run dates."""
    day = _col(run_date)
    last = day if fwd_months is None else F.last_day(F.add_months(day, fwd_months))
    start, end = F.date_sub(day, back_days), F.date_add(last, 1)
    return start.cast("timestamp_ntz"), end.cast("timestamp_ntz")
