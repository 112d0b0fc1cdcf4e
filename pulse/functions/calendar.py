"""Rolling-year calendar expressions (all JVM-side, codegen friendly).

``as_of`` is always an explicit date so results are reproducible; it becomes a
literal that Catalyst folds.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _lit_date(as_of) -> Column:
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, dt.datetime):
        as_of = as_of.date()
    return F.lit(as_of).cast("date")


def _md(c: Column) -> Column:
    return F.month(c) * 100 + F.dayofmonth(c)


def years_ago(date_col: str | Column, as_of) -> Column:
    """Completed calendar years between ``date_col`` and ``as_of``.

    Symbolic age (year part of a y/m/d difference), truncated toward zero:
    a date in the future gives 0 within a year and negative values beyond.
    Not ``months_between/12``, which treats month ends as whole months.
    """
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    a = _lit_date(as_of)
    past = (F.year(a) - F.year(d)) - F.when(_md(d) > _md(a), 1).otherwise(0)
    future = -((F.year(d) - F.year(a)) - F.when(_md(a) > _md(d), 1).otherwise(0))
    return F.when(d <= a, past).when(d > a, future).cast("int")


def period_start(n: str | Column, as_of) -> Column:
    """as_of minus (n + 1) years; 29 Feb clamps to 28 Feb."""
    n = F.col(n) if isinstance(n, str) else n
    return F.add_months(_lit_date(as_of), -12 * (n + 1))


def period_end(n: str | Column, as_of) -> Column:
    """as_of minus n years minus one day."""
    n = F.col(n) if isinstance(n, str) else n
    return F.date_sub(F.add_months(_lit_date(as_of), -12 * n), 1)


def rolling_year(n: str | Column, as_of) -> Column:
    """Label of the rolling year = calendar year of its last day."""
    return F.year(period_end(n, as_of)).cast("int")


def in_last(n: str | Column, years: int = 6) -> Column:
    """1 when the bucket is within the last ``years`` rolling years, else 0 (NULL -> 0)."""
    n = F.col(n) if isinstance(n, str) else n
    return F.when(n < years, 1).otherwise(0).cast("int")


def may_be_in_last(date_col: str | Column, as_of, years: int) -> Column:
    """True for every date of the last ``years`` rolling years (and one day before them).

    A plain comparison with a literal, so that it reaches the scan; it only
    narrows what is read and stands beside the exact condition.
    """
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    return d >= F.add_months(_lit_date(as_of), -12 * years)


def may_be_in_rolling_year(date_col: str | Column, as_of: dt.date, label: int) -> Column:
    """True for every date whose rolling year has this label (future dates
    count into the bucket their negative age gives), as literal bounds for the scan."""
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    as_of = as_of.date() if isinstance(as_of, dt.datetime) else as_of
    n = as_of.year - label - (1 if (as_of.month, as_of.day) == (1, 1) else 0)
    newest = -n if n > 0 else 1 - n
    return ((d >= F.add_months(_lit_date(as_of), -12 * (n + 1)))
            & (d <= F.add_months(_lit_date(as_of), 12 * newest)))


def on_or_after_days(date_col: str | Column, as_of, days: int) -> Column:
    """date_col >= as_of - days (inclusive; future dates pass)."""
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    return d >= F.date_sub(_lit_date(as_of), days)


def ntz_lit(value) -> Column:
    """Wall-clock timestamp literal (``timestamp_ntz``) that does not depend on the
    session or driver time zone: built from ISO text, not from an instant."""
    if isinstance(value, dt.datetime):
        value = value.replace(tzinfo=None).isoformat(sep=" ")
    elif isinstance(value, dt.date):
        value = value.isoformat()
    return F.lit(value).cast("timestamp_ntz")


def ntz_to_instant(c) -> Column:
    """Zoned timestamp whose UTC reading equals the wall clock of ``c`` (NTZ),
    computed arithmetically so the session time zone plays no part."""
    c = F.col(c) if isinstance(c, str) else c
    micros = (F.unix_date(F.to_date(c)).cast("long") * 86_400_000_000
              + (F.hour(c) * 3600 + F.minute(c) * 60).cast("long") * 1_000_000
              + (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("long"))
    return F.timestamp_micros(micros)


def instant_day_ntz(c) -> Column:
    """UTC calendar day of a zoned timestamp, as a midnight ``timestamp_ntz``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.date_from_unix_date(F.floor(F.unix_micros(c) / 86_400_000_000).cast("int")).cast("timestamp_ntz")


def half_open_day(ts_col: str | Column, as_of: dt.datetime | dt.date) -> Column:
    """Yesterday 00:00 (inclusive) to today 00:00 (exclusive) relative to as_of.

    Written as plain comparisons against literals so Parquet row-group and
    partition pruning apply.
    """
    day = as_of.date() if isinstance(as_of, dt.datetime) else as_of
    end = dt.datetime.combine(day, dt.time())
    start = end - dt.timedelta(days=1)
    t = F.col(ts_col) if isinstance(ts_col, str) else ts_col
    return (t >= ntz_lit(start)) & (t < ntz_lit(end))


def with_rolling_year(df, date_col: str, as_of, years_col="years_ago", flag_years: int = 6,
                      flag_col: str = "in_last_6"):
    """Add years_ago, period_start, period_end, rolling_year and the recent flag."""
    return (df.withColumn(years_col, years_ago(date_col, as_of))
              .withColumn("period_start", period_start(years_col, as_of))
              .withColumn("period_end", period_end(years_col, as_of))
              .withColumn("rolling_year", rolling_year(years_col, as_of))
              .withColumn(flag_col, in_last(years_col, flag_years)))
