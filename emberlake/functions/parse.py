"""Parsing and formatting of the text fields of the feeds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day formats used by the records and reports.
DAY_FORMAT_CSV = "d/M/yy"          # climate CSV, e.g. 2/1/18
DAY_FORMAT_REPORT = "dd/MM/yyyy"   # fires per day, average per day
DAY_FORMAT_LABEL = "d/MM/yy"       # rolling-extremes labels, e.g. 2/01/18
DAY_FORMAT_HOTSPOT = "d/MM/yyyy"   # day key of the hotspot CSV


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Fixed value: two-digit years 69-99 are 1969-1999, 00-68 are 2000-2068
# (the POSIX ``%y`` rule); Spark's ``yy`` alone maps every year to 20xx.
TWO_DIGIT_YEAR_PIVOT = 69


def parse_day(c: Column | str, fmt: str = DAY_FORMAT_CSV) -> Column:
    """Day text to DATE; unparsable text gives NULL (routed to rejects)."""
    d = F.try_to_date(_c(c), fmt)
    if "yy" in fmt and "yyy" not in fmt:
        d = F.when(F.year(d) >= 2000 + TWO_DIGIT_YEAR_PIVOT, F.add_months(d, -1200)).otherwise(d)
    return d


def parse_iso_timestamp(c: Column | str) -> Column:
    """ISO-8601 local date-time text (``2019-01-01T04:16:51``) to TIMESTAMP_NTZ.

    Cast straight to TIMESTAMP_NTZ: no session time zone is involved, so a
    wall-clock time inside a daylight-saving gap keeps its value.
    """
    return F.trim(_c(c)).try_cast("timestamp_ntz")


def split_precipitation(c: Column | str) -> tuple[Column, Column]:
    """Split text like `` 0.02G`` into (amount DOUBLE, type STRING).

    All spaces are dropped; the last character is the flag and the rest the
    amount.  A non-numeric amount gives NULL.
    """
    s = F.regexp_replace(_c(c), " ", "")
    kind = F.when(F.length(s) > 0, F.right(s, F.lit(1)))
    amount = F.left(s, F.length(s) - 1).try_cast("double")
    return amount, kind


def iso_text(c: Column | str) -> Column:
    """TIMESTAMP_NTZ to ISO-8601 text (``2019-01-01T04:16:51[.ffffff]``).

    Goes through the NTZ string cast, which involves no time zone
    (``date_format`` would pass through the session zone and move wall-clock
    times inside a daylight-saving gap).
    """
    return F.regexp_replace(_c(c).cast("timestamp_ntz").cast("string"), " ", "T")


_UNIT_MICROS = {"second": 10**6, "minute": 60 * 10**6, "hour": 3600 * 10**6,
                "day": 86400 * 10**6}
_DAY_MICROS = 86400 * 10**6


def wall_micros(c: Column | str) -> Column:
    """Micros since 1970-01-01 00:00 of a TIMESTAMP_NTZ wall clock.

    Built from the date and the hour/minute/second fields, which read the
    wall clock as is (``timestamp_diff`` would pass through the session zone).
    """
    t = _c(c).cast("timestamp_ntz")
    days = F.datediff(t.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    whole = (days * 86400 + F.hour(t) * 3600 + F.minute(t) * 60).cast("long") * 1_000_000
    return whole + (F.date_part(F.lit("SECOND"), t) * 1_000_000).cast("long")


def ntz_from_micros(us: Column) -> Column:
    """The TIMESTAMP_NTZ wall clock ``us`` micros after 1970-01-01 00:00
    (NTZ plus a day-time interval involves no time zone)."""
    days = F.floor(us / F.lit(_DAY_MICROS)).cast("int")
    rest = (F.pmod(us, F.lit(_DAY_MICROS)) / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(days=days, secs=rest)


def trunc_ntz(c: Column | str, unit: str) -> Column:
    """Truncate a TIMESTAMP_NTZ to a fixed unit (second .. day) on its wall
    clock, with micros arithmetic: no session time zone is involved."""
    step = _UNIT_MICROS.get(unit.lower())
    if step is None:
        return F.date_trunc(unit, _c(c)).cast("timestamp_ntz")
    us = wall_micros(c)
    return ntz_from_micros(us - F.pmod(us, F.lit(step)))


def format_day(c: Column | str, fmt: str = DAY_FORMAT_REPORT) -> Column:
    return F.date_format(_c(c), fmt)
