"""Dates, times of day, ages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spinewise.functions.missing import col, if_else

# The usual date layout of each field order, and others accepted once separators are '/'.
USUAL_LAYOUT = {"dmy": "dd/MM/yyyy", "ymd": "yyyy-MM-dd"}
DATE_LAYOUTS = {
    "dmy": ["d/M/yyyy", "d/MMM/yyyy", "d/MMMM/yyyy", "ddMMyyyy"],
    "ymd": ["yyyy/M/d", "yyyy/MMM/d", "yyyy/MMMM/d", "yyyyMMdd"],
}
# The shape of text in the usual layouts, and the places of year, month and day in it. Such text is
# parsed by a plain cast, which takes a fraction of the time of a parse by layout. Year 0 is left to the latter.
PLAIN_SHAPES = {
    "dd/MM/yyyy": (r"^[0-9]{2}/[0-9]{2}/(?!0000)[0-9]{4}$", (7, 4), (4, 2), (1, 2)),
    "yyyy-MM-dd": (r"^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}$", (1, 4), (6, 2), (9, 2)),
}
PLAIN_TIMESTAMP = r"^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"
# Timestamp layouts accepted, after separators are made '/', ' ' and ':'.
TIMESTAMP_LAYOUTS = ["yyyy/M/d H:m:s[.SSSSSS]", "yyyyMMddHHmmss"]


def _as_layout(text: Column, layout: str) -> Column:
    """Text to date with one layout, by a cast where its shape allows."""
    parsed = F.try_to_date(text, layout)
    if layout not in PLAIN_SHAPES:
        return parsed
    shape, *parts = PLAIN_SHAPES[layout]
    iso = text if layout == "yyyy-MM-dd" else F.concat_ws("-", *[F.substring(text, at, n) for at, n in parts])
    # "$" also stands before a last line break.
    plain = text.rlike(shape) & (F.length(text) == 10)
    return F.when(plain, iso.try_cast("date")).otherwise(parsed)


def parse_date(c: Column | str, order: str = "dmy") -> Column:
    """Text to date in day-month-year or year-month-day order; anything else becomes null.

    The usual layout is tried on the text as it is, so the common case costs one parse.
    """
    raw = col(c).cast("string")
    text = F.regexp_replace(F.trim(raw), r"[^0-9A-Za-z]+", "/")
    others = [F.try_to_date(text, layout) for layout in DATE_LAYOUTS[order]]
    return F.coalesce(_as_layout(raw, USUAL_LAYOUT[order]), *others)


def parse_date_as(c: Column | str, layout: str) -> Column:
    """Text to date with one explicit layout; anything else becomes null."""
    return _as_layout(col(c).cast("string"), layout)


def parse_timestamp(c: Column | str) -> Column:
    """Year-month-day hour-minute-second text to timestamp; anything else becomes null."""
    raw = col(c).cast("string")
    plain = raw.rlike(PLAIN_TIMESTAMP) & (F.length(raw) == 19)
    text = F.regexp_replace(F.trim(raw), r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})[T ]+", "$1/$2/$3 ")
    text = F.regexp_replace(text, r"(Z|\+00:?00)$", "")
    others = F.coalesce(*[F.try_to_timestamp(text, F.lit(layout)) for layout in TIMESTAMP_LAYOUTS])
    return F.when(plain, raw.try_cast("timestamp")).otherwise(others)


def parse_year_month(c: Column | str) -> Column:
    """A YYYYMM number to the first day of that month."""
    c = col(c).cast("int")
    return F.when(c.isNotNull(), F.try_to_date(F.format_string("%06d01", c), "yyyyMMdd"))


def format_dmy(c: Column | str) -> Column:
    return F.date_format(col(c), "dd/MM/yyyy")


def seconds_of_day(c: Column | str) -> Column:
    """'HH:mm:ss' or 'H:mm:ss' text to seconds since midnight; null if it is not a time of day."""
    text = F.lpad(col(c).cast("string"), 8, "0")
    hours, minutes, seconds = [F.substring(text, i, 2).cast("int") for i in (1, 4, 7)]
    return F.when(text.rlike(r"^([01]\d|2[0-3]):[0-5]\d:[0-5]\d$"), hours * 3600 + minutes * 60 + seconds)


def out_of_hours_by_hour(ts: Column | str) -> Column:
    """Hour 18 or later, or before 8: 18:00:00 itself is out of hours."""
    hour = F.hour(col(ts))
    return (hour >= 18) | (hour < 8)


def out_of_hours_by_time(seconds: Column | str) -> Column:
    """After 18:00:00 or before 08:00:00 in seconds of the day: 18:00:00 itself is in hours."""
    seconds = col(seconds)
    return (seconds > 18 * 3600) | (seconds < 8 * 3600)


def days_apart(a: Column | str, b: Column | str) -> Column:
    return F.abs(F.datediff(col(a), col(b)))


def within_lookback(date: Column | str, anchor: Column | str, days: int = 365) -> Column:
    """Date on the anchor or up to ``days`` days before it, both ends in; null if either is."""
    date, anchor = col(date), col(anchor)
    return date.between(F.date_sub(anchor, days), anchor)


def cap_date(c: Column | str, end: str) -> Column:
    """Dates on or after ``end`` become null."""
    c = col(c)
    return if_else(c >= F.lit(end).cast("date"), F.lit(None).cast("date"), c)


def ceil_day(c: Column | str) -> Column:
    """First midnight at or after a moment, so that ``moment <= day`` equals ``ceil_day <= day``."""
    c = col(c)
    day = c.cast("date")
    return F.when(c.cast("timestamp_ntz") > day.cast("timestamp_ntz"), F.date_add(day, 1)).otherwise(day)


def age_years(birth: Column | str, at: Column | str) -> Column:
    """Completed years plus the part of the running year, by days since the last birthday."""
    birth, at = col(birth), col(at)
    span = F.year(at) - F.year(birth)
    years = span - (F.add_months(birth, span * 12) > at).cast("int")
    last = F.add_months(birth, years * 12)
    following = F.add_months(birth, (years + 1) * 12)
    return years + F.datediff(at, last) / F.datediff(following, last)
