"""Time parsing and zone conversion (FN-7, FN-8, FN-10, FN-11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Leading date-time of a text field for each supported format: the regex
# captures the fields, the tuple says which group is year, month, day, hour,
# minute, second.  R's strptime accepts one- or two-digit fields and ignores
# whatever follows the format (".000", " UTC", ...); so do these.
_FORMATS = {
    "M/d/yyyy H:mm:ss": (r"^\s*(\d{1,2})/(\d{1,2})/(\d{4}) (\d{1,2}):(\d{1,2}):(\d{1,2})",
                         (3, 1, 2, 4, 5, 6)),
    "yyyy-M-d H:mm:ss": (r"^\s*(\d{4})-(\d{1,2})-(\d{1,2}) (\d{1,2}):(\d{1,2}):(\d{1,2})",
                         (1, 2, 3, 4, 5, 6)),
    # %H:%M:%S %d-%b-%Y: the blank that ends the format matches any blanks, or none.
    "H:mm:ss d-MMM-yyyy": (r"^\s*(\d{1,2}):(\d{1,2}):(\d{1,2})\s+(\d{1,2})-([A-Za-z]+)-(\d{4})",
                           (6, 5, 4, 1, 2, 3)),
}
# The usual form of a format, where every field has its place: a pattern, and
# where each group of the regex above begins and its length.
_FIXED = {
    "H:mm:ss d-MMM-yyyy": (r"^\d{2}:\d{2}:\d{2} \d{2}-[A-Za-z]{3}-\d{4}",
                           ((1, 2), (4, 2), (7, 2), (10, 2), (13, 3), (17, 4))),
}
_MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september",
           "october", "november", "december"]


def _month_number(name: Column) -> Column:
    """1 to 12 of an English month name, whole or its first three letters, in
    any case; null for another word."""
    numbers = [F.lit(v) for i, month in enumerate(_MONTHS, 1) for v in (month, i)]
    short = [F.lit(v) for i, month in enumerate(_MONTHS, 1) if month != month[:3] for v in (month[:3], i)]
    # Lower case takes Spark longer than all else here: the usual form needs none.
    usual = [F.lit(v) for i, month in enumerate(_MONTHS, 1) for v in (month[:3].capitalize(), i)]
    return F.coalesce(F.try_element_at(F.create_map(*usual), name),
                      F.try_element_at(F.create_map(*numbers, *short), F.lower(name)))


def parse_r_time(c: Column, fmt: str) -> Column:
    """``as.POSIXct(x, format=...)`` read as UTC wall time: one- and two-digit
    fields parse, trailing text is ignored, blank, malformed or impossible
    values (month 13, 30 February) are null.  Returns ``timestamp_ntz``.

    The value is assembled from its fields (``try_make_timestamp_ntz``), so
    it never passes through the session time zone.
    """
    if fmt not in _FORMATS:
        return F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp_ntz")
    pattern, order = _FORMATS[fmt]
    text = [F.regexp_extract(c, pattern, g) for g in order]
    if fmt in _FIXED:  # one pattern instead of six
        usual, places = _FIXED[fmt]
        text = [F.when(c.rlike(usual), F.substring(c, *places[g - 1])).otherwise(t) for g, t in zip(order, text)]
    part = [t.try_cast("int") for t in text]
    if "MMM" in fmt:
        part[1] = _month_number(text[1])
    year, month, day, hour, minute, second = part
    return F.try_make_timestamp_ntz(year, month, day, hour, minute, second.cast("decimal(8,6)"))


def add_hours(ts: Column, hours: Column) -> Column:
    """``ts + interval 'h hour'`` on zone-less times."""
    return ts + F.make_dt_interval(hours=hours.cast("int"))


def wall_time_to_utc(ts: Column, zone: str) -> Column:
    """A zone-less wall time in ``zone`` as zone-less UTC (the instant a
    reader in ``zone`` meant, printed in GMT).  Independent of the session
    time zone.

    Wall times that occur twice (the hour repeated when daylight time ends)
    take the offset in force after the transition, i.e. standard time, as
    PostgreSQL does; Spark's own conversion would take the earlier offset.
    Wall times skipped by the spring transition move forward, as in both.
    """
    z, utc = F.lit(zone), F.lit("UTC")
    t = ts.cast("timestamp_ntz")
    first = F.convert_timezone(z, utc, t)  # earlier offset on a repeated hour
    # offset in force a few hours later, after any transition at this time
    later = first + F.make_dt_interval(hours=F.lit(3))
    offset_after = F.convert_timezone(utc, z, later) - later
    second = t - offset_after
    repeated = (second != first) & (F.convert_timezone(utc, z, second) == t)
    return F.when(repeated, F.greatest(first, second)).otherwise(first)


def utc_time(df: DataFrame, name: str) -> Column:
    """A time column as zone-less UTC time, whatever the session zone: an
    instant (``TIMESTAMP``) is taken at UTC, a zone-less time as it stands."""
    c = F.col(f"`{name}`")
    if dict(df.dtypes).get(name) != "timestamp":
        return c
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), F.lit("1970-01-01").cast("timestamp_ntz"))
