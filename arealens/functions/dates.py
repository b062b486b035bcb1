"""Occurrence times from the shapes that incident feeds use."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from arealens.constants import NULL_WORDS
from arealens.functions.bind import bind
from arealens.functions.text import as_text, strip_blanks, to_double

EPOCH_MILLIS_FROM = 1e10

# Tried in this order after ISO text.
DATE_FORMATS = (
    "M/d/yyyy",
    "M/d/yyyy H:mm",
    "M/d/yyyy H:mm:ss",
    "M/d/yyyy h:mm a",
    "M/d/yyyy h:mm:ss a",
    "yyyy/M/d",
    "yyyy/M/d H:mm",
    "yyyy/M/d H:mm:ss",
    "yyyy-M-d h:mm a",
    "yyyy-M-d h:mm:ss a",
    "yyyyMMdd",
    "yyyyMMdd H:mm",
    "M/d/yyyy H:mm:ss.SSS",
    "M-d-yyyy",
    "M-d-yyyy H:mm",
    "M-d-yyyy H:mm:ss",
    "yyyy.M.d",
    "yyyy.M.d H:mm",
    "yyyy.M.d H:mm:ss",
    "M/d/yy",
    "M/d/yy H:mm",
    "M/d/yy H:mm:ss",
    "M/d/yy h:mm a",
    "MMM d, yyyy",
    "MMMM d, yyyy",
    "MMM d, yyyy H:mm",
    "MMMM d, yyyy H:mm",
    "d-MMM-yyyy",
    "d-MMM-yyyy H:mm",
    "d MMM yyyy",
    "d MMMM yyyy",
    "yyyyMMddHHmmss",
)
#: Fourteen digits that read as a time are no number of milliseconds.
PACKED_TIME = "yyyyMMddHHmmss"


def _text_or_null(value: Column) -> Column:
    def kept(text: Column) -> Column:
        return F.when((text != "") & ~F.lower(text).isin(NULL_WORDS), text)

    return bind(strip_blanks(as_text(value)), kept)


def format_shape(pattern: str) -> str:
    """What texts of a date format look like: ``0`` for a run of digits, ``A`` for one of letters, marks as they are."""
    letters = re.sub(r"M{3,}|a", "\0", pattern)
    return re.sub(r"[A-Za-z]+", "0", letters).replace("\0", "A")


def parse_text_time(text: Column, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """ISO first, then the first fitting of the formats that have the shape of the text; NULL when nothing fits."""
    shapes: dict[str, list[str]] = {}
    for fmt in formats:
        shapes.setdefault(format_shape(fmt), []).append(fmt)

    def tried(t: Column) -> Column:
        def of_shape(shape: Column) -> Column:
            out = F.when(F.lit(False), F.lit(None).cast("timestamp_ntz"))
            for look, fitting in shapes.items():
                out = out.when(shape == look, F.coalesce(*[F.try_to_timestamp(t, F.lit(fmt)).cast("timestamp_ntz") for fmt in fitting]))
            return out

        iso = F.when(t.rlike(r"^[0-9]{4}(-|$)"), t.try_cast("timestamp_ntz"))
        shape = F.regexp_replace(F.regexp_replace(t, "[A-Za-z]+", "A"), "[0-9]+", "0")
        return F.coalesce(iso, bind(shape, of_shape))

    return bind(text, tried)


def epoch_millis(value: Column, timezone: str | None = None) -> Column:
    """Numbers from 1e10 on are epoch milliseconds, moved to ``timezone`` only if one is given."""

    def in_range(number: Column) -> Column:
        # Beyond the year 9999 the number is not a time.
        usable = (number >= EPOCH_MILLIS_FROM) & (number < 253402300800000.0)
        return F.when(usable, number.try_cast("long"))

    def number_of(text: Column) -> Column:
        packed = text.rlike(r"^(?:19|20)[0-9]{12}$") & F.try_to_timestamp(text, F.lit(PACKED_TIME)).isNotNull()
        return to_double(F.when(~F.coalesce(packed, F.lit(False)), text))

    millis = bind(bind(strip_blanks(as_text(value)), number_of), in_range)
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    instant = F.timestamp_add("MILLISECOND", millis, start)
    return instant if timezone is None else F.convert_timezone(F.lit("UTC"), F.lit(timezone), instant)


def parse_occurred_at(
    date: Column,
    time: Column | None = None,
    timezone: str | None = None,
    formats: tuple[str, ...] = DATE_FORMATS,
) -> Column:
    """Epoch milliseconds, or free date text with an optional separate time.

    A time of one to four digits is HHMM; if valid it replaces whatever time the
    date text carries. Any other time text is appended to the date text.
    """
    if time is None:
        text = _text_or_null(date)
    else:

        def combined(day: Column, clock: Column) -> Column:
            padded = F.lpad(clock, 4, "0")
            valid = clock.rlike("^[0-9]{1,4}$") & (padded.substr(1, 2) <= "23") & (padded.substr(3, 2) <= "59")
            day_only = F.substring_index(F.substring_index(day, "T", 1), " ", 1)
            hhmm = F.concat(padded.substr(1, 2), F.lit(":"), padded.substr(3, 2))
            return (
                F.when(day.isNull() | clock.isNull(), day)
                .when(valid, F.concat(day_only, F.lit(" "), hhmm))
                .otherwise(F.concat(day, F.lit(" "), clock))
            )

        pair = F.struct(_text_or_null(date).alias("day"), _text_or_null(time).alias("clock"))
        text = bind(pair, lambda p: combined(p["day"], p["clock"]))
    return F.coalesce(epoch_millis(date, timezone), parse_text_time(text, formats))


def parse_year_day(year: Column, day: Column, time: Column | None = None) -> Column:
    """Year plus day of year 1..366, with an optional time; a bad time means midnight."""

    def start(p: Column) -> Column:
        usable = p["y"].between(1, 9999) & p["d"].between(1, 366)
        first = F.make_date(F.when(usable, p["y"]), F.lit(1), F.lit(1))
        return F.date_add(first, p["d"] - 1)

    pair = F.struct(to_double(year).try_cast("int").alias("y"), to_double(day).try_cast("int").alias("d"))
    date = bind(pair, start)
    if time is None:
        return date.cast("timestamp_ntz")

    def timed(d: Column) -> Column:
        return F.coalesce(parse_occurred_at(d.cast("string"), time), d.cast("timestamp_ntz"))

    return bind(date, timed)


def date_parts(occurred_at: Column) -> dict[str, Column]:
    return {
        "occurred_date": F.to_date(occurred_at),
        "occurred_year": F.year(occurred_at),
        "occurred_month": F.month(occurred_at),
    }
