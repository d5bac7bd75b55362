"""Time expressions that give the same result under every session time zone.

Instants are `timestamp`; wall-clock times are `timestamp_ntz`. Malformed text becomes null
(ANSI mode stays on, so the plain casts would raise).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Calendar order; the first three letters are the short names.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt ][0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]{1,9})?)?"
_OFFSET = r"(?:[Zz]|[+-][0-9]{2}:?[0-9]{2})"


_PLACES = ((5, "-"), (8, "-"), (11, "T"), (14, ":"), (17, ":"))


def _usual(text: Column) -> Column:
    """Whether text looks like yyyy-MM-ddTHH:mm:ss.fZ with 0 to 9 places of a second, told by single characters.

    Marks at fixed places leave each number its right width, and the digit before the Z rules out names of zones;
    whether the numbers are numbers, the parser says.
    """
    length, digit = F.octet_length(text), F.substring(text, -2, 1)
    fits = (length == 20) | ((length >= 22) & (length <= 30) & (F.substring(text, 20, 1) == "."))
    for place, mark in _PLACES:
        fits = fits & (F.substring(text, place, 1) == mark)
    return fits & text.endswith("Z") & digit.between("0", "9")


def instant(text: Column) -> Column:
    """Instant of a full date and time. Text without an offset is UTC; a year or a time alone is null.

    The usual form is parsed at once; only other texts are matched with patterns, which cost more than the parsing.
    """
    zoned = F.when(text.rlike(f"{_OFFSET}$"), text).otherwise(F.concat(text, F.lit("Z")))
    return F.when(_usual(text), F.try_to_timestamp(text)).when(
        text.rlike(f"{_TIME}{_OFFSET}?$"), F.try_to_timestamp(zoned)
    )


def is_date_time(text: Column) -> Column:
    """Whether text is a date, time and offset that exist."""
    return F.coalesce(text.rlike(f"{_TIME}{_OFFSET}$") & instant(text).isNotNull(), F.lit(False))


def day(text: Column) -> Column:
    """Date of yyyy-MM-dd text, null for anything else."""
    return F.when(text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_date(text))


def utc_wall(at: Column) -> Column:
    """UTC wall time of an instant, computed from the epoch so no session zone is involved."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(at), epoch)


def zone_wall(utc: Column, zone: str) -> Column:
    """Wall time in `zone` for a UTC wall time."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def local_wall(at: Column, zone: str) -> Column:
    return zone_wall(utc_wall(at), zone)


def weekday_name(wall: Column) -> Column:
    return F.date_format(wall, "EEEE")


def weekday_short(wall: Column) -> Column:
    return F.date_format(wall, "E")


def weekday_index(name: Column) -> Column:
    """1 for Monday ... 7 for Sunday, from a full or a short name; null otherwise."""
    short = F.array(*[F.lit(day[:3]) for day in WEEKDAYS])
    full = F.array(*[F.lit(day) for day in WEEKDAYS])
    place = F.greatest(F.array_position(short, name), F.array_position(full, name))
    return F.nullif(place, F.lit(0)).cast("int")


def iso_year(day: Column) -> Column:
    """Year the ISO week belongs to, unlike the calendar year next to `weekofyear`."""
    return F.extract(F.lit("YEAROFWEEK"), day).cast("int")


def seconds_between(start: Column, end: Column) -> Column:
    return F.unix_seconds(end) - F.unix_seconds(start)


def day_text(at: Column) -> Column:
    """UTC day of an instant as yyyy-MM-dd."""
    return F.date_format(utc_wall(at), "yyyy-MM-dd")
