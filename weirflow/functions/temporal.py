"""Rendering and repair of timestamps, dates and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The range that is rendered, and what stands for values outside it (fixed values).
LOWEST = "0001-01-01 00:00:00.000"
HIGHEST = "9999-12-31 23:59:59.999"
TOP_TIMESTAMP = "9999-12-31T23:59:59.999+00:00"
TOP_DATE = "9999-12-31T00:00:00+00:00"


def _bound(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def clamp(c: Column) -> Column:
    """A timestamp outside the range, on either side, becomes the highest."""
    return F.when((c < _bound(LOWEST)) | (c > _bound(HIGHEST)), _bound(HIGHEST)).otherwise(c)


def midnight(c: Column) -> Column:
    """A date as the timestamp it begins with."""
    return c.cast("timestamp_ntz")


def iso_timestamp(c: Column) -> Column:
    """ISO text of a timestamp in UTC; six digits of a second, or none if they are zero."""
    plain = c.cast("timestamp_ntz")
    whole = F.date_trunc("SECOND", plain) == plain
    return F.concat(F.when(whole, F.date_format(plain, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(F.date_format(plain, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")), F.lit("+00:00"))


def iso_date(c: Column) -> Column:
    return F.concat(F.date_format(c, "yyyy-MM-dd"), F.lit("T00:00:00+00:00"))


def hour_24(text: Column) -> Column:
    """A time of hour 24 is hour 0."""
    return F.when(text.startswith("24"), F.concat(F.lit("00"), F.substring(text, 3, 2**31 - 1))).otherwise(text)


_CLOCK = r"([01]\d|2[0-3]):[0-5]\d:[0-5]\d(?:\.\d+)?"
_ZONED = r"^([01]\d|2[0-3]):[0-5]\d(?::[0-5]\d)?(?:\.\d+)?\s*(?:[+-]\d{1,2}(?::?\d{2}){0,2}|Z)?$"


def _readable(fixed: Column, pattern: str, shown: Column) -> Column:
    """What is shown of a time, if the time can be read; other text fails."""
    failed = F.raise_error(F.concat(F.lit("can't read the time "), fixed)).cast("string")
    return F.when(fixed.isNull(), fixed).when(fixed.rlike(pattern), shown).otherwise(failed)


def plain_time(text: Column) -> Column:
    """HH:MM:SS of a time's text, without fractions."""
    fixed = hour_24(text)
    return _readable(fixed, f"^{_CLOCK}$", F.substring(fixed, 1, 8))


def utc_time(text: Column) -> Column:
    """HH:MM:SS in UTC of a time with an offset such as +02, -05:30 or +00:00:30; no offset is UTC."""
    fixed = hour_24(text)

    def part(n: int) -> Column:
        return F.coalesce(F.nullif(F.regexp_extract(fixed, r"^(\d{2}):(\d{2})(?::(\d{2}))?(?:\.\d+)?\s*(?:([+-])(\d{1,2}):?(\d{2})?:?(\d{2})?|Z)?$", n), F.lit("")).cast("int"), F.lit(0))

    sign = F.regexp_extract(fixed, r"([+-])\d{1,2}(?::?\d{2}){0,2}$", 1)
    offset = part(5) * 3600 + part(6) * 60 + part(7)
    clock = part(1) * 3600 + part(2) * 60 + part(3)
    second = F.pmod(F.when(sign == "-", clock + offset).otherwise(clock - offset), F.lit(86_400))
    shown = F.format_string("%02d:%02d:%02d", (second / 3600).cast("int"), (second % 3600 / 60).cast("int"), second % 60)
    return _readable(fixed, _ZONED, shown)


_STAMP = r"^(\d{4}-\d{2}-\d{2})[ T](\d{2}:\d{2})(?::(\d{2})(?:\.(\d{1,6})\d*)?)?\s*(Z|[+-]\d{2}(?::?\d{2}){0,2})?$"


def log_timestamp(text: Column) -> Column:
    """ISO text of a timestamp in a change event, with its own offset (none: UTC).

    What is before our era, can't be read, or lies above the highest timestamp in UTC becomes the
    highest.
    """
    given = F.trim(text)
    minute = F.concat_ws(" ", F.regexp_extract(given, _STAMP, 1), F.regexp_extract(given, _STAMP, 2))
    second, fraction, zone = (F.regexp_extract(given, _STAMP, n) for n in (3, 4, 5))
    second = F.when(second == "", F.lit("00")).otherwise(second)
    micros = F.rpad(fraction, 6, "0")
    moment = F.concat(minute, F.lit(":"), second, F.lit("."), micros).try_cast("timestamp_ntz")
    digits = F.rpad(F.regexp_replace(zone, "[+:Z-]", ""), 6, "0")  # hours, minutes and seconds of the offset
    hours, minutes, seconds = (F.substring(digits, at, 2) for at in (1, 3, 5))
    shift = hours.cast("int") * 3600 + minutes.cast("int") * 60 + seconds.cast("int")
    utc = F.timestamp_add("SECOND", F.when(zone.startswith("-"), shift).otherwise(-shift), moment)
    offset = F.concat(F.substring(zone, 1, 1), hours, F.lit(":"), minutes, F.when(seconds == "00", F.lit("")).otherwise(F.concat(F.lit(":"), seconds)))
    offset = F.when(zone.isin("", "Z"), F.lit("+00:00")).otherwise(offset)
    shown = F.concat(F.translate(minute, " ", "T"), F.lit(":"), second, F.when(micros == "000000", F.lit("")).otherwise(F.concat(F.lit("."), micros)), offset)
    sound = moment.isNotNull() & (utc >= _bound(LOWEST)) & (utc <= _bound(HIGHEST))
    return F.when(text.isNotNull(), F.when(sound, shown).otherwise(F.lit(TOP_TIMESTAMP)))


def log_date(text: Column) -> Column:
    """ISO midnight of a date in a change event; years above 9999 become the top, anything else unreadable fails."""
    far = text.rlike(r"^\d{5,}-\d{2}-\d{2}$")
    sound = text.rlike(r"^\d{4}-\d{2}-\d{2}$") & text.try_cast("date").isNotNull()
    failed = F.raise_error(F.concat(F.lit("can't read the date "), text)).cast("string")
    return F.when(text.isNotNull(), F.when(far, F.lit(TOP_DATE)).when(sound, F.concat(text, F.lit("T00:00:00+00:00"))).otherwise(failed))
