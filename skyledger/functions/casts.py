"""Lenient casts (a bad value becomes NULL, also under ANSI mode) and the local day."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

LOCAL_ZONE = "America/Sao_Paulo"
_SUFFIXED = r'[0-9.][dDfF]"? *$'


def unquoted(value: Column) -> Column:
    """A JSON value that was read as text: the words NaN and Infinity come in double quotes."""
    return F.btrim(value, F.lit('" '))


def as_double(value: Column, is_text: bool = True) -> Column:
    """A number or NULL. As text, a type suffix as in ``30f`` makes no number."""
    if not is_text:
        return value.try_cast("double")
    return F.when(~value.rlike(_SUFFIXED), unquoted(value).try_cast("double"))


def as_int(value: Column, is_text: bool = True) -> Column:
    """Through double, so that ``1000.0`` becomes 1000 rather than NULL."""
    return as_double(value, is_text).try_cast("int")


def local_day(utc_text: Column, zone: str = LOCAL_ZONE) -> Column:
    """Calendar day in ``zone`` of an ISO-8601 text; the session time zone has no influence.

    Text without an offset is read in the session time zone. Malformed text gives NULL. The shifted
    time is counted in whole days rather than cast to a date, since the cast would shift it again by
    the session time zone.
    """
    shifted = F.from_utc_timestamp(F.try_to_timestamp(utc_text), zone)
    days = F.floor(F.unix_seconds(shifted) / F.lit(86400))
    return F.date_from_unix_date(days.cast("int"))
