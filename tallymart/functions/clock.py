"""Clock values as columns: every job takes an explicit ``as_of``.

All text without a zone, all days and all ISO texts are in UTC, whatever the session's time
zone is.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_ZONE = r":.*(Z|[+-][0-9]{2}(:[0-9]{2})?)\z"


def zoned(text: Column) -> Column:
    """Timestamp text with its zone spelled out; UTC where it names none."""
    return (
        F.when(text.rlike(_ZONE), text)
        .when(text.contains(":"), F.concat(text, F.lit("Z")))
        .otherwise(F.concat(text, F.lit(" 00:00:00Z")))
    )


def utc_instant(local: Column) -> Column:
    """A timestamp without zone, read as UTC."""
    return F.concat(local.cast("timestamp_ntz").cast("string"), F.lit("Z")).cast("timestamp")


def utc_date(ts: Column) -> Column:
    return F.date_from_unix_date(F.floor(F.unix_seconds(ts) / 86400).cast("int"))


def utc_text(ts: Column, between: str = " ") -> Column:
    """Date and time of a timestamp in UTC, to the second."""
    second = F.pmod(F.unix_seconds(ts), F.lit(86400))
    part = lambda n: F.lpad(n.cast("int").cast("string"), 2, "0")
    clock = [part(F.floor(second / 3600)), part(F.floor(second / 60) % 60), part(second % 60)]
    return F.concat(utc_date(ts).cast("string"), F.lit(between), F.concat_ws(":", *clock))


def utc_micros(ts: Column) -> Column:
    """The fraction of a second as six digits."""
    return F.lpad(F.pmod(F.unix_micros(ts), F.lit(1_000_000)).cast("string"), 6, "0")


def as_timestamp(as_of: dt.datetime | str | Column | None) -> Column:
    """``as_of`` as a timestamp, in UTC unless it names a zone; ``None`` reads the clock."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of.cast("timestamp")
    if isinstance(as_of, dt.datetime):
        as_of = as_of.isoformat(sep=" ")
    return zoned(F.lit(str(as_of))).cast("timestamp")


def as_date(as_of: dt.date | dt.datetime | str | Column | None) -> Column:
    if isinstance(as_of, Column):
        return as_of.cast("date")
    if isinstance(as_of, dt.date) and not isinstance(as_of, dt.datetime):
        return F.lit(as_of.isoformat()).cast("date")
    return utc_date(as_timestamp(as_of))


def iso_text(ts: Column) -> Column:
    """ISO 8601 text of a timestamp in UTC; the fraction appears only when there is one."""
    micros = utc_micros(ts)
    fraction = F.when(micros == "000000", F.lit("")).otherwise(F.concat(F.lit("."), micros))
    return F.concat(utc_text(ts, "T"), fraction, F.lit("+00:00"))
