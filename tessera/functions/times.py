"""Clock times as instants and back, whatever the session's time zone: both are read as UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def utc_instant(clock: Column) -> Column:
    """timestamp_ntz → timestamp."""
    second = F.extract(F.lit("SECOND"), clock)
    return F.make_timestamp_ltz(F.year(clock), F.month(clock), F.day(clock), F.hour(clock), F.minute(clock), second, F.lit("UTC"))


def utc_clock(instant: Column) -> Column:
    """timestamp → timestamp_ntz."""
    seconds = (F.unix_micros(instant).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(10,0)")).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
