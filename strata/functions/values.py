"""Literal and timestamp helpers used when stamping audit values."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_timestamp(now: None | str | _dt.datetime | Column) -> Column:
    """Audit time as a TIMESTAMP column.

    ``None`` -> ``current_timestamp()`` (one value per query); a string without
    an offset (or a naive datetime) is read in the session time zone, so the
    wall-clock value round-trips exactly; an offset or aware datetime is exact.
    """
    if now is None:
        return F.current_timestamp()
    if isinstance(now, Column):
        return now.cast(T.TimestampType())
    if isinstance(now, _dt.datetime):
        # an aware datetime keeps its offset (an exact instant); a naive one is wall clock
        now = now.isoformat(sep=" ") if now.tzinfo else now.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(now).cast(T.TimestampType())
