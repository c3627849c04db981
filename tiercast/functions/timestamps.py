"""Wall-clock literals."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def wall_clock(moment: dt.datetime) -> Column:
    """A timestamp without time zone; passing through text keeps session time zones out of it."""
    return F.lit(moment.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
