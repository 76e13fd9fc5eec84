"""Integer calendar keys, timestamp literals and batch identifiers.

Built from date parts rather than formatted text: integer arithmetic stays in
generated code and does not depend on the session time zone.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(moment: datetime | None) -> Column:
    """A zone-free timestamp literal. ``lit(datetime)`` would shift with the session time zone."""
    return F.lit(None if moment is None else moment.isoformat(sep=" ")).cast("timestamp_ntz")


def date_key(day: Column) -> Column:
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def time_key(moment: Column) -> Column:
    """``HHMM``; seconds are ignored."""
    return (F.hour(moment) * 100 + F.minute(moment)).cast("int")


def batch_id(source_table: str, source_file: Column) -> Column:
    """A UUID-shaped id that depends only on the table and the file's base name.

    A row can compute its own id, so no join with a batch list is needed, and a
    retried load overwrites the partition its failed attempt may have left.
    """
    digest = F.md5(F.concat(F.lit(source_table + ":"), source_file))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(digest, start, size) for start, size in cuts])
