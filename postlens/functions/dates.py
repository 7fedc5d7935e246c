"""Dates in posts and run parameters. Results are UTC and independent of the session zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# The post timestamp looks like "Fri Feb 04 06:12:11 +0000 2022". The weekday is
# checked by pattern, because the parser accepts no weekday letters.
WEEKDAY = "^(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun) "
POST_TIME = "MMM d HH:mm:ss Z yyyy"
ISO_TIME = "yyyy-MM-dd'T'HH:mm:ss"


def post_timestamp(created_at: Column) -> Column:
    """UTC wall-clock time of a post; null when the text is not a post timestamp."""
    instant = F.try_to_timestamp(F.substr(created_at, F.lit(5)), F.lit(POST_TIME))
    return F.when(
        created_at.rlike(WEEKDAY), F.to_utc_timestamp(instant, F.current_timezone())
    )


def partition_date(created_at: Column) -> Column:
    """``yyyy-MM-dd`` of a post timestamp."""
    return F.date_format(post_timestamp(created_at), "yyyy-MM-dd")


def post_datetime(created_at: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss.000`` of a post timestamp."""
    return F.date_format(post_timestamp(created_at), "yyyy-MM-dd HH:mm:ss.SSS")


def parse_iso(text: Column) -> Column:
    """ISO date or date-time text as a zone-free timestamp; null when it is neither."""
    return text.try_cast("timestamp_ntz")


def moment(value: datetime) -> Column:
    """A zone-free literal; through its text, because Python times pass the session zone."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def format_iso(time: Column) -> Column:
    """Second precision. Formats the text of the zone-free time, which no session zone shifts."""
    text = time.cast("timestamp_ntz").cast("string")
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8))


def format_utc(time: Column) -> Column:
    """Second precision with a ``Z`` suffix, as sources expect it in pushed filters."""
    return F.concat(format_iso(time), F.lit("Z"))


def daily(first: Column, last: Column) -> Column:
    """Array of days, both ends included."""
    return F.sequence(first.cast("date"), last.cast("date"), F.expr("interval 1 day"))
