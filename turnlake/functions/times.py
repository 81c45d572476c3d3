"""Timestamp parsing, UTC text and calendar attributes (the session zone is UTC)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnlake.functions.text import strip

# A full calendar date is required; Spark's cast alone would also take "2024" or "2024-01".
ISO_SHAPE = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?)?$"
EPOCH_SHAPE = r"^-?\d{1,11}(\.\d+)?$"


def instant(moment: dt.datetime) -> Column:
    """A literal; a moment without zone counts as UTC."""
    aware = moment if moment.tzinfo else moment.replace(tzinfo=dt.timezone.utc)
    return F.lit(aware.astimezone(dt.timezone.utc).isoformat()).cast("timestamp")


def iso_timestamp(text: Column) -> Column:
    """ISO text with or without zone; NULL when it is not a timestamp."""
    return F.when(text.rlike(ISO_SHAPE), F.try_to_timestamp(text))


def utc_timestamp(value: Column) -> Column:
    """A timestamp, epoch seconds or ISO text as a timestamp; NULL when unusable."""
    text = strip(value.cast("string"))
    epoch = F.when(text.rlike(EPOCH_SHAPE), F.timestamp_micros((text.try_cast("double") * 1000000).try_cast("bigint")))
    return F.coalesce(iso_timestamp(text), epoch)


def contract_timestamp(value: Column) -> Column:
    """The three accepted formats, then a lenient cast."""
    return F.coalesce(
        F.try_to_timestamp(value, F.lit("yyyy-MM-dd'T'HH:mm:ss")),
        F.try_to_timestamp(value, F.lit("yyyy-MM-dd HH:mm:ss")),
        F.try_to_timestamp(value, F.lit("yyyy/MM/dd HH:mm:ss")),
        value.try_cast("timestamp"),
    )


def iso_text(ts: Column) -> Column:
    """UTC ISO text, microseconds only when there are any."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    part = F.date_format(ts, "SSSSSS")
    return F.concat(whole, F.when(part == "000000", F.lit("")).otherwise(F.concat(F.lit("."), part)), F.lit("+00:00"))


def batch_name(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'")


def calendar(ts: Column) -> dict[str, Column]:
    """Calendar attributes of one timestamp; `week_number` is the ISO week."""
    weekday = F.weekday(ts) + 1
    return {
        "year": F.year(ts),
        "quarter": F.quarter(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "day_of_week": weekday,
        "week_number": F.weekofyear(ts),
        "is_weekend": weekday >= 6,
    }


def monday_week(ts: Column) -> Column:
    """Week of the year with Monday first, days before the first Monday in week 0."""
    return F.floor((F.dayofyear(ts) - 1 + 7 - F.weekday(ts)) / 7).cast("int")
