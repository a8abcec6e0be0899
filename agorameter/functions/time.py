"""Time expressions. Unless said otherwise they read wall-clock time in the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_string(moment: Column | str) -> Column:
    """ISO-8601 local time; six fraction digits only when the fraction is not zero."""
    precise = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.replace(precise, F.lit(".000000"), F.lit(""))


def epoch_iso_string(seconds: Column | str) -> Column:
    """Epoch seconds as ISO-8601 string."""
    return iso_string(F.timestamp_seconds(seconds))


def utc_string(moment: Column | str) -> Column:
    """Second precision with a ``Z`` suffix, as search services expect it.

    An instant is shown in UTC whatever the session time zone; a time without zone as it is.
    """
    moment = F.col(moment) if isinstance(moment, str) else moment
    in_utc = F.to_utc_timestamp(moment, F.current_timezone())
    shown = F.when(F.typeof(moment) == "timestamp_ntz", moment).otherwise(in_utc)
    return F.date_format(shown, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def event_time(text: Column | str) -> Column:
    """Typed time from an ISO string; NULL when it cannot be read."""
    column = F.col(text) if isinstance(text, str) else text
    return column.try_cast("timestamp")
