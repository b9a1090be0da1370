"""Run hours and capture stamps.

Run ids are local wall-clock text.  They are handled as text and TIMESTAMP_NTZ only, so the
session zone can never shift a slot.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RUN_ID = "^[0-9]{8}-[0-9]{6}$"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def _part(run_id: Column, start: int, size: int) -> Column:
    return F.substring(run_id, start, size)


def run_time(run_id: Column) -> Column:
    """Naive local time of a run id; NULL for an impossible date or another format."""
    iso = F.concat(
        _part(run_id, 1, 4), F.lit("-"), _part(run_id, 5, 2), F.lit("-"), _part(run_id, 7, 2),
        F.lit(" "), _part(run_id, 10, 2), F.lit(":"), _part(run_id, 12, 2), F.lit(":"),
        _part(run_id, 14, 2),
    )
    return F.when(run_id.rlike(RUN_ID), iso.try_cast("timestamp_ntz"))


def hour_of(time: Column) -> Column:
    """The hour a naive time falls in."""
    return F.concat(F.substring(time.cast("string"), 1, 13), F.lit(":00:00")).cast("timestamp_ntz")


def run_hour(run_id: Column) -> Column:
    return hour_of(run_time(run_id))


def slot_of(run_id: Column) -> Column:
    """Id of the hourly slot a run occupies; NULL when the run id is no real time."""
    return F.when(
        run_time(run_id).isNotNull(), F.concat(F.substring(run_id, 1, 11), F.lit("0000"))
    )


def slot_id(hour: Column) -> Column:
    """Slot id of a naive hour."""
    text = hour.cast("string")
    return F.concat(
        F.replace(F.substring(text, 1, 10), F.lit("-"), F.lit("")),
        F.lit("-"), F.substring(text, 12, 2), F.lit("0000"),
    )


def epoch_micros(epoch: Column) -> Column:
    """Microseconds of a decimal epoch cell, the last kept digit rounded."""
    return F.round(epoch.try_cast("decimal(38,9)") * 1000000, 0).cast("bigint")


def iso_stamp(epoch: Column) -> Column:
    """Epoch cell as ISO-8601 UTC text with microseconds."""
    seconds = F.floor(epoch_micros(epoch) / 1000000)
    # Date and clock text are computed from whole days and seconds: no session zone involved.
    micros = epoch_micros(epoch) - seconds * 1000000
    day = F.date_from_unix_date(F.floor(seconds / 86400).cast("int"))
    in_day = seconds - F.floor(seconds / 86400) * 86400
    return F.format_string(
        "%sT%02d:%02d:%02d.%06dZ",
        day.cast("string"), F.floor(in_day / 3600), F.floor(in_day % 3600 / 60), in_day % 60, micros,
    )


def stamp_micros(stamp: Column) -> Column:
    """Microseconds of an ISO stamp, NULL when it is not a time."""
    return F.unix_micros(F.replace(stamp, F.lit("Z"), F.lit("+00:00")).try_cast("timestamp"))


def dwell_span_seconds(first: Column, last: Column) -> Column:
    return (stamp_micros(last) - stamp_micros(first)) / F.lit(1000000.0)
