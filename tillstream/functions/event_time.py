"""Event time and time labels. Nothing here depends on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillstream.schemas import TableSpec


def epoch_seconds(epoch_millis: Column) -> Column:
    """Whole seconds of an epoch-milliseconds string; NULL when it is not a number."""
    return millis_to_seconds(epoch_millis.try_cast("bigint"))


def millis_to_seconds(millis: Column) -> Column:
    """Integer division by 1000: milliseconds are cut off, not rounded."""
    return F.call_function("div", millis, F.lit(1000))


def event_time(epoch_millis: Column) -> Column:
    """Event time (instant, second resolution) of an epoch-milliseconds string."""
    return F.timestamp_seconds(epoch_seconds(epoch_millis))


def with_event_times(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Add the computed event-time columns a table declares."""
    return df.withColumns({name: event_time(F.col(source)) for name, source in spec.event_time.items()})


def with_watermark(df: DataFrame, spec: TableSpec, delay: str | None = None) -> DataFrame:
    """Add the event-time columns and the declared watermark (``delay`` replaces the declared one)."""
    column, declared = spec.watermark
    return with_event_times(df, spec).withWatermark(column, delay or declared)


def utc_wall_clock(epoch_seconds: Column) -> Column:
    """UTC wall-clock time (TIMESTAMP_NTZ) of epoch seconds."""
    return (F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
            + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), epoch_seconds))


def time_label(epoch_millis: Column, offset_minutes: int = 0) -> Column:
    """``yyyy-MM-ddTHH:mm:ss.SSS+hh:mm`` label of epoch milliseconds at a fixed offset."""
    fraction = F.pmod(epoch_millis, F.lit(1000))
    local = millis_to_seconds(epoch_millis - fraction) + offset_minutes * 60
    sign = "-" if offset_minutes < 0 else "+"
    hours, minutes = divmod(abs(offset_minutes), 60)
    return F.concat(
        F.translate(utc_wall_clock(local).cast("string"), " ", "T"),
        F.lit("."), F.lpad(fraction.cast("string"), 3, "0"),
        F.lit(f"{sign}{hours:02d}:{minutes:02d}"),
    )


def instant_from_wall_millis(wall_millis: Column, zone: str) -> Column:
    """Instant of a zone-less database time that capture tools publish as milliseconds "as if UTC"."""
    return F.to_utc_timestamp(F.timestamp_millis(wall_millis), zone)


def instant_from_wall_clock(wall: Column, zone: str) -> Column:
    """Instant of a zone-less (TIMESTAMP_NTZ) database time in the database's zone."""
    return F.make_timestamp(
        F.year(wall), F.month(wall), F.day(wall), F.hour(wall), F.minute(wall),
        F.extract(F.lit("SECOND"), wall), F.lit(zone),
    )


def to_millis(instant: Column) -> Column:
    """Cut an instant down to millisecond precision, as TIMESTAMP(3) columns hold it."""
    micros = F.unix_micros(instant)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(1000)))
