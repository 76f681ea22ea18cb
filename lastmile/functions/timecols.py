"""Timestamp parsing and derived time columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastmile import fixed
from lastmile.functions.numeric import round2


#: Of a format the shape of its text, and that text in the order year, month, day, time.
SHAPES = {
    "yyyy-MM-dd HH:mm:ss": (r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z", lambda text: text),
    "dd/MM/yyyy HH:mm:ss": (r"^[0-9]{2}/[0-9]{2}/[0-9]{4} [0-9]{2}:[0-9]{2}:[0-9]{2}\z", lambda text: F.concat(
        F.substring(text, 7, 4), F.lit("-"), F.substring(text, 4, 2), F.lit("-"), F.substring(text, 1, 2), F.substring(text, 11, 9))),
}


def parse_mixed_timestamp(text: Column, formats: Sequence[str] = fixed.TIMESTAMP_FORMATS) -> Column:
    """First format that parses wins; text no format accepts becomes null.

    ``try_to_timestamp`` keeps ANSI mode on without raising on dirty input. Text in
    the full shape of one of the ``SHAPES`` can be parsed by no other format of them, and a
    cast reads it at a fraction of the cost of a pattern that fails first.
    """
    general = F.coalesce(*[F.try_to_timestamp(text, F.lit(fmt)) for fmt in formats])
    if not set(formats) <= set(SHAPES):
        return general
    found = F.when(text.isNull(), F.lit(None).cast("timestamp"))
    for fmt in formats:
        shape, ordered = SHAPES[fmt]
        found = found.when(text.rlike(shape), ordered(text).try_cast("timestamp"))
    return found.otherwise(general)


def parse_date(text: Column, fmt: str = fixed.HIRE_DATE_FORMAT) -> Column:
    return F.try_to_date(text, fmt)


def epoch_seconds(ts: Column) -> Column:
    """Whole epoch seconds of a timestamp (works for TIMESTAMP and TIMESTAMP_NTZ)."""
    return F.unix_timestamp(ts)


def elapsed_seconds(start: Column, end: Column) -> Column:
    return epoch_seconds(end) - epoch_seconds(start)


def transit_hours(pickup: Column, delivery: Column) -> Column:
    """Hours from pickup to delivery, 2 decimals; null when not delivered."""
    return round2(elapsed_seconds(pickup, delivery) / F.lit(3600.0))


def on_time_flag(status: Column, pickup: Column, delivery: Column,
                 sla_seconds: int = fixed.SLA_SECONDS,
                 delivered: str = fixed.STATUS_DELIVERED) -> Column:
    """1 when delivered within the SLA (bound inclusive), else 0 (null -> 0)."""
    ok = (status == F.lit(delivered)) & (elapsed_seconds(pickup, delivery) <= F.lit(sla_seconds))
    return F.when(ok, F.lit(1)).otherwise(F.lit(0))


def with_time_dimensions(df: DataFrame, ts_col: str = "pickup") -> DataFrame:
    """Add day, year, month, weekday (1 = Sunday) and hour of ``ts_col``."""
    ts = F.col(ts_col)
    return df.withColumns({
        "day": F.to_date(ts),
        "year": F.year(ts),
        "month": F.month(ts),
        "weekday": F.dayofweek(ts),
        "hour": F.hour(ts),
    })
