"""Time expressions on UTC timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_HOUR = 3_600_000_000

# Fixed value: ISO 8601 durations of weeks, days and clock time. Years and months have no fixed length.
_NUMBER = r"[0-9]+(?:[.,][0-9]+)?"
DURATION_PATTERN = (
    rf"^([+-])?P(?=[0-9T])(?:({_NUMBER})W)?(?:({_NUMBER})D)?"
    rf"(?:T(?:({_NUMBER})H)?(?:({_NUMBER})M)?(?:({_NUMBER})S)?)?$"
)
SECONDS_PER_UNIT = (604800, 86400, 3600, 60, 1)


def duration_seconds(c: Column) -> Column:
    """Whole seconds of an ISO 8601 duration; 0 when missing or unreadable."""
    text = F.coalesce(c, F.lit(""))
    total = F.lit(0.0)
    for group, seconds in enumerate(SECONDS_PER_UNIT, start=2):
        number = F.replace(F.regexp_extract(text, DURATION_PATTERN, group), F.lit(","), F.lit("."))
        total = total + F.coalesce(number.try_cast("double"), F.lit(0.0)) * seconds
    signed = F.when(F.startswith(text, F.lit("-")), -total).otherwise(total)
    return F.when(text.rlike(DURATION_PATTERN), signed).otherwise(0.0).cast("bigint")


def iso_timestamp(c: Column) -> Column:
    """ISO 8601 text (``Z`` or offset) as a timestamp; null when missing or unreadable."""
    return F.try_to_timestamp(c)


def hours_between(start: Column, end: Column) -> Column:
    """Fractional hours from ``start`` to ``end``."""
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(float(MICROS_PER_HOUR))


def longer_than(start: Column, end: Column, hours: float) -> Column:
    """True when ``end`` is later than ``start`` by strictly more than ``hours``."""
    return F.unix_micros(end) - F.unix_micros(start) > F.lit(int(hours * MICROS_PER_HOUR))


def shifted(ts: Column, hours: float) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + F.lit(int(hours * MICROS_PER_HOUR)))


def cyclic_hour(hour: Column) -> dict[str, Column]:
    angle = F.lit(2.0) * F.pi() * hour / F.lit(24.0)
    return {"hour_sin": F.sin(angle), "hour_cos": F.cos(angle)}


def date_features(ts: Column) -> dict[str, Column]:
    """Publish hour, weekday (Monday is 0), weekend flag and the hour on the circle."""
    hour = F.hour(ts)
    day = F.weekday(ts)
    return {
        "publish_hour": hour,
        "publish_day": day,
        "is_weekend": day.isin(5, 6).cast("int"),
        **cyclic_hour(hour),
    }


def age_hours(published: Column, start: Column, floor: float = 0.0) -> Column:
    """Age at first observation, never below ``floor``."""
    return F.greatest(hours_between(published, start), F.lit(float(floor)))
