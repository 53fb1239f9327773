"""Epoch-millisecond columns rendered independently of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = ("yyyy", "MM", "dd", "HH")


def ntz_from_millis(millis: Column) -> Column:
    return F.timestamp_add("MILLISECOND", millis, F.expr("timestamp_ntz'1970-01-01 00:00:00'"))


def millis_from_ntz(ts: Column) -> Column:
    """Whole milliseconds since the epoch, rounded towards minus infinity."""
    micros = F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), ts)
    return F.call_function("div", micros - F.pmod(micros, F.lit(1000)), F.lit(1000))


def local_time(millis: Column, tz: str = "UTC") -> Column:
    ntz = ntz_from_millis(millis)
    if tz in ("UTC", "Z"):
        return ntz
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), ntz)


def time_unit(local: Column, unit: str) -> Column:
    """One of the four units a name placeholder may ask for, zero padded."""
    parts = {
        "yyyy": (F.year, 4),
        "MM": (F.month, 2),
        "dd": (F.dayofmonth, 2),
        "HH": (F.hour, 2),
    }
    if unit not in parts:
        raise ValueError(f"timestamp unit must be one of {', '.join(UNITS)}, got {unit!r}")
    field, width = parts[unit]
    return F.lpad(field(local).cast("string"), width, "0")


def iso_instant(millis: Column) -> Column:
    """ISO-8601 instant; the fraction is printed only when it is not zero."""
    fraction = F.pmod(millis, F.lit(1000))
    seconds = F.call_function("div", millis - fraction, F.lit(1000))
    whole = F.timestamp_add("SECOND", seconds, F.expr("timestamp_ntz'1970-01-01 00:00:00'"))
    return F.concat(
        F.replace(whole.cast("string"), F.lit(" "), F.lit("T")),
        F.when(fraction == 0, F.lit("")).otherwise(
            F.concat(F.lit("."), F.lpad(fraction.cast("string"), 3, "0"))
        ),
        F.lit("Z"),
    )
