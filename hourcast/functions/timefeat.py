"""Time expressions (F1-F16): parsing, parts, formatting, seasons, segments, cyclic encodings.

All of them are built-in column expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

OBS_TIME_FORMAT = "yyyyMMddHHmm"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_obs_time(c) -> Column:
    """``yyyyMMddHHmm`` text -> TIMESTAMP_NTZ; bad text -> null (never raises under ANSI)."""
    return F.try_to_timestamp(_c(c), F.lit(OBS_TIME_FORMAT)).cast("timestamp_ntz")


def format_obs_time(c) -> Column:
    """timestamp -> ``yyyyMMddHHmm`` text."""
    return F.date_format(_c(c), OBS_TIME_FORMAT)


def time_parts(c) -> dict[str, Column]:
    """year, month, day, hour as int columns."""
    t = _c(c)
    return {"year": F.year(t), "month": F.month(t), "day": F.dayofmonth(t), "hour": F.hour(t)}


def from_parts(year, month, day, hour) -> Column:
    """NTZ timestamp from integer parts."""
    return F.make_timestamp_ntz(_c(year), _c(month), _c(day), _c(hour), F.lit(0), F.lit(0))


def hour_floor(c) -> Column:
    """truncate to the hour, staying in TIMESTAMP_NTZ whatever the session zone."""
    t = _c(c)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.lit(0), F.lit(0))


def weekday_name(c) -> Column:
    """English weekday name (Monday ... Sunday)."""
    return F.date_format(_c(c), "EEEE")


def weekday_index(c) -> Column:
    """weekday with Monday = 0."""
    return F.weekday(_c(c))


def season(month) -> Column:
    """3-5 Spring, 6-8 Summer, 9-11 Fall, else Winter."""
    m = _c(month)
    return (F.when(m.between(3, 5), "Spring").when(m.between(6, 8), "Summer")
            .when(m.between(9, 11), "Fall").otherwise("Winter"))


def time_segment(hour) -> Column:
    """F8: <6 Dawn, <12 Morning, <18 Afternoon, <22 Evening, else Night."""
    h = _c(hour)
    return (F.when((h >= 0) & (h < 6), "Dawn").when((h >= 6) & (h < 12), "Morning")
            .when((h >= 12) & (h < 18), "Afternoon").when((h >= 18) & (h < 22), "Evening")
            .otherwise("Night"))


def cyclic(c, period: float, offset: float = 0.0) -> tuple[Column, Column]:
    """sin / cos of 2*pi*(c - offset)/period."""
    angle = (_c(c) - F.lit(offset)) * F.lit(2.0 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def cyclic_features(hour="hour", month="month", day="day", weekday=None) -> dict[str, Column]:
    """F9-F12 as one dict for ``withColumns``."""
    out = {}
    out["hour_sin"], out["hour_cos"] = cyclic(hour, 24)
    out["month_sin"], out["month_cos"] = cyclic(month, 12, 1)
    out["day_sin"], out["day_cos"] = cyclic(day, 31, 1)
    if weekday is not None:
        out["weekday_sin"], out["weekday_cos"] = cyclic(weekday, 7)
    return out


def physics_features() -> dict[str, Column]:
    """Solar effect, soil gap, vapour ratio, pressure gap."""
    return {
        "solar_effect": F.col("SolarRadiation") * F.sin(F.lit(math.pi / 24) * F.col("hour")),
        "soil_temp_diff": F.col("SoilTemperature5cm") - F.col("GroundTemperature"),
        "vapor_ratio": F.col("VaporPressure") / (F.col("RelativeHumidity") + F.lit(0.001)),
        "pressure_diff": F.col("SeaLevelPressure") - F.col("LocalPressure"),
    }


def to_fahrenheit(c) -> Column:
    """x * 9/5 + 32."""
    return _c(c) * F.lit(9.0) / F.lit(5.0) + F.lit(32.0)
