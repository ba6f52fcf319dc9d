"""Meteorological expressions and unit changes."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from finecast.functions.columns import clip

# Magnus and Tetens coefficients, unit factors.
MAGNUS_A, MAGNUS_B = 17.625, 243.04
TETENS_KPA, TETENS_A, TETENS_B = 0.6108, 17.27, 237.3
KELVIN_OFFSET = 273.15
LST_SCALE, LST_OFFSET = 0.00341802, 149.0
KMH_PER_MS = 3.6
DAYS_PER_YEAR, MONTHS_PER_YEAR = 365.25, 12.0


def relative_humidity(temp_c: Column, dewpoint_c: Column) -> Column:
    def saturation(t: Column) -> Column:
        return F.exp(F.lit(MAGNUS_A) * t / (F.lit(MAGNUS_B) + t))

    return clip(F.lit(100.0) * saturation(dewpoint_c) / saturation(temp_c), 0.0, 100.0)


def vapour_pressure_deficit(temp_c: Column, rh_pct: Column) -> Column:
    saturation = F.lit(TETENS_KPA) * F.exp(F.lit(TETENS_A) * temp_c / (temp_c + F.lit(TETENS_B)))
    return saturation * (F.lit(1.0) - rh_pct / F.lit(100.0))


def wind_speed(u: Column, v: Column) -> Column:
    return F.hypot(u, v)


def kelvin_to_celsius(k: Column) -> Column:
    return k - F.lit(KELVIN_OFFSET)


def metres_to_mm(m: Column) -> Column:
    """Depth in mm; small negative artefacts become zero."""
    return clip(m * F.lit(1000.0), 0.0)


def lst_dn_to_celsius(dn: Column) -> Column:
    return dn * F.lit(LST_SCALE) + F.lit(LST_OFFSET) - F.lit(KELVIN_OFFSET)


def scaled(c: Column, divisor: float) -> Column:
    """Stored integer to physical unit (soil layers use 10 or 100)."""
    return c / F.lit(float(divisor))


def ms_to_kmh(c: Column) -> Column:
    return c * F.lit(KMH_PER_MS)


def kmh_to_ms(c: Column) -> Column:
    return c / F.lit(KMH_PER_MS)


def convert_declared(value: Column, unit: Column) -> Column:
    """Wind in m/s from a declared unit; an undeclared unit gives NULL, never a guess."""
    u = F.lower(F.trim(unit))
    return F.when(u.isin("m/s", "ms"), value).when(u.isin("km/h", "kmh"), kmh_to_ms(value))


def calendar_cycle(date: Column, prefix: str = "time__") -> list[Column]:
    """Sine and cosine of day of year and month."""
    year_angle = F.lit(2 * math.pi) * F.dayofyear(date).cast("double") / F.lit(DAYS_PER_YEAR)
    month_angle = F.lit(2 * math.pi) * F.month(date).cast("double") / F.lit(MONTHS_PER_YEAR)
    return [
        F.sin(year_angle).alias(f"{prefix}day_of_year_sin"),
        F.cos(year_angle).alias(f"{prefix}day_of_year_cos"),
        F.sin(month_angle).alias(f"{prefix}month_sin"),
        F.cos(month_angle).alias(f"{prefix}month_cos"),
    ]


def issue_date(target_date: Column, lead_days: Column) -> Column:
    return F.date_sub(target_date, lead_days)


def lead_days(target_date: Column, issued: Column) -> Column:
    return F.datediff(target_date, issued)


def lead_hours(target_local: Column, retrieved_utc: Column, zone: str = "Asia/Kolkata") -> Column:
    """Hours from retrieval (UTC) to a target given in local wall time."""
    local = F.from_utc_timestamp(retrieved_utc, zone)
    return (F.unix_micros(target_local) - F.unix_micros(local)) / F.lit(3_600_000_000.0)
