"""Unit conversions between reported, storage (ug/m3) and US index units."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazeframe import fixed_values as fv
from hazeframe.functions.aqi import _col


def _factor(parameter: Column, factors: dict[str, float], default: float = 1.0) -> Column:
    out = None
    for name, f in factors.items():
        out = F.when(parameter == name, F.lit(f)) if out is None else out.when(parameter == name, F.lit(f))
    return out.otherwise(F.lit(default))


def to_ugm3(parameter, value, unit) -> Column:
    """Reported unit -> ug/m3.  CO labelled ppm but >= 10 is taken as ppb."""
    p, v, u = _col(parameter), _col(value), _col(unit)
    co_ppm = F.when(v >= fv.CO_PPM_MISLABEL_FROM, v * fv.PPB_TO_UGM3["co"]).otherwise(v * fv.CO_PPM_TO_UGM3)
    return (
        F.when(u == "ppb", v * _factor(p, fv.PPB_TO_UGM3))
        .when((u == "ppm") & (p == "co"), co_ppm)
        .otherwise(v)
    )


def to_us_units(parameter, value) -> Column:
    """ug/m3 -> ppm (CO) / ppb (NO2, SO2, O3); PM unchanged."""
    p, v = _col(parameter), _col(value)
    return F.when(p == "co", v / fv.CO_UGM3_PER_PPM).otherwise(v * _factor(p, fv.UGM3_TO_US_FACTOR))


def quality_flag(parameter, value) -> Column:
    """'implausible' for PM2.5 outside 0..500, otherwise 'valid'."""
    v = _col(value)
    return F.when((_col(parameter) == "pm25") & ~v.between(0, 500), "implausible").otherwise("valid")
