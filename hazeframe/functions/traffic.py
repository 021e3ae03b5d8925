"""Traffic congestion expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazeframe import fixed_values as fv
from hazeframe.functions.aqi import _col
from hazeframe.functions.naming import lookup


def congestion_ratio(current_time, free_time, current_speed, free_speed) -> Column:
    """Relative delay from travel times, else from speeds, else 0; clamped to 0..5."""
    ct, ft = _col(current_time).cast("double"), _col(free_time).cast("double")
    cs, fs = _col(current_speed).cast("double"), _col(free_speed).cast("double")
    raw = (F.when((ft > 0) & (ct > 0), (ct - ft) / ft)
           .when((fs > 0) & (cs > 0), fs / cs - 1).otherwise(0.0))
    return F.greatest(F.lit(0.0), F.least(F.lit(5.0), raw))


def road_proxy(road_type, distance_km) -> Column:
    """Baseline congestion of the nearest road, decaying with distance."""
    base = lookup(_col(road_type), fv.ROAD_BASE_CONGESTION, F.lit(fv.ROAD_BASE_DEFAULT))
    return base * F.exp(-_col(distance_km))


def offpeak_decay(hour) -> Column:
    return lookup(_col(hour).cast("int"), fv.OFFPEAK_DECAY, F.lit(fv.OFFPEAK_DECAY_DEFAULT))


def is_peak_hour(hour) -> Column:
    return _col(hour).between(*fv.PEAK_HOURS)
