"""Name, region and label expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazeframe import fixed_values as fv
from hazeframe.functions.aqi import _col, sql_string, sql_strings


def _literal(x) -> str:
    return sql_string(x) if isinstance(x, str) else repr(x) + ("D" if isinstance(x, float) else "")


def lookup(key: Column, table: dict, default: Column | None = None) -> Column:
    """Literal-map lookup, constant-folded by the optimizer."""
    pairs = ", ".join(f"{_literal(k)}, {_literal(v)}" for k, v in table.items())
    found = F.expr(f"map({pairs})")[key]
    return found if default is None else F.coalesce(found, default)


def _region(province: str, groups: dict[str, list[str]]) -> Column:
    arms = " ".join(f"WHEN {province} IN ({sql_strings(members)}) THEN {sql_string(r)}" for r, members in groups.items())
    return F.expr(f"CASE {arms} ELSE {sql_string(fv.REGION_UNKNOWN)} END")


def region_8(province: str) -> Column:
    return _region(province, fv.REGION_8)


def region_3(province: str) -> Column:
    return _region(province, {r: [p for part in parts for p in fv.REGION_8[part]] for r, parts in fv.REGION_3.items()})


def region_alias(name) -> Column:
    """Localised region name -> canonical region; other text is unchanged."""
    return lookup(F.lower(F.trim(_col(name))), fv.REGION_ALIASES, _col(name))


def standard_parameter(name) -> Column:
    table = {alias: std for std, aliases in fv.PARAMETER_ALIASES.items() for alias in aliases}
    low = F.lower(_col(name))
    return lookup(low, table, low)


def normalise(name) -> Column:
    return F.lower(F.trim(_col(name)))


def normalise_province(name) -> Column:
    """Strip a municipal prefix, then lower-case and trim."""
    return normalise(lookup(_col(name), fv.CITY_PREFIX_ALIASES, _col(name)))


def padded_code(code, width: int = 5) -> Column:
    """Zero-pad a code that may arrive as float text ('123.0'); never truncates."""
    text = _col(code).cast("double").cast("bigint").cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def confidence_level(score) -> Column:
    s = _col(score)
    return F.when(s >= 0.8, "high").when(s >= 0.5, "medium").otherwise("low")


def location_class(province) -> Column:
    p = _col(province)
    return (F.when(p.isin(fv.URBAN_PROVINCES), "Urban")
            .when(p.isin(fv.INDUSTRIAL_PROVINCES), "Industrial").otherwise("Rural"))


def platform_status(latest_lag_hours, reliable_pct) -> Column:
    lag, pct = _col(latest_lag_hours), _col(reliable_pct)
    return (F.when((lag <= 1) & (pct >= 90), "operational")
            .when((lag <= 3) & (pct >= 70), "degraded").otherwise("delayed"))


def season(date) -> Column:
    return F.when(F.month(_col(date)).between(5, 10), "rainy").otherwise("dry")


def health_class(lag_hours) -> Column:
    lag = _col(lag_hours)
    return (F.when(lag <= 1, "Fresh").when(lag <= 3, "Delayed")
            .when(lag <= 24, "Stale").otherwise("Offline"))


def source_of_mix(mix) -> Column:
    return F.when(_col(mix) == "observed", "aqiin").otherwise("openweather")


def fingerprint_class(ratio) -> Column:
    r = _col(ratio)
    return (F.when(r > 0.6, "Combustion/Traffic").when(r < 0.4, "Dust/Construction")
            .otherwise("Mixed"))
