"""Air-quality index expressions.

Tables become one ``CASE`` text each, parsed by Spark in a single call: a column
built operator by operator costs a driver round trip per node, and these hold
hundreds.  Arguments are therefore column names (or SQL text), not Columns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazeframe import fixed_values as fv


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def sql_number(x: float) -> str:
    return f"{float(x)!r}D"


def sql_string(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_strings(values) -> str:
    return ", ".join(sql_string(v) for v in values)


def _piecewise_text(value: str, bands) -> str:
    steps = []
    for conc_lo, conc_hi, idx_lo, idx_hi in bands:
        slope = sql_number((idx_hi - idx_lo) / (conc_hi - conc_lo))
        steps.append(f"WHEN {value} <= {sql_number(conc_hi)} "
                     f"THEN {sql_number(idx_lo)} + ({value} - {sql_number(conc_lo)}) * {slope}")
    return f"CASE {' '.join(steps)} END"


def _by_parameter(parameter: str, texts: dict[str, str], otherwise: str = "NULL") -> Column:
    arms = " ".join(f"WHEN {sql_string(p)} THEN {text}" for p, text in texts.items())
    return F.expr(f"CASE lower({parameter}) {arms} ELSE {otherwise} END")


def piecewise_index(concentration: str, bands) -> Column:
    """Piecewise-linear index over ``(conc_lo, conc_hi, idx_lo, idx_hi)`` bands.

    A value between two bands belongs to the upper band's line; a value above
    the last band (or NULL) gives NULL.
    """
    return F.expr(_piecewise_text(concentration, bands))


def us_aqi(parameter: str, concentration: str) -> Column:
    """US sub-index; concentration in US units (see ``units.to_us_units``)."""
    return _by_parameter(parameter, {p: _piecewise_text(concentration, b) for p, b in fv.US_BREAKPOINTS.items()})


def vn_aqi(parameter: str, concentration: str) -> Column:
    """National sub-index; concentration in ug/m3."""
    return _by_parameter(parameter, {p: _piecewise_text(concentration, b) for p, b in fv.VN_BREAKPOINTS.items()})


def _thresholds(value: str, steps, above: str) -> Column:
    arms = " ".join(f"WHEN {value} <= {bound} THEN {sql_string(label)}" for bound, label in steps)
    return F.expr(f"CASE WHEN {value} IS NULL THEN NULL {arms} ELSE {sql_string(above)} END")


def aqi_category(index: str) -> Column:
    return _thresholds(index, fv.AQI_CATEGORIES, fv.AQI_CATEGORY_ABOVE)


def aqi_histogram_key(index: str) -> Column:
    return _thresholds(index, fv.AQI_HISTOGRAM_KEYS, fv.AQI_HISTOGRAM_KEY_ABOVE)


def aqi_to_concentration(parameter: str, index: str) -> Column:
    """Inverse of the US index, two decimals.

    Index <= 0 gives 0; beyond the last band its line extrapolates; a value in
    the gap between two integer bands, or an unknown pollutant, is unchanged.
    """
    i = f"CAST({index} AS DOUBLE)"
    texts = {}
    for name, bands in fv.US_BREAKPOINTS.items():
        arms = [f"WHEN {i} <= 0 THEN 0D"]
        for band in bands:
            conc_lo, conc_hi, idx_lo, idx_hi = band
            open_end = f" OR {i} > {idx_hi}" if band == bands[-1] else ""
            arms.append(f"WHEN {i} BETWEEN {idx_lo} AND {idx_hi}{open_end} THEN round({sql_number(conc_lo)} + ({i} - {idx_lo}) * "
                        f"{sql_number(conc_hi - conc_lo)} / {sql_number(idx_hi - idx_lo)}, 2)")
        texts[name] = f"CASE {' '.join(arms)} ELSE {i} END"
    return _by_parameter(parameter, texts, f"CASE WHEN {i} <= 0 THEN 0D ELSE {i} END")


def main_pollutant(sub_indices: dict[str, str], null_safe: bool = False) -> Column:
    """Pollutant (key) with the highest sub-index (column); earlier keys win ties.

    Strict mode drops a branch as soon as one compared value is NULL, so a row
    holding only PM2.5 falls through to the last name.  Null-safe mode compares
    only the values present and gives NULL when there are none.
    """
    names = list(sub_indices)
    if null_safe:
        best = f"greatest({', '.join(sub_indices.values())})"  # skips NULL
        arms = " ".join(f"WHEN {c} = {best} THEN {sql_string(n)}" for n, c in sub_indices.items())
        return F.expr(f"CASE {arms} END")
    arms = []
    for i, name in enumerate(names[:-1]):
        beats = " AND ".join(f"{sub_indices[name]} >= {sub_indices[other]}" for other in names[i + 1:])
        arms.append(f"WHEN {beats} THEN {sql_string(name)}")
    return F.expr(f"CASE {' '.join(arms)} ELSE {sql_string(names[-1])} END")
