"""Helpers shared by the query registry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round fractional columns (sums differ in the last bits by order) and drop signed zeros."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.dataType.typeName() in ("double", "float"):
            c = (F.round(c.cast("double"), digits) + F.lit(0.0)).alias(f.name)
        out.append(c)
    return df.select(*out)
