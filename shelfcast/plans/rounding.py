"""Result shaping for comparison: derived doubles are rounded to six places."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rounded(df: DataFrame, *columns: str, places: int = 6, offset: float = 0.0) -> DataFrame:
    """`offset` moves exact half-way values off the tie, where the last bit of a sum would decide."""
    names = columns or [c for c, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.round(F.col(c) + offset, places) for c in names})
