"""Window specs over one series.

Every series window runs on a panel that holds at most one row per series and day (after
`merge_duplicates`), so a window group is bounded by the number of calendar days, however many raw
rows one series had.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from shelfcast.schema import SERIES

BEFORE = Window.unboundedPreceding
HERE = Window.currentRow


def spread(df: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """Partition by series for work that is heavy per row: AQE would merge such partitions by their bytes.

    Windows, grouped maps and joins on the same keys that follow need no further shuffle.
    """
    if not keys:
        return df
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def whole(keys: Sequence[str] = SERIES) -> WindowSpec:
    return Window.partitionBy(*keys)


def ordered(keys: Sequence[str] = SERIES) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy("date")


def up_to_here(keys: Sequence[str] = SERIES) -> WindowSpec:
    return ordered(keys).rowsBetween(BEFORE, HERE)


def from_here(keys: Sequence[str] = SERIES) -> WindowSpec:
    """Reversed order: a running frame costs one pass, an unbounded-following frame is quadratic."""
    return Window.partitionBy(*keys).orderBy(F.col("date").desc()).rowsBetween(BEFORE, HERE)


def previous_known(c: Column, keys: Sequence[str] = SERIES) -> Column:
    return F.last(c, ignorenulls=True).over(up_to_here(keys))


def next_known(c: Column, keys: Sequence[str] = SERIES) -> Column:
    return F.last(c, ignorenulls=True).over(from_here(keys))


def neighbours(c: str, reach: int, keys: Sequence[str] = SERIES) -> tuple[list[Column], list[Column]]:
    """The `reach` values before and after a row, NULL outside the series. Offsets keep no frame buffer."""
    w = ordered(keys)
    return [F.lag(c, k).over(w) for k in range(1, reach + 1)], [F.lead(c, k).over(w) for k in range(1, reach + 1)]


def median_of(values: Sequence[Column]) -> Column:
    """Median of a few columns, NULLs left out; NULL when there is none.

    Infinity stands for NULL so that the array is sorted as primitives, the gaps last.
    """
    known = sum((v.isNotNull().cast("int") for v in values), F.lit(0))
    ranked = F.sort_array(F.array(*[F.coalesce(v, F.lit(float("inf"))) for v in values]))
    return (F.get(ranked, F.shiftright(known - 1, 1)) + F.get(ranked, F.shiftright(known, 1))) / 2
