"""Scans over ordered rows in which one key may hold any share of all rows.

Rows are dealt to ranges of (keys, order) by sampled splitters and written; a window works inside each range, and what a
range needs of those before or after it comes from a table with a row for each range and key. Only the first key of a range
can go on from an earlier one, so what is handed over has fewer rows than there are ranges, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import saved


def in_ranges(rows: DataFrame, by: Sequence[str], keep: Callable[[DataFrame], DataFrame] = saved) -> DataFrame:
    """The rows, written, with the number of their range in _range; ranges grow with ``by``, nulls first."""
    return keep(rows.repartitionByRange(*by).withColumn("_range", F.spark_partition_id()))


def _handed_over(parts: DataFrame, carried: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Joins what ranges hand over, which has at most two rows for each range."""
    names = {k: f"_k{i}" for i, k in enumerate(["_range", *keys])}
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()]
    on = same[0]
    for x in same[1:]:
        on = on & x
    return parts.join(F.broadcast(carried.withColumnsRenamed(names)), on, "left").drop(*names.values())


def running(rows: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, Column], how: Callable = F.sum, keep: Callable[[DataFrame], DataFrame] = saved) -> DataFrame:
    """Adds the sums so far (this row's included) of ``values``, by name, in each key's order.

    ``how`` may be another aggregate that merges with itself and skips nulls, as min and max do.
    """
    parts = in_ranges(rows, [*keys, *order], keep)
    here = Window.partitionBy("_range", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy("_range", *keys).agg(*[how(v).alias(f"_c{i}") for i, v in enumerate(values.values())])
    carried = totals.select("_range", *keys, *[how(f"_c{i}").over(earlier).alias(f"_c{i}") for i in range(len(values))], F.count("*").over(earlier).alias("_n")).where("_n > 0").drop("_n")
    both = _handed_over(parts.withColumns({n: how(v).over(here) for n, v in values.items()}), carried, keys)
    merged = {n: F.when(F.col(f"_c{i}").isNull(), F.col(n)).when(F.col(n).isNull(), F.col(f"_c{i}")) for i, n in enumerate(values)}
    merge = {F.sum: lambda a, b: a + b, F.max: F.greatest, F.min: F.least}[how]
    return both.withColumns({n: m.otherwise(merge(F.col(n), F.col(f"_c{i}"))) for i, (n, m) in enumerate(merged.items())}).drop("_range", *[f"_c{i}" for i in range(len(values))])


def neighbours(rows: DataFrame, keys: Sequence[str], order: Sequence[str], col: str, keep: Callable[[DataFrame], DataFrame] = saved) -> DataFrame:
    """Adds before and after: ``col`` of the row before and after this one in its key's order, null at the ends."""
    parts = in_ranges(rows, [*keys, *order], keep)
    here = Window.partitionBy("_range", *keys).orderBy(*order)
    place = F.struct(*order)
    ends = parts.groupBy("_range", *keys).agg(F.min_by(col, place).alias("_first"), F.max_by(col, place).alias("_last"))
    across = Window.partitionBy(*keys).orderBy("_range")
    carried = ends.select("_range", *keys, F.lag("_last").over(across).alias("_c0"), F.lead("_first").over(across).alias("_c1")).where("_c0 IS NOT NULL OR _c1 IS NOT NULL")
    local = parts.withColumn("before", F.lag(col).over(here)).withColumn("after", F.lead(col).over(here))
    return _handed_over(local, carried, keys).withColumn("before", F.coalesce("before", "_c0")).withColumn("after", F.coalesce("after", "_c1")).drop("_range", "_c0", "_c1")
