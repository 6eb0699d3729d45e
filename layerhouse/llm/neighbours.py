"""Rows beside their neighbours in one global order, without a global window.

The rows are range-partitioned and sorted; a task sees most neighbours in its own partition. Only the rows at
the ends of a partition need another one: they are joined to it by partition number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ordered(df: DataFrame, *order, ties: str) -> DataFrame:
    """Range partitions in the order given, sorted inside; the adaptive planner may merge neighbouring ones.

    Rows equal in ``order`` follow the hash of the column ``ties`` and then the column itself. The bounds of the
    partitions are made of the order and that hash, so no long value goes to the driver, and many rows of one
    key can be cut.
    """
    mark = F.xxhash64(ties)
    return df.repartitionByRange(*order, mark).sortWithinPartitions(*order, mark, ties)


def beside(parts: DataFrame, part: str = "part") -> DataFrame:
    """Rows (part, before, after): the numbers of the next partitions that hold rows.

    Only the partition numbers are ordered in one window, one row for each partition.
    """
    order = Window.orderBy(part)
    return parts.select(part).distinct().select(
        part, F.lag(part).over(order).alias("before"), F.lead(part).over(order).alias("after"))
