"""File layout by the interleaved bits of several columns, so that a filter on any of them skips files.

Rows that lie close in all columns get close positions on one curve. Files hold stretches of that curve, so the smallest and
largest value that Parquet keeps of each column in each file are close in every one of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

BITS = 16


def interleaved(places: Sequence[Column], bits: int = BITS) -> Column:
    """One number from non-negative ``places`` below 2^bits: bit i of each, then bit i-1 of each, and so on."""
    if len(places) * bits > 62:
        raise ValueError("too many bits for one number")
    n = len(places)
    value = F.lit(0).cast("bigint")
    for i in range(bits):
        for k, place in enumerate(places):
            bit = F.shiftright(place.cast("bigint"), i).bitwiseAND(F.lit(1).cast("bigint"))
            value = value.bitwiseOR(F.shiftleft(bit, i * n + (n - 1 - k)))
    return value


def laid_out(df: DataFrame, columns: Sequence[str], files: int, within: Sequence[str] = (), bits: int = BITS,
             ties: Sequence[str] = ()) -> DataFrame:
    """Rows in ``files`` range partitions along the curve over numeric ``columns``, to be written one file each.

    Values are placed by their distance from the smallest one; NULL comes first. ``within`` columns order before the curve, as
    a day does. ``ties`` cut a stretch of equal values, a hot product in one store, into several files.
    """
    least = df.agg(*[F.min(c).alias(f"a{i}") for i, c in enumerate(columns)], *[F.max(c).alias(f"b{i}") for i, c in enumerate(columns)])
    bounds = least.select(F.struct("*").alias("b")).scalar()
    places = []
    for i, c in enumerate(columns):
        low, high = bounds[f"a{i}"], bounds[f"b{i}"]
        places.append(F.coalesce(F.floor((F.col(c) - low) / (high - low + 1) * (1 << bits)), F.lit(0)))
    placed = df.withColumn("_place", interleaved(places, bits))
    order = [*within, "_place", *ties]
    return placed.repartitionByRange(files, *order).sortWithinPartitions(*order).drop("_place")
