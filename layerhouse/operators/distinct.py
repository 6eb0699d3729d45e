"""Exact distinct counts that roll up.

A count of distinct orders by day cannot be added up to months. Kept beside each group is a state instead that can be merged:
the set of the orders' positions (dense numbers, see ``keys``), cut into buckets of 32,768. A bucket with at most
1,024 positions lists them, two bytes each; a fuller one is a bitmap of 4 KB. A state row therefore holds 4 KB at most, whatever
the size of its group, all rows together two bytes for each pair of group and position at most (and the group's
columns), and a hot group spreads over as many rows as it has buckets. Positions have to be kept when orders are added
(``keys.keep_keys``), or states of different days would number different orders alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

BUCKET, LISTED, BITMAP = "_bucket", "_listed", "_bitmap"
BITS = 1 << 15
MOST_LISTED = 1024


def distinct_state(rows: DataFrame, group: Sequence[str | Column], position: str, most_listed: int = MOST_LISTED) -> DataFrame:
    """Rows (group, bucket, listed, bitmap): the set of ``position`` (0 and up) in each group.

    One of ``listed`` and ``bitmap`` is NULL. A NULL position belongs to no set; a group without any has no row. NULL is
    a group like others.
    """
    at = F.col(position)
    names = rows.select(*group).columns
    placed = rows.filter(at.isNotNull()).select(
        *group, F.floor(at / BITS).alias(BUCKET), F.pmod(at, F.lit(BITS)).cast("smallint").alias("_at"))
    sets = placed.groupBy(*names, BUCKET).agg(F.sort_array(F.collect_set("_at")).alias(LISTED))
    few = sets.filter(F.size(LISTED) <= most_listed).withColumn(BITMAP, F.lit(None).cast("binary"))
    full = _drawn(sets.filter(F.size(LISTED) > most_listed), names).withColumn(LISTED, F.lit(None).cast("array<smallint>"))
    return few.unionByName(full)


def _drawn(state: DataFrame, group: Sequence[str | Column]) -> DataFrame:
    """Bitmaps of the listed positions, one for each group and bucket."""
    names = state.select(*group).columns
    single = state.select(*group, BUCKET, F.explode(LISTED).alias("_at"))
    return single.groupBy(*names, BUCKET).agg(F.bitmap_construct_agg(F.col("_at").cast("bigint")).alias(BITMAP))


def _sets(state: DataFrame, group: Sequence[str | Column]) -> DataFrame:
    """Rows (group, bucket, listed, bitmap) of coarser groups: all listed positions, and the bitmaps joined bit by bit.

    Few positions stay a list, so a group with a handful of them in a bucket never costs 4 KB on its way.
    """
    names = state.select(*group).columns
    at = state.schema[LISTED].dataType.elementType
    given = state.filter(F.col(BITMAP).isNotNull()).select(*group, BUCKET, BITMAP)
    joined = given.groupBy(*names, BUCKET).agg(F.bitmap_or_agg(BITMAP).alias(BITMAP))
    single = state.filter(F.col(LISTED).isNotNull()).select(*group, BUCKET, F.explode(LISTED).alias("_at"))
    both = single.withColumn(BITMAP, F.lit(None).cast("binary")).unionByName(joined.withColumn("_at", F.lit(None).cast(at)))
    return both.groupBy(*names, BUCKET).agg(
        F.sort_array(F.collect_set("_at")).alias(LISTED), F.first(BITMAP, ignorenulls=True).alias(BITMAP))


def merge_states(state: DataFrame, group: Sequence[str | Column], most_listed: int = MOST_LISTED) -> DataFrame:
    """The state of coarser groups: no position is counted twice. It can be merged further and counted."""
    names = state.select(*group).columns
    sets = _sets(state, group)
    short = F.col(BITMAP).isNull() & (F.size(LISTED) <= most_listed)
    large = sets.filter(~short)
    drawn = _drawn(large, names).unionByName(large.filter(F.col(BITMAP).isNotNull()).select(*names, BUCKET, BITMAP))
    full = drawn.groupBy(*names, BUCKET).agg(F.bitmap_or_agg(BITMAP).alias(BITMAP))
    few = sets.filter(short)
    return few.unionByName(full.withColumn(LISTED, F.lit(None).cast(sets.schema[LISTED].dataType)))


def distinct_counts(state: DataFrame, group: Sequence[str | Column], name: str) -> DataFrame:
    """The number of distinct positions in each group of a state; the groups may be coarser than the state's."""
    names = state.select(*group).columns
    beside = F.when(F.col(BITMAP).isNull(), F.size(LISTED)).otherwise(
        F.bitmap_count(BITMAP) + F.size(F.filter(LISTED, lambda at: ~_holds(F.col(BITMAP), at))))
    return _sets(state, group).groupBy(*names).agg(F.sum(beside).alias(name))


def _holds(bitmap: Column, at: Column) -> Column:
    """Whether the bit of a position is set."""
    place = at.cast("int")
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, place % 8) == 1
