"""The version of a key that was valid at a moment, without a range join.

Rows and version starts are merged into one sorted stream for each key, and every row takes the last
version that started before it. A key with a large part of the rows is cut into chunks of time; only the last version of
each chunk crosses to the later ones. Whether that version still held is decided from its end.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

VALID_FROM, VALID_TO = "valid_from", "valid_to"


def by_month(moment: Column) -> Column:
    return F.trunc(moment, "month")


def with_version(rows: DataFrame, versions: DataFrame, key: Sequence[str], moment: str, columns: Sequence[str],
                 chunk: Callable[[Column], Column] = by_month, name: str = "_version") -> DataFrame:
    """Adds the struct of ``columns`` of the version with valid_from <= moment < valid_to, NULL where there is none.

    An open end is NULL. Versions of one key must not overlap. A NULL key or moment finds no version, and so does
    a moment before the first version, after the last one's end, or in a gap. ``chunk`` maps a moment to a
    value that rises with it; rows of one key and chunk meet in one task.
    """
    if not columns:
        raise ValueError("name at least one column of the versions")
    at = F.col(moment).cast("timestamp")
    found = F.struct(F.col(VALID_TO).cast("timestamp").alias("_until"), *[F.col(c) for c in columns])
    known = reduce(Column.__and__, [F.col(c).isNotNull() for c in (*key, VALID_FROM)])
    same_names = lambda df: F.struct(*[F.col(k).cast(rows.schema[k].dataType).alias(k) for k in key]).alias("_key")
    starts = versions.filter(known).select(
        same_names(versions), F.col(VALID_FROM).cast("timestamp").alias("_at"), F.lit(0).alias("_kind"),
        F.lit(None).cast(rows.schema).alias("_row"), found.alias("_found"))
    moved = rows.select(
        same_names(rows), at.alias("_at"), F.lit(1).alias("_kind"), F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row"),
        F.lit(None).cast(starts.schema["_found"].dataType).alias("_found"))
    both = moved.unionByName(starts).withColumn("_cut", F.struct("_key", chunk(F.col("_at")).alias("chunk")))
    # Of two versions with one start the longer one counts: the other is empty.
    longest = F.struct(F.col("_at"), F.col("_found")["_until"].isNull(), F.col("_found")["_until"])
    stream = Window.partitionBy("_cut").orderBy("_at", "_kind", F.col("_found")["_until"].asc_nulls_last())
    inner = both.withColumn("_last", F.last("_found", ignorenulls=True).over(stream.rowsBetween(Window.unboundedPreceding, 0)))
    earlier = Window.partitionBy("_cut._key").orderBy("_cut.chunk").rowsBetween(Window.unboundedPreceding, -1)
    borders = both.groupBy("_cut").agg(F.max_by(F.col("_found"), F.when(F.col("_kind") == 0, longest)).alias("_border")).select(
        "_cut", F.last("_border", ignorenulls=True).over(earlier).alias("_carried"))
    last = F.coalesce("_last", "_carried")
    holds = last["_until"].isNull() | (F.col("_at") < last["_until"])
    version = F.when(F.col("_at").isNotNull() & holds, F.struct(*[last[c].alias(c) for c in columns]))
    return inner.filter("_kind = 1").join(borders, "_cut").select(
        "_row.*", F.when(last.isNotNull(), version).alias(name))
