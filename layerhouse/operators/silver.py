"""Typed layer: latest row per key, safe casts, rejected values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from layerhouse.operators.bronze import SOURCE_FILE


def latest_per_key(df: DataFrame, key: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """One row per key: the first by ``newest_first``, which should order all rows of a key.

    Spark keeps one row per key in every map task before the shuffle (WindowGroupLimit), so a
    key with a very large number of copies costs its reducer one row per map task.
    """
    if not newest_first:
        raise ValueError("an order is needed: without one the surviving row is arbitrary")
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*newest_first))
    return df.withColumn("_rn", rank).filter(F.col("_rn") == 1).drop("_rn")


def apply_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Casts the named columns; a malformed value becomes NULL instead of failing the job."""
    return df.select(*[
        F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns
    ])


def cast_rejects(df: DataFrame, key: Sequence[str], types: Mapping[str, str]) -> DataFrame:
    """One row per value that ``apply_types`` turns into NULL, with column, target type and text.

    Sound rows are filtered out before anything is built for them.
    """
    bad = {c: F.col(c).isNotNull() & F.col(c).try_cast(t).isNull() for c, t in types.items()}
    found = F.array(*[
        F.when(bad[c], F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("target_type"),
                                F.col(c).cast("string").alias("raw_value")))
        for c, t in types.items()
    ])
    return (
        df.filter(reduce(Column.__or__, bad.values()))
        .select(*key, F.explode(found).alias("_reject"))
        .filter(F.col("_reject").isNotNull())
        .select(*key, "_reject.column_name", "_reject.target_type", "_reject.raw_value")
    )


def dedup_and_type(bronze: DataFrame, key: Sequence[str], types: Mapping[str, str],
                   newest_first: Sequence[Column], drop: Sequence[str] = (SOURCE_FILE,)) -> DataFrame:
    """Raw table to typed table: latest row per key, without the raw-only columns, typed."""
    return apply_types(latest_per_key(bronze.drop(*drop), key, newest_first), types)
