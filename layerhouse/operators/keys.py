"""Surrogate keys and dense positions, without sorting a whole table in one task.

Keys are spread over hash buckets; numbering happens inside a bucket. Keys must be unique in the
input, which makes buckets even whatever the data looks like. Size ``digits`` so a bucket
holds at most a few million keys: 3 digits are 4,096 buckets, 4 are 65,536.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

MAX_DIGITS = 4


def _digest(key: Sequence[str]) -> Column:
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in key]))


def _bucketed(df: DataFrame, key: Sequence[str], digits: int) -> DataFrame:
    if not 1 <= digits <= MAX_DIGITS:
        raise ValueError(f"digits must be 1 to {MAX_DIGITS}")
    digest = df.withColumn("_digest", _digest(key))
    bucket = F.conv(F.substring("_digest", 1, digits), 16, 10).cast("int")
    # Never NULL: said here, so that joining on it adds no filter that hashes every key again.
    return digest.withColumn("_bucket", F.coalesce(bucket, F.lit(0)))


def dense_position(df: DataFrame, key: Sequence[str], name: str, within: Sequence[str] = (),
                   digits: int = 3) -> DataFrame:
    """Position 0, 1, 2 ... in digest order, restarted for each ``within`` group.

    The result does not depend on ``digits``, as buckets are prefixes of the sort order. Bucket
    sizes are counted first; their running total has at most 16^digits rows per group.
    """
    # The group as a struct: a NULL group is a group like others, and joins like others.
    group = F.struct(*[F.col(c) for c in within]) if within else F.lit(0)
    rows = _bucketed(df, key, digits).withColumn("_group", group)
    sizes = rows.groupBy("_group", "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy("_group").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_group", "_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset")
    )
    inside = Window.partitionBy("_group", "_bucket").orderBy("_digest", *key)
    return (
        rows.withColumn("_rank", F.row_number().over(inside))
        .join(offsets, ["_group", "_bucket"])
        .withColumn(name, (F.col("_offset") + F.col("_rank") - 1).cast("bigint"))
        .drop("_digest", "_bucket", "_group", "_rank", "_offset")
    )


def dense_keys(df: DataFrame, key: Sequence[str], name: str, after: int = 0, digits: int = 3) -> DataFrame:
    """Gap-free surrogate keys following ``after``; reads the input twice (count, then number)."""
    return dense_position(df, key, name, digits=digits).withColumn(name, F.col(name) + 1 + F.lit(after))


def strided_keys(df: DataFrame, key: Sequence[str], name: str, after: Column | int = 0,
                 digits: int = 3) -> DataFrame:
    """Unique surrogate keys in one pass and one shuffle; they may have gaps.

    Bucket b of B numbers its rows b+1, b+1+B, b+1+2B and so on, so no bucket has to know the
    size of another.
    """
    rows = _bucketed(df, key, digits)
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("_digest", *key))
    start = F.lit(after) if isinstance(after, int) else after
    value = start + (rank - 1).cast("bigint") * (16 ** digits) + F.col("_bucket") + 1
    return rows.withColumn(name, value.cast("bigint")).drop("_digest", "_bucket")


def number_missing(df: DataFrame, key: Sequence[str], name: str, after: Column | int, digits: int = 3) -> DataFrame:
    """Rows without a surrogate key get one above ``after``; the others keep theirs.

    ``after`` should be the largest key ever given out, see ``tables.high_water``. The input is read
    once: old and new rows are numbered side by side in each bucket, and only the new ones take it.
    """
    rows = _bucketed(df, key, digits)
    rank = F.row_number().over(
        Window.partitionBy("_bucket", F.col(name).isNull()).orderBy("_digest", *key))
    start = F.lit(after) if isinstance(after, int) else after
    value = start + (rank - 1).cast("bigint") * (16 ** digits) + F.col("_bucket") + 1
    return rows.withColumn(name, F.coalesce(F.col(name), value).cast("bigint")).drop("_digest", "_bucket")


def keep_keys(df: DataFrame, before: DataFrame, key: Sequence[str], name: str, after: Column | int,
              digits: int = 3) -> DataFrame:
    """Rows known ``before`` keep their surrogate key, new ones are numbered above ``after``.

    NULL is a key like others; the job fails when a key occurs twice in ``before``.
    """
    twice = F.concat(F.lit("a key has two surrogate keys: "), F.to_json("_key"))
    held = before.groupBy(F.struct(*key).alias("_key")).agg(F.first(name).alias(name), F.count(F.lit(1)).alias("_n"))
    held = held.select("_key", F.when(F.col("_n") == 1, F.col(name)).otherwise(F.raise_error(twice)).alias(name))
    known = df.withColumn("_key", F.struct(*key)).join(held, "_key", "left").drop("_key")
    return number_missing(known, key, name, after, digits)


def largest(df: DataFrame, name: str) -> Column:
    """The largest key in a table as a scalar, 0 if it is empty; the mark of a table that never lost a row."""
    return df.agg(F.coalesce(F.max(name), F.lit(0))).scalar()
