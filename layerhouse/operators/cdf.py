"""Row changes between two versions of a table, and their application."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

CHANGE_TYPE = "_change_type"
KEY = "_key"
INSERT, DELETE = "insert", "delete"
BEFORE, AFTER = "update_preimage", "update_postimage"


def _with_columns(df: DataFrame, other: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = {c: F.lit(None).cast(other.schema[c].dataType) for c in columns if c not in df.columns}
    return df.withColumns(missing).select(*columns)


def _one_each(df: DataFrame, key: Sequence[str], name: str) -> DataFrame:
    """Key and row as structs. A struct is never NULL and equal where all its fields are, NULLs among them.

    The check for repeated keys is an aggregate by key, so it shares the shuffle of the join on it.
    """
    again = F.concat(F.lit("a key occurs twice in one version: "), F.to_json(KEY))
    rows = df.select(F.struct(*key).alias(KEY), F.struct(*df.columns).alias(name))
    counted = rows.groupBy(KEY).agg(F.first(name).alias(name), F.count(F.lit(1)).alias("_n"))
    return counted.select(KEY, F.when(F.col("_n") == 1, F.col(name)).otherwise(F.raise_error(again)).alias(name))


def change_feed(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """insert, delete, and both images of each update; one join on the primary key.

    A column that only one version has is NULL in the other, so a row that gains a value is an update.
    NULL is a key like others; the job fails when a key occurs twice in a version.
    """
    columns = [*old.columns, *(c for c in new.columns if c not in old.columns)]
    old, new = _with_columns(old, new, columns), _with_columns(new, old, columns)
    left, right = _one_each(old, key, "_old"), _one_each(new, key, "_new")
    a, b = F.col("_old"), F.col("_new")

    def image(row, kind):
        return F.struct(*[row[c].alias(c) for c in columns], F.lit(kind).alias(CHANGE_TYPE))

    changes = (
        F.when(a.isNull(), F.array(image(b, INSERT)))
        .when(b.isNull(), F.array(image(a, DELETE)))
        .otherwise(F.array(image(a, BEFORE), image(b, AFTER)))
    )
    changed = left.join(right, KEY, "full_outer").filter(~a.eqNullSafe(b))
    return changed.select(F.explode_outer(changes).alias("_c")).select("_c.*")


def apply_changes(old: DataFrame, changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """The new version of the table from the old one and its change feed, with all columns of the feed.

    NULL is a key like others.
    """
    columns = [c for c in changes.columns if c != CHANGE_TYPE]
    touched = changes.select(F.struct(*key).alias(KEY)).distinct()
    kept = old.withColumn(KEY, F.struct(*key)).join(touched, KEY, "left_anti").drop(KEY)
    kept = _with_columns(kept, changes, columns)
    arrived = changes.filter(F.col(CHANGE_TYPE).isin(INSERT, AFTER)).select(*columns)
    return kept.unionByName(arrived)


BUCKET = "_bucket"


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def digests(df: DataFrame, key: Sequence[str], buckets: int = 256) -> DataFrame:
    """Rows (_bucket, n, a, b): per hash bucket of the key, the number of rows and two sums of their hashes.

    The sums do not depend on the order of the rows. Kept with a version, they tell which buckets another one has changed.
    """
    row = [F.col(f"`{c}`") for c in sorted(df.columns)]
    # A hash skips NULLs, so which values are NULL is hashed too.
    gaps = F.concat_ws("", *[F.when(c.isNull(), "1").otherwise("0") for c in row])
    total = lambda *more: F.sum(F.xxhash64(*more, gaps, *row).cast("decimal(38,0)"))
    return df.groupBy(bucket_of(key, buckets).alias(BUCKET)).agg(
        F.count(F.lit(1)).alias("n"), total(F.lit(1)).alias("a"), total(F.lit(2)).alias("b"))


def changed_buckets(old: DataFrame, new: DataFrame) -> list[int]:
    """Buckets whose digests differ; never more than there are buckets."""
    pairs = old.select(BUCKET, F.struct("n", "a", "b").alias("_o")).join(
        new.select(BUCKET, F.struct("n", "a", "b").alias("_n")), BUCKET, "full_outer")
    return sorted(r[0] for r in pairs.filter(~F.col("_o").eqNullSafe(F.col("_n"))).select(BUCKET).collect())


def change_feed_of_buckets(old: DataFrame, new: DataFrame, key: Sequence[str], changed: Sequence[int]) -> DataFrame:
    """The change feed of tables stored by ``_bucket``: only the buckets named are read and joined.

    Both tables must have been written with the same number of buckets, and the same columns, or all buckets differ.
    """
    some = lambda df: df.filter(F.col(BUCKET).isin(list(changed))).drop(BUCKET)
    return change_feed(some(old), some(new), key)
