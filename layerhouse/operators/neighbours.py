"""Previous and next row of a key when one key may hold a large part of the table.

A window partitioned by key alone puts a hot key into one task. Here the rows of a key are cut
into chunks by a column that rises with the order (a day, a month): the window runs
inside (key, chunk), and only one summary row per chunk crosses chunk borders. Choose the chunk
so that the rows of one key in one chunk fit a task. With ``chunk=None`` the plain window is
used; that is for keys whose number of rows has a known small bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


CUT = "_cut"


def _cut(df: DataFrame, key: Sequence[str], chunk: str) -> DataFrame:
    """Key and chunk as one struct: it is never NULL and equal where all its fields are, NULLs among them,
    so rows with a NULL key or chunk meet their summary like all others."""
    return df.withColumn(CUT, F.struct(F.struct(*key).alias("key"), F.col(chunk).alias("chunk")))


def with_previous(df: DataFrame, key: Sequence[str], chunk: str | None, order: Sequence[str],
                  columns: Sequence[str | Column], name: str, last: str) -> DataFrame:
    """Adds the struct of ``columns`` from the row before (NULL on a key's first row) as ``name``,
    and whether the row is the key's last as ``last``."""
    values = F.struct(*columns)
    if chunk is None:
        window = Window.partitionBy(*key).orderBy(*order)
        return df.withColumns({name: F.lag(values).over(window), last: F.lead(F.lit(1)).over(window).isNull()})
    df = _cut(df, key, chunk)
    window = Window.partitionBy(CUT).orderBy(*order)
    inner = df.withColumns({name: F.lag(values).over(window), last: F.lead(F.lit(1)).over(window).isNull()})
    chunks = Window.partitionBy(f"{CUT}.key").orderBy(f"{CUT}.chunk")
    borders = (
        df.groupBy(CUT)
        .agg(F.max_by(values, F.struct(*order)).alias("_border"))
        .select(
            CUT, F.lag("_border").over(chunks).alias("_carried"),
            F.lead(F.lit(1)).over(chunks).isNull().alias("_final"),
        )
    )
    return (
        inner.join(borders, CUT)
        .withColumns({name: F.coalesce(F.col(name), F.col("_carried")), last: F.col(last) & F.col("_final")})
        .drop("_carried", "_final", CUT)
    )


def with_next(df: DataFrame, key: Sequence[str], chunk: str | None, order: Sequence[str],
              columns: Sequence[str | Column], name: str) -> DataFrame:
    """Adds the struct of ``columns`` from the row after, NULL on the last row of a key."""
    values = F.struct(*columns)
    if chunk is None:
        return df.withColumn(name, F.lead(values).over(Window.partitionBy(*key).orderBy(*order)))
    df = _cut(df, key, chunk)
    inner = df.withColumn(name, F.lead(values).over(Window.partitionBy(CUT).orderBy(*order)))
    chunks = Window.partitionBy(f"{CUT}.key").orderBy(f"{CUT}.chunk")
    borders = (
        df.groupBy(CUT)
        .agg(F.min_by(values, F.struct(*order)).alias("_border"))
        .select(CUT, F.lead("_border").over(chunks).alias("_carried"))
    )
    return (
        inner.join(borders, CUT)
        .withColumn(name, F.coalesce(F.col(name), F.col("_carried")))
        .drop("_carried", CUT)
    )
