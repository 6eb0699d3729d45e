"""The changes of a published table, version by version, and the table as any recorded version showed it.

The log is a table beside the published one, partitioned by version. It knows the version that it was last
written for, so versions between two records are passed over and no change is lost; recording a version again
changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from layerhouse.contracts import Contract
from layerhouse.operators import cdf
from layerhouse.sources import tables

VERSION, NUMBER = "_version", "_number"
KEPT = (cdf.INSERT, cdf.AFTER)


def log_of(contract: Contract) -> Contract:
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in contract.schema.fields]
    ddl = ", ".join([*columns, f"{cdf.CHANGE_TYPE} STRING", f"{NUMBER} INT", f"{VERSION} STRING"])
    return Contract(f"{contract.name}_change_log", ddl, partition_by=(VERSION,), appended=True)


def last_recorded(spark: SparkSession, contract: Contract) -> str | None:
    """The table that holds the version recorded last; it must stay until the next record."""
    return tables.view_property(spark, log_of(contract), "recorded")


def record(spark: SparkSession, contract: Contract) -> int:
    """Adds the changes since the version recorded last, all rows as inserts the first time; rows added.

    A lost job leaves at most the version's own partition, which the next call replaces.
    """
    log, shown = log_of(contract), tables.view_property(spark, contract, "holds")
    if not shown:
        return 0
    tables.create_table(spark, log)
    last = last_recorded(spark, contract)
    if last == shown:
        return 0
    if last and not spark.catalog.tableExists(last):
        raise ValueError(f"{log.name}: the version recorded last, {last}, is gone; the changes since then cannot be told")
    number = int(tables.view_property(spark, log, "number") or 0) + 1
    old = tables.version(spark, contract, last) if last else spark.createDataFrame([], contract.schema)
    feed = cdf.change_feed(old, tables.version(spark, contract, shown), contract.key)
    written = tables.append_batch(feed.withColumn(NUMBER, F.lit(number)), log, shown[len(contract.name) + 2:])
    spark.sql(f"ALTER TABLE {log.name} SET TBLPROPERTIES ('recorded' = '{shown}', 'number' = '{number}')")
    return written


def as_recorded(spark: SparkSession, contract: Contract, number: int | None = None) -> DataFrame:
    """The table as the record of this number, or the last one, found it: the last image of each key, unless a deletion.

    One aggregate by key, with a row per key from each map task; later records are not read into it. NULL is a key like others.
    """
    rows = spark.table(log_of(contract).name)
    if number is not None:
        rows = rows.filter(F.col(NUMBER) <= number)
    rows = rows.filter(F.col(cdf.CHANGE_TYPE) != cdf.BEFORE)
    image = F.struct(*[F.col(f"`{c}`") for c in contract.columns], F.col(cdf.CHANGE_TYPE))
    last = rows.groupBy(F.struct(*[F.col(f"`{c}`") for c in contract.key]).alias(cdf.KEY)).agg(F.max_by(image, NUMBER).alias("_last"))
    return last.select("_last.*").filter(F.col(cdf.CHANGE_TYPE).isin(*KEPT)).select(*[F.col(f"`{c}`") for c in contract.columns])
