"""Catalogue tables on Parquet: schemas, batch appends, and replacement without a gap.

A replaced table is a view over its newest version. The new version is written beside the old
one and the view is switched at the end, so readers see one of both and a lost job leaves the
old version in place.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from layerhouse.contracts import Contract, conform


def create_schemas(spark: SparkSession, names) -> None:
    for name in names:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def list_tables(spark: SparkSession, schema: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(schema))


class Rejected(Exception):
    """Rows without a required value: the version was not shown, the rows are in ``table``."""

    def __init__(self, contract: Contract, nulls: dict[str, int], table: str):
        super().__init__(f"{contract.name}: NULL in required columns {nulls}; the rows are in {table}")
        self.nulls, self.table = nulls, table


def create_table(spark: SparkSession, contract: Contract) -> None:
    """Empty table of the contract, if it is not there yet: a partitioned one for batches, else a first version."""
    if spark.catalog.tableExists(contract.name):
        return
    if not contract.appended:
        publish(spark.createDataFrame([], contract.schema), contract, "empty")
        return
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in contract.schema.fields)
    parts = f" PARTITIONED BY ({', '.join(contract.partition_by)})" if contract.partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {contract.name} ({columns}) USING PARQUET{parts}")


def append_batch(df: DataFrame, contract: Contract, batch_id: str) -> int:
    """Adds a batch and gives its number of rows, counted while writing.

    The table is partitioned by batch, and the batch's own partition is named and replaced: new
    batches add up, and writing one batch twice changes nothing.
    """
    spark = df.sparkSession
    plain_name(batch_id)
    create_table(spark, contract)
    (batch,) = contract.partition_by
    counted, rows = observed(conform(df, contract).drop(batch), contract)
    spark.sql(
        f"INSERT OVERWRITE TABLE {contract.name} PARTITION ({batch} = '{batch_id}') SELECT * FROM {{rows}}",
        rows=counted,
    )
    return rows.get["n_rows"]


def clustered(df: DataFrame, contract: Contract) -> DataFrame:
    """Rows of one table partition together, in tasks of the advisory size.

    One shuffle whose number of tasks follows the data: small table partitions share a task, so each ends up
    in one file, and a very large one is cut over several tasks.
    """
    if not contract.partition_by:
        return df
    return df.hint("rebalance", *[F.col(c) for c in contract.partition_by])


QUARANTINE = "_quarantined"


def publish(df: DataFrame, contract: Contract, version: str, quarantine: bool = False) -> int:
    """Replaces the table's content by ``df`` and gives the number of rows written.

    Every call writes to a name of its own: a repeated run never overwrites what it reads, and is
    not in the way of files that a lost run has left. NULLs in required columns are counted as the rows
    are written; if there are any, the old version stays in view, the rows concerned are kept in a table
    of rejects, and ``Rejected`` is raised. The largest surrogate key ever shown goes along with the view.

    With ``quarantine`` the sound rows are shown all the same. The others lie in the same version, in a partition of
    their own that the view leaves out: one switch shows the former and lists the latter (``quarantined``). A later
    version that holds such a row repaired shows it again, as every version is made of all rows.
    """
    plain_name(version)
    spark = df.sparkSession
    target = f"{contract.name}__{version}_{uuid.uuid4().hex[:8]}"
    counted, seen = observed(clustered(conform(df, contract), contract), contract)
    parts = list(contract.partition_by)
    if quarantine:
        parts.append(QUARANTINE)
        counted = counted.withColumn(QUARANTINE, _broken(contract))
    writer = counted.write.mode("errorifexists").format("parquet")
    if parts:
        writer = writer.partitionBy(*parts)
    writer.saveAsTable(target)
    found = seen.get
    nulls = {c: found[f"_null_{i}"] for i, c in enumerate(contract.required) if found[f"_null_{i}"]}
    if nulls and not quarantine:
        rejects = target.replace("__", "__rejects_", 1)
        missing = " OR ".join(f"`{c}` IS NULL" for c in nulls)
        spark.table(target).filter(missing).write.format("parquet").saveAsTable(rejects)
        spark.sql(f"DROP TABLE {target}")
        raise Rejected(contract, nulls, rejects)
    before = view_property(spark, contract, "holds")
    mark = max(high_water(spark, contract), found["_largest"] or 0) if contract.surrogate else 0
    columns = ", ".join(f"`{c}`" for c in contract.columns)
    spark.sql(
        f"CREATE OR REPLACE VIEW {contract.name} TBLPROPERTIES "
        f"('holds' = '{target}', 'before' = '{before or ''}', 'high_water' = '{mark}') "
        f"AS SELECT {columns} FROM {target}" + (f" WHERE NOT {QUARANTINE}" if quarantine else "")
    )
    return found["n_rows"]


def _broken(contract: Contract) -> Column:
    """Whether a required value is missing."""
    return reduce(Column.__or__, [F.col(c).isNull() for c in contract.required], F.lit(False))


def quarantined(spark: SparkSession, contract: Contract) -> DataFrame:
    """The rows of the version shown that the view leaves out, with the names of the missing values."""
    held = view_property(spark, contract, "holds")
    rows = spark.table(held) if held else spark.createDataFrame([], contract.schema)
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in contract.required]).cast("array<string>"))
    rows = rows.filter(F.col(QUARANTINE)) if QUARANTINE in rows.columns else rows.limit(0)
    return rows.select(*contract.columns, missing.alias("missing"))


def high_water(spark: SparkSession, contract: Contract) -> int:
    """The largest surrogate key that any version of the table has shown; 0 before the first."""
    value = view_property(spark, contract, "high_water")
    if value is not None:
        return int(value)
    if not spark.catalog.tableExists(contract.name):
        return 0
    return spark.table(contract.name).agg(F.max(contract.surrogate)).first()[0] or 0  # shown before marks were kept


def view_property(spark: SparkSession, contract: Contract, name: str) -> str | None:
    if not spark.catalog.tableExists(contract.name):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {contract.name}").collect()
    return {r["key"]: r["value"] for r in rows}.get(name)


def version_before(spark: SparkSession, contract: Contract) -> DataFrame | None:
    """The version that the present one has replaced, if it is still there."""
    name = view_property(spark, contract, "before")
    return version(spark, contract, name) if name and spark.catalog.tableExists(name) else None


def version(spark: SparkSession, contract: Contract, name: str) -> DataFrame:
    """The rows that the version in this table shows."""
    rows = spark.table(name)
    return (rows.filter(~F.col(QUARANTINE)) if QUARANTINE in rows.columns else rows).select(*contract.columns)


def drop_old_versions(spark: SparkSession, contract: Contract, keep_before: bool = False, keep: Sequence[str] = ()) -> list[str]:
    """Drops all versions of a published table but the one its view shows, the one before if asked to
    keep it for a change feed, and those named in ``keep``; tables of rejects stay."""
    held = {*keep, view_property(spark, contract, "holds"), view_property(spark, contract, "before") if keep_before else None}
    schema, table = contract.name.split(".")
    versions = [f"{schema}.{t}" for t in list_tables(spark, schema)
                if t.startswith(f"{table}__") and not t.startswith(f"{table}__rejects_")]
    old = [v for v in versions if v not in held]
    for name in old:
        spark.sql(f"DROP TABLE {name}")
    return old


def plain_name(text: str) -> None:
    if not re.fullmatch(r"[A-Za-z0-9_]+", text):
        raise ValueError(f"{text!r}: only letters, digits and _")


def observed(df: DataFrame, contract: Contract) -> tuple[DataFrame, Observation]:
    """Counts rows and NULLs as they are written. It has to come last: below a shuffle the
    rows of a repeated task would count twice."""
    seen = Observation()
    measures = [F.count(F.lit(1)).alias("n_rows")]
    measures += [F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(contract.required)]
    if contract.surrogate:
        measures.append(F.max(contract.surrogate).alias("_largest"))
    return df.observe(seen, *measures), seen
