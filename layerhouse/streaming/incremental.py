"""Ingestion of only the landing files that have not been loaded yet: raw, latest rows, and version history.

Each run picks up the new files, loads them as batches and stops; the checkpoint remembers what
was read. A batch that is repeated after a failure gets the same id: the raw table replaces
the rows of that id, the latest rows come out the same, and a history that has it already is left as it is.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from layerhouse.contracts import SOURCE_COLUMNS, Contract, conform, text_schema
from layerhouse.operators.bronze import to_bronze
from layerhouse.operators.scd import Scd2Spec, scd2_merge
from layerhouse.operators.silver import apply_types, latest_per_key
from layerhouse.sources import patched, tables


def ingest_new_files(spark: SparkSession, landing: str, table: str, contract: Contract, checkpoint: str,
                     run_id: str, batch_ts: str, files_per_batch: int = 1000) -> int:
    """Loads the new CSV files of one source table; gives the number of rows loaded.

    A file whose header does not name the schema's columns in order fails the run.

    ``run_id`` must be new for every checkpoint folder. Batch ids are ``run_id`` and the stream's
    batch number, which goes on counting over the runs that share a checkpoint.
    """
    loaded = []

    def load(batch: DataFrame, number: int) -> None:
        batch_id = f"{run_id}_{number}"
        raw = to_bronze(batch, table, batch_id, batch_ts)
        loaded.append(tables.append_batch(raw, contract, batch_id))

    _each_batch(spark, landing, text_schema(SOURCE_COLUMNS[table]), load, checkpoint, files_per_batch)
    _read_anew(spark, contract)
    return sum(loaded)


def _each_batch(spark: SparkSession, landing: str, schema: StructType, load: Callable[[DataFrame, int], None], checkpoint: str,
                files_per_batch: int) -> None:
    stream = (
        spark.readStream.schema(schema)
        .options(header=True, enforceSchema=False, quote='"', escape='"', maxFilesPerTrigger=files_per_batch)
        .csv(landing)
    )
    run = (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()


def _read_anew(spark: SparkSession, contract: Contract) -> None:
    """The stream writes in a session of its own; the caller's may remember files that have been replaced."""
    if spark.catalog.tableExists(contract.name):
        spark.catalog.refreshTable(contract.name)


def follow_latest(spark: SparkSession, landing: str, schema: StructType, latest: Contract, key: Sequence[str],
                  newest_first: Sequence[Column], source: str, checkpoint: str, run_id: str, batch_ts: str,
                  buckets: int = 64, files_per_batch: int = 1000) -> int:
    """Keeps the newest row of each key, as text with audit columns, over all files so far; rows written.

    The table (``latest``) is stored by hash bucket of the key. A batch meets the rows of its keys' buckets and replaces these
    buckets alone, so late rows lose against newer ones by the given total order, in whatever batch they come.
    ``silver.apply_types`` makes the typed table of it, see ``typed_view``.
    """
    of_key, written = patched.bucket(key, buckets), []

    def load(batch: DataFrame, number: int) -> None:
        version = f"{run_id}_{number}"
        rows = conform(to_bronze(batch, source, version, batch_ts), latest)
        touched = None
        own = batch.sparkSession
        if patched.exists(own, latest):
            touched = sorted(r[0] for r in rows.select(of_key).distinct().collect())  # at most ``buckets`` names
            held = patched.with_parts(own, latest).filter(F.col(patched.PART).isin(touched))
            rows = rows.unionByName(held.select(*rows.columns))
        written.append(patched.commit(latest_per_key(rows, key, newest_first), latest, of_key, version, touched))

    _each_batch(spark, landing, schema, load, checkpoint, files_per_batch)
    return sum(written)


def typed_view(spark: SparkSession, latest: Contract, target: Contract, types: Mapping[str, str]) -> None:
    """The typed table as a view over the latest rows; those without a required value wait outside until they are repaired."""
    cast = [f"TRY_CAST(`{x}` AS {types[x]}) AS `{x}`" if x in types else f"`{x}`" for x in target.columns]
    whole = " AND ".join(f"`{x}` IS NOT NULL" for x in target.required) or "TRUE"
    spark.sql(f"CREATE OR REPLACE VIEW {target.name} AS SELECT * FROM (SELECT {', '.join(cast)} FROM {latest.name}) WHERE {whole}")


def follow_history(spark: SparkSession, landing: str, schema: StructType, types: Mapping[str, str], seen: Contract, dim: Contract,
                   spec: Scd2Spec, moment: str, checkpoint: str, run_id: str, files_per_batch: int = 1000) -> int:
    """Version history of a dimension from files of its rows, each with its ``moment``; files may come in any order.

    ``seen`` keeps all rows by batch, ``dim`` is replaced by ``scd.scd2_merge`` of each batch. A batch that the version shown
    already holds is not merged again. Rows that came before under the same key and moment fail the run.
    """
    written = []

    def load(batch: DataFrame, number: int) -> None:
        batch_id = f"{run_id}_{number}"
        arrivals = apply_types(batch, types).withColumn("_batch_id", F.lit(batch_id))
        tables.append_batch(arrivals, seen, batch_id)
        own = batch.sparkSession
        if (tables.view_property(own, dim, "holds") or "").startswith(f"{dim.name}__{batch_id}_"):
            return
        known = own.table(dim.name) if own.catalog.tableExists(dim.name) else own.createDataFrame([], dim.schema)
        all_rows = own.table(seen.name)
        merged = scd2_merge(known, all_rows.filter(F.col("_batch_id") != batch_id), all_rows.filter(F.col("_batch_id") == batch_id),
                            spec, moment, tables.high_water(own, dim))
        written.append(tables.publish(merged, dim, batch_id))

    _each_batch(spark, landing, schema, load, checkpoint, files_per_batch)
    _read_anew(spark, seen)
    return sum(written)
