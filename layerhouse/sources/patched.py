"""Catalogue tables that are replaced part by part.

The table is a view over one whole version and the patches written after it. A patch is a table of its own with the parts it
replaces, and the view reads every part from the newest one that holds it; so a commit writes the
changed parts alone, leaves all other files as they are, and is shown by one switch of the view. A lost job leaves
files that no view reads. Parts are the values of a partition column: the day of a fact, the hash bucket of a dimension.

Rows that only ever arrive (closed versions of a dimension) go to parts of their own, one for each commit, and are
never written again. After ``most`` patches the next commit writes a whole version.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from layerhouse.contracts import Contract, conform
from layerhouse.operators import scd
from layerhouse.sources import tables

PART = "_part"
MOST = 50


def _layers(spark: SparkSession, contract: Contract) -> list[dict]:
    """What the view reads, oldest first: {"table", "parts"}; parts is null for the whole version."""
    found = tables.view_property(spark, contract, "layers")
    return json.loads(found) if found else []


def exists(spark: SparkSession, contract: Contract) -> bool:
    return bool(_layers(spark, contract))


def with_parts(spark: SparkSession, contract: Contract) -> DataFrame:
    """The table with its part as ``_part``; a filter on it reaches the folders of each layer."""
    layers, found, later = _layers(spark, contract), None, set()
    for layer in reversed(layers):
        rows = spark.table(layer["table"])
        if layer["parts"] is not None:
            rows = rows.filter(F.col(PART).isin([p for p in layer["parts"] if p not in later]))
        elif later:
            rows = rows.filter(~F.col(PART).isin(sorted(later)))
        later |= set(layer["parts"] or ())
        found = rows if found is None else found.unionByName(rows)
    return found


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _show(spark: SparkSession, contract: Contract, layers: list[dict], mark: int) -> None:
    columns = ", ".join(f"`{c}`" for c in contract.columns)
    selects, later = [], set()
    for layer in reversed(layers):
        wanted = sorted(set(layer["parts"] or ()) - later)
        if layer["parts"] is None:
            where = f" WHERE {PART} NOT IN ({', '.join(map(_text, sorted(later)))})" if later else ""
            selects.append(f"SELECT {columns} FROM {layer['table']}{where}")
        elif wanted:
            selects.append(f"SELECT {columns} FROM {layer['table']} WHERE {PART} IN ({', '.join(map(_text, wanted))})")
        later |= set(layer["parts"] or ())
    shown = _text(json.dumps(layers))
    spark.sql(f"CREATE OR REPLACE VIEW {contract.name} TBLPROPERTIES ('layers' = {shown}, 'high_water' = '{mark}') "
              f"AS {' UNION ALL '.join(selects)}")


def commit(df: DataFrame, contract: Contract, part: Column, version: str, parts: Sequence[str] | None = None,
           most: int = MOST) -> int:
    """Shows ``df`` as the content of the given parts, or of the whole table; rows written.

    ``parts`` are the values of ``part`` that are replaced, also those that get no row any more. The rows
    that stay are not read, unless more than ``most`` patches make it time for a whole version. Required columns are checked
    as in ``tables.publish``: a NULL in one of them leaves the table as it is.
    """
    tables.plain_name(version)
    spark = df.sparkSession
    layers = _layers(spark, contract)
    if parts is not None and not layers:
        raise ValueError(f"{contract.name} has no whole version yet")
    if parts is not None and not parts:
        return 0
    rows = conform(df, contract).withColumn(PART, part.cast("string"))
    if parts is not None and len(layers) > most:
        rest = with_parts(spark, contract).filter(~F.col(PART).isin(list(parts)))
        rows, parts = rows.unionByName(rest.select(*rows.columns)), None
    target = f"{contract.name}__{'patch' if parts is not None else 'whole'}_{version}_{uuid.uuid4().hex[:8]}"
    counted, seen = tables.observed(rows.hint("rebalance", F.col(PART)), contract)
    counted.write.mode("errorifexists").format("parquet").partitionBy(PART).saveAsTable(target)
    found = seen.get
    nulls = {c: found[f"_null_{i}"] for i, c in enumerate(contract.required) if found[f"_null_{i}"]}
    if nulls:
        raise tables.Rejected(contract, nulls, target)
    mark = max(tables.high_water(spark, contract), found["_largest"] or 0) if contract.surrogate else 0
    layer = {"table": target, "parts": None if parts is None else sorted(parts)}
    _show(spark, contract, [layer] if parts is None else [*layers, layer], mark)
    return found["n_rows"]


def drop_unread(spark: SparkSession, contract: Contract) -> list[str]:
    """Drops the tables of lost jobs and those that a whole version has replaced."""
    held = {layer["table"] for layer in _layers(spark, contract)}
    schema, name = contract.name.split(".")
    old = [t for t in (f"{schema}.{t}" for t in tables.list_tables(spark, schema)
                       if t.startswith((f"{name}__patch_", f"{name}__whole_"))) if t not in held]
    for table in old:
        spark.sql(f"DROP TABLE {table}")
    return old


# A dimension by hash bucket, its closed versions apart.

def bucket(key: Sequence[str], buckets: int) -> Column:
    return F.concat(F.lit("c"), F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("string"))


def apply_to_dimension(spark: SparkSession, contract: Contract, incoming: DataFrame, spec: scd.Scd2Spec, batch_ts: str,
                       version: str, buckets: int = 64) -> int:
    """One batch as ``scd.scd2_apply``, written in proportion to what it changes; rows written.

    The incoming rows meet the current ones of all buckets; a bucket in which a version opens or an overwrite
    value differs is written anew, its current rows only. The versions that the batch closes are appended as a part of their
    own. Closed versions of earlier batches are not read. Without any change nothing is written.
    """
    of_key = bucket(spec.key, buckets)
    closed = f"h_{version}_{uuid.uuid4().hex[:8]}"  # never the name of an earlier commit's part
    part = F.when(F.col(scd.IS_CURRENT), of_key).otherwise(F.lit(closed))
    if not exists(spark, contract):
        return commit(scd.scd2_initial(incoming, spec, batch_ts), contract, part, version)
    incoming = incoming.select(*spec.key, *spec.attributes)
    current = with_parts(spark, contract).filter(F.col(PART).startswith("c"))
    touched = sorted(r[0] for r in _touched(current, incoming, spec, of_key).collect())  # at most ``buckets`` names
    if not touched:
        return 0
    mine = with_parts(spark, contract).filter(F.col(PART).isin(touched)).drop(PART)
    after = scd.scd2_apply(mine, incoming.filter(of_key.isin(touched)), spec, batch_ts, tables.high_water(spark, contract))
    return commit(after, contract, part, version, [*touched, closed])


def _touched(current: DataFrame, incoming: DataFrame, spec: scd.Scd2Spec, of_key: Column) -> DataFrame:
    """Buckets in which a key is new, or a tracked or overwrite value differs."""
    values = F.struct(scd.HASH, *spec.overwrite)
    arriving = scd.require_unique(scd.with_hash(incoming, spec), spec.key)
    new = arriving.select(*spec.key, values.alias("_new"))
    old = current.select(*spec.key, values.alias("_old"))
    differs = F.col("_old").isNull() | ~F.col("_old").eqNullSafe(F.col("_new"))
    return new.join(old, list(spec.key), "left").filter(differs).select(of_key.alias("bucket")).distinct()
