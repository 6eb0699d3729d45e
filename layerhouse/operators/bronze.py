"""Raw layer: everything as text plus audit columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

INGESTION_TS, SOURCE_FILE, BATCH_ID = "_ingestion_ts", "_source_file", "_batch_id"
SOURCE_PREFIX = "postgres-source/"  # fixed value: the label of the source


def stringify(df: DataFrame) -> DataFrame:
    """Every column as string, names and order kept."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def with_audit_columns(df: DataFrame, table: str, batch_id: str, batch_ts: str | Column,
                       source_prefix: str = SOURCE_PREFIX) -> DataFrame:
    """Adds load time, source label and batch id; all three are parameters, so a re-run repeats them."""
    ts = F.lit(batch_ts) if isinstance(batch_ts, str) else batch_ts
    return df.withColumns({
        INGESTION_TS: ts.cast("timestamp"),
        SOURCE_FILE: F.lit(f"{source_prefix}{table}"),
        BATCH_ID: F.lit(batch_id),
    })


def to_bronze(df: DataFrame, table: str, batch_id: str, batch_ts: str | Column,
              source_prefix: str = SOURCE_PREFIX) -> DataFrame:
    return with_audit_columns(stringify(df), table, batch_id, batch_ts, source_prefix)


def batch_row_audit(bronze: DataFrame, batch: str = BATCH_ID) -> DataFrame:
    """Rows held per batch, counted from what was written."""
    return bronze.groupBy(batch).agg(F.count(F.lit(1)).alias("n_rows"))
