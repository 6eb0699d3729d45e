"""Name to query, and name to SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from layerhouse.session import adapt
from layerhouse.sources import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Registers a query under its function name (or ``name``), with the equivalent SQL."""

    def register(build):
        key = name or build.__name__
        QUERIES[key] = build
        if sql:
            SQL[key] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return adapt(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_schema(spark: SparkSession) -> str:
    """A schema for the tables that a query writes. They stay, as the returned rows are read from them."""
    name = f"query_{uuid.uuid4().hex[:12]}"
    tables.create_schemas(spark, [name])
    return name
