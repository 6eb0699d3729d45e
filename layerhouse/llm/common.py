"""Shared helpers: intermediate tables in the shared folder, Arrow columns as numpy arrays."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import layerhouse
from layerhouse.session import work_dir

_SHIPPED: set[str] = set()


BATCH_BYTES = "8m"


def ready(spark: SparkSession) -> None:
    """Bounds what a Python worker gets at once, and sends it this package's sources, once per application.

    The bound is a setting of the caller's session, and stays: batches of 8 MB instead of 64. The workers need
    not share the driver's folders; where the package comes from an archive (``--py-files``) Spark has sent it already.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    context, root = spark.sparkContext, Path(layerhouse.__file__).parent
    if context.applicationId in _SHIPPED or not root.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="layerhouse-")) / "layerhouse.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """Writes ``df`` below the shared folder and returns the table read back: cuts the lineage.

    Lost executors cost nothing afterwards. Zstandard keeps the copy small.
    """
    path = work_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def quoted(name: str) -> str:
    """A column name as an expression, whatever signs it holds."""
    return "`" + name.replace("`", "``") + "`"


def whole_rows(docs: DataFrame, name: str = "_row") -> DataFrame:
    """One column with the whole rows as structs; ``select(f"{name}.*")`` gives the columns back."""
    return docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias(name))


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all strings of a column and the offsets between them; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    whole = np.frombuffer(data, np.uint8)
    return whole[ends[0]:ends[-1]], ends - ends[0]


def text_column(batch: pa.RecordBatch) -> pa.Array:
    """The column ``text``, or the field of that name of whole rows that travel in the first column."""
    return batch.column("text") if "text" in batch.schema.names else batch.column(0).field("text")


def slices(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Cuts a row of items into runs of at most ``most`` bytes (one larger item is a run of its own)."""
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and held + size > most:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
