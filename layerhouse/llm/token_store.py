"""Token ids of documents in Huffman-coded files, in ascending doc_id.

Files in the order of their names, and the blocks in them, follow each other; a block also names the place of its first id.

A file holds rows, one for each block of whole documents: their ids and lengths, the coded token ids and the
checkpoints. Blocks are independent; with the code's lengths, which lie beside them, each can be read alone.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerhouse.llm import tokenizer
from layerhouse.llm.common import saved
from layerhouse.llm.huffman import Code, code_lengths
from layerhouse.llm.neighbours import ordered
from layerhouse.session import work_dir

BLOCK_IDS = 1 << 16
READ_IDS = 1 << 20
_RAW = pa.schema([
    ("part", pa.int32()), ("seq", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())),
    ("inside", pa.int64()), ("n", pa.int64()), ("ids", pa.binary()), ("counts", pa.binary())])
_BLOCK = pa.schema([
    ("part", pa.int32()), ("seq", pa.int64()), ("first", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
    ("n_tokens", pa.list_(pa.int64())), ("bits", pa.binary()), ("checkpoints", pa.binary())])


def _width(size: int):
    return np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")


def _tokenized(path: str, end: int):
    """Blocks of raw ids in order, then one row with how often this task saw each id."""

    def run(batches):
        encoder, part, seq = tokenizer.load(path), TaskContext.get().partitionId(), 0
        kind = _width(max(encoder.size, end + 1))
        counts = np.zeros(max(encoder.size, end + 1), np.int64)
        docs, sizes, held, n_held, inside = [], [], [], 0, 0

        def block():
            ids = np.concatenate(held)
            np.add(counts, np.bincount(ids, minlength=len(counts)), out=counts)
            return pa.record_batch([[part], [seq], [docs], [sizes], [inside], [n_held], [ids.astype(kind).tobytes()], [None]], schema=_RAW)

        tail = np.array([end], np.uint32)
        for batch in batches:
            names = batch.column(0).to_pylist()
            for a in range(0, len(names), 256):
                ids, n = encoder.encode(batch.column(1).slice(a, 256))
                cuts = np.cumsum(n)[:-1]
                for name, own in zip(names[a:a + 256], np.split(ids, cuts)):
                    docs.append(name)
                    sizes.append(len(own) + 1)
                    held += [own, tail]
                    n_held += sizes[-1]
                    if n_held >= BLOCK_IDS:
                        yield block()
                        docs, sizes, held, n_held, inside, seq = [], [], [], 0, inside + n_held, seq + 1
        if docs:
            yield block()
        if seq or docs:
            yield pa.record_batch([[part], [-1], [None], [None], [inside + n_held], [0], [None], [counts.astype("<i8").tobytes()]], schema=_RAW)

    return run


def _counted(batches):
    total = None
    for batch in batches:
        for raw in batch.column(0).to_pylist():
            counts = np.frombuffer(raw, "<i8")
            total = counts.copy() if total is None else total + counts
    if total is not None:
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["id", "n"])


_CODES: dict = {}


def _code(lengths) -> Code:
    """The worker's tables for the broadcast (name, lengths)."""
    name, values = lengths.value
    if _CODES.get("name") != name:
        _CODES.update(name=name, code=Code(values))
    return _CODES["code"]


def _coded(lengths, base: dict[int, int], width: str):
    def run(batches):
        code = _code(lengths)
        for batch in batches:
            for row in batch.to_pylist():
                bits, marks = code.encode(np.frombuffer(row["ids"], width).astype(np.int64))
                yield pa.record_batch([
                    [row["part"]], [row["seq"]], [base[row["part"]] + row["inside"]], [row["doc_ids"]], [row["n_tokens"]], [bits], [marks]], schema=_BLOCK)

    return run


def write(docs: DataFrame, path: str, vocabulary: str | None = None, end: int = 0,
          doc_id: str = "doc_id", text: str = "text") -> None:
    """Writes ``path``/blocks and ``path``/lengths.

    Texts are tokenized once, in their final order, into an intermediate table; the counts of all ids give the
    code, and the blocks are coded from that table. The driver holds a number for each vocabulary entry.
    """
    spark = docs.sparkSession
    vocabulary = vocabulary or tokenizer.vocabulary_path()
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    raw = saved(ordered(source, F.col("doc_id").asc_nulls_first(), ties="text").mapInArrow(
        _tokenized(vocabulary, end),
        "part int, seq long, doc_ids array<long>, n_tokens array<long>, inside long, n long, ids binary, counts binary"), "ids")
    seen = raw.filter("seq < 0").select("counts").mapInArrow(_counted, "id long, n long").groupBy("id").agg(
        F.sum("n").alias("n")).collect()
    size = max(tokenizer.load(vocabulary).size, end + 1)
    counts = np.zeros(size, np.int64)
    counts[[r["id"] for r in seen]] = [r["n"] for r in seen]
    lengths = code_lengths(counts)
    spark.createDataFrame([(int(size), lengths.tobytes())], "size long, lengths binary").coalesce(1).write.parquet(f"{path}/lengths")
    total, base = 0, {}
    for row in sorted(raw.filter("seq < 0").select("part", "inside").collect()):  # one row for each partition
        base[row["part"]], total = total, total + row["inside"]
    sent = spark.sparkContext.broadcast((path, lengths))
    coded = raw.filter("seq >= 0").select("part", "seq", "inside", "doc_ids", "n_tokens", "ids").mapInArrow(
        _coded(sent, base, _width(size).str),
        "part int, seq long, first long, doc_ids array<long>, n_tokens array<long>, bits binary, checkpoints binary")
    # A block's place says which file it belongs to, so the coded blocks are dealt to files in order, without a sample.
    files = max(1, len(base))
    coded.repartitionById(files, F.floor(F.col("first") * files / max(1, total)).cast("int")).sortWithinPartitions("first").write.option(
        "compression", "none").parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids), or with ``digest`` ids_crc32 in place of ids."""
    row = spark.read.parquet(f"{path}/lengths").first()
    sent = spark.sparkContext.broadcast((path, np.frombuffer(row["lengths"], np.uint8)))

    def run(batches):
        code = _code(sent)
        for batch in batches:
            rows = batch.to_pylist()
            while rows:  # as many blocks at once as hold about READ_IDS ids
                some, n = [], 0
                while rows and (not some or n < READ_IDS):
                    some.append(rows.pop(0))
                    n += sum(some[-1]["n_tokens"])
                found = code.decode([(r["bits"], r["checkpoints"], sum(r["n_tokens"])) for r in some])
                for r, ids in zip(some, found):
                    sizes = np.array(r["n_tokens"], np.int64)
                    stops = np.cumsum(sizes)
                    raw = ids.astype("<u4")
                    own = [raw[a:b] for a, b in zip((stops - sizes).tolist(), stops.tolist())]
                    last = pa.array([zlib.crc32(x) for x in own], pa.int64()) if digest else pa.array(
                        [x.tolist() for x in own], pa.list_(pa.int64()))
                    yield pa.record_batch([
                        pa.array(r["doc_ids"], pa.int64()), pa.array(stops - sizes + r["first"]), pa.array(sizes), last],
                        names=["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"])

    kind = "ids_crc32 long" if digest else "ids array<long>"
    return spark.read.parquet(f"{path}/blocks").select("first", "doc_ids", "n_tokens", "bits", "checkpoints").mapInArrow(
        run, f"doc_id long, start long, n_tokens long, {kind}")


def stored(docs: DataFrame, vocabulary: str | None = None, end: int = 0) -> DataFrame:
    """Writes the store below the shared folder and reads a digest of each document back.

    Null and empty texts have the end id alone. Null doc_ids come first, rows of one id in the order of
    their text's hash. An empty table gives an empty store and no rows.
    """
    path = work_dir(docs.sparkSession, "tokens")
    write(docs, path, vocabulary, end)
    return read(docs.sparkSession, path, digest=True)
