"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of ``size`` words of the benchmark items (a shorter item is one pattern). For
each pattern length there is one searcher. It looks at the block of words that ends at the present
position: the shift table says how far the search may jump, a block that ends some pattern leads
to a bucket of patterns by suffix, and the words of each are compared directly.

The benchmark is read in blocks of bounded size; each block is sent to the tasks and all documents are
searched for it. One block needs neither a shuffle nor a table. For several, the rows are written once with a number for each,
each block leaves only the rows that it hits, and their intervals are merged by row number.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterable
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from layerhouse.llm.common import saved, string_bytes, text_column, whole_rows, work_dir

#: Bytes that separate words; A-Z becomes a-z. Every byte of a character beyond ASCII belongs to a word.
FOLD = bytes(
    (c + 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isascii() and chr(c).isalnum() else 32 for c in range(256))
HITS = "row_id long, hits array<struct<start:long,stop:long>>, items array<string>"
RESULT = "n_words long, n_hit long, items array<string>, contaminated boolean"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class Searcher:
    """Wu-Manber search for patterns of one length, in words."""

    def __init__(self, length: int, patterns: dict[tuple[bytes, ...], list[int]]):
        self.length = length
        self.block = min(2, length)
        self.jump = length - self.block + 1
        self.shift: dict = {}
        self.buckets: dict = defaultdict(list)
        for words, owners in patterns.items():
            for end in range(self.block, length + 1):
                key = words[end - self.block:end] if self.block > 1 else words[end - 1]
                self.shift[key] = min(self.shift.get(key, self.jump), length - end)
            self.buckets[key].append((list(words), owners))

    def find(self, words: list[bytes]):
        """Yields (start, owners) of every occurrence, in order."""
        length, shift, buckets, jump = self.length, self.shift, self.buckets, self.jump
        at, n, pairs = length - 1, len(words), self.block > 1
        while at < n:
            key = (words[at - 1], words[at]) if pairs else words[at]
            step = shift.get(key, jump)
            if step:
                at += step
                continue
            start = at - length + 1
            for pattern, owners in buckets[key]:
                if words[start] == pattern[0] and words[start:at + 1] == pattern:
                    yield start, owners
            at += 1


def searchers(items: list[tuple[str | None, bytes]], size: int) -> tuple[list[Searcher], list[str]]:
    by_length: dict[int, dict] = defaultdict(lambda: defaultdict(list))
    names = [name for name, _ in items]
    for number, (_, text) in enumerate(items):
        words = words_of(text)
        length = min(size, len(words))
        for start in range(len(words) - length + 1 if length else 0):
            owners = by_length[length][tuple(words[start:start + length])]
            if not owners or owners[-1] != number:
                owners.append(number)
    return [Searcher(length, dict(p)) for length, p in sorted(by_length.items())], names


def search(words: list[bytes], tables: list[Searcher]) -> tuple[list[list[int]], set[int]]:
    """Disjoint intervals of hit words in order, and the numbers of the items that occur."""
    spans, found = [], set()
    for table in tables:
        last: list[int] | None = None
        for start, owners in table.find(words):
            found.update(owners)
            if last and start <= last[1]:
                last[1] = start + table.length
            else:
                spans.append(last := [start, start + table.length])
    return merged(spans), found


def merged(spans: list) -> list[list[int]]:
    out: list[list[int]] = []
    for start, stop in sorted(map(list, spans)):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return out


def blocks(benchmark: DataFrame, block_bytes: int, item_id: str = "item_id", text: str = "text"):
    """Lists of (item name, text), each of ``block_bytes`` of text at most or of one item.

    The items are dealt by running size inside hash groups, so no single task orders them all; a
    block is collected by its number. Items without text are left out; one without id hits, but has no name.
    """
    sized = benchmark.select(
        F.col(item_id).cast("string").alias("item"), F.col(text).alias("text")).filter("text is not null").distinct()
    total = sized.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    lanes = max(1, -(-2 * total // block_bytes))
    if lanes == 1:
        if total:
            yield [(r[0], r[1].encode()) for r in sized.collect()]
        return
    lane = F.pmod(F.xxhash64("item", "text"), F.lit(lanes))
    running = F.sum(F.octet_length("text")).over(Window.partitionBy("lane").orderBy("text", "item"))
    dealt = saved(sized.withColumn("lane", lane).withColumn("part", F.floor((running - 1) / block_bytes)), "benchmark")
    for row in dealt.select("lane", "part").distinct().toLocalIterator():
        mine = dealt.filter((F.col("lane") == row["lane"]) & (F.col("part") == row["part"]))
        yield [(r[0], r[1].encode()) for r in mine.collect()]


def occurrences(docs: DataFrame, benchmark: DataFrame, size: int = 13, doc_id: str = "doc_id", text: str | None = "text",
                block_bytes: int = 16 << 20) -> DataFrame:
    """Rows (doc_id, n_words, n_hit, items, contaminated), one for each row of ``docs``.

    A word is hit if it lies inside an occurrence of a window. ``items`` holds the names of the items that
    occur, sorted as strings. contaminated: at least one word in twenty is hit. A null text has no
    words; items without words have no window; an empty benchmark hits nothing. The rows keep
    their repetitions, and doc_id may be null and of any type. Without ``text`` the text is a field of doc_id,
    which then holds the whole row.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), *([F.col(text).alias("text")] if text else []))
    first, others = list_first(blocks(benchmark, block_bytes)) or ([], iter(()))
    second = list_first(others)
    if second:
        return _by_blocks(rows, chain([first, second[0]], second[1]), size, block_bytes)
    sent = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, first))
    return rows.mapInArrow(_judged(sent, size), StructType([rows.schema["doc_id"], *StructType.fromDDL(RESULT).fields]))


def list_first(iterator):
    """(first element, iterator over the rest), or None."""
    for first in iterator:
        return first, iterator
    return None


def _by_blocks(rows: DataFrame, several: Iterable, size: int, most: int) -> DataFrame:
    """The rows of :func:`occurrences` for more than one block of the benchmark, one after the other in the workers' memory.

    Rows are named by their place in the written table, as documents may have no id or share one. What the
    blocks found is sent to all tasks up to ``most`` bytes, as measured, and joined by merging beyond that.
    """
    spark = rows.sparkSession
    counted = rows.mapInArrow(_counted, StructType([*rows.schema.fields, StructField("n_words", LongType())]))
    rows = saved(counted.withColumn("row_id", F.monotonically_increasing_id()), "decontamination")
    text = rows["text"] if "text" in rows.columns else rows["doc_id"].getField("text")
    texts, path = rows.select("row_id", text.alias("text")), work_dir(spark, "hits")
    for block in several:
        sent = spark.sparkContext.broadcast((uuid.uuid4().hex, block))
        texts.mapInArrow(_hits(sent, size), HITS).write.mode("append").option("compression", "zstd").parquet(path)
        sent.destroy()
    found = spark.read.schema(HITS).parquet(path).groupBy("row_id").agg(
        _covered(F.flatten(F.collect_list("hits"))).alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    seen = Observation()
    found = saved(found.observe(seen, F.sum(F.lit(64) + F.octet_length(F.concat_ws(" " * 16, "items"))).alias("bytes")), "hit-rows")
    how = "broadcast" if (seen.get["bytes"] or 0) <= most else "merge"
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return rows.select("row_id", "doc_id", "n_words").join(found.hint(how), "row_id", "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"))


def _covered(spans: Column) -> Column:
    """How many words an array of intervals covers, overlaps counted once."""
    none = F.lit(0).cast("long")

    def add(so_far, span):
        new = F.greatest(none, span["stop"] - F.greatest(so_far["stop"], span["start"]))
        return F.struct((so_far["n"] + new).alias("n"), F.greatest(so_far["stop"], span["stop"]).alias("stop"))

    return F.aggregate(F.array_sort(spans), F.struct(none.alias("n"), none.alias("stop")), add, lambda state: state["n"])


_TABLES: dict = {}


def _tables(block, size: int):
    """Searchers and item names of a block, made once for each worker."""
    name, items = block.value
    if _TABLES.get("name") != name:
        _TABLES.update(name=name, made=searchers(items, size))
    return _TABLES["made"]


def _words(column: pa.Array):
    data, ends = string_bytes(column)
    raw = data.tobytes()
    return (words_of(raw[a:b]) for a, b in zip(ends[:-1], ends[1:]))


def _judged(block, size: int):
    """The result rows by one block that is the whole benchmark."""

    def run(batches):
        tables, names = _tables(block, size)
        for batch in batches:
            n_words, n_hit, items = [], [], []
            for words in _words(text_column(batch)):
                spans, found = search(words, tables)
                n_words.append(len(words))
                n_hit.append(sum(stop - start for start, stop in spans))
                items.append(sorted({names[i] for i in found if names[i] is not None}))
            contaminated = [h > 0 and 20 * h >= n for h, n in zip(n_hit, n_words)]
            yield pa.record_batch([
                batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                pa.array(items, pa.list_(pa.string())), pa.array(contaminated, pa.bool_())],
                names=["doc_id", "n_words", "n_hit", "items", "contaminated"])

    return run


def _counted(batches):
    """Adds the number of words."""
    for batch in batches:
        n_words = [len(words) for words in _words(text_column(batch))]
        yield pa.record_batch([*batch.columns, pa.array(n_words, pa.int64())], names=[*batch.schema.names, "n_words"])


def _hits(block, size: int):
    """(row_id, intervals, items) of the rows that hold a pattern of the block."""
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches):
        tables, names = _tables(block, size)
        for batch in batches:
            hit = []
            for row, words in zip(batch.column(0).to_pylist(), _words(batch.column(1))):
                spans, found = search(words, tables)
                if spans:
                    hit.append((row, [{"start": a, "stop": b} for a, b in spans], [names[i] for i in found if names[i] is not None]))
            yield pa.record_batch([
                pa.array([h[0] for h in hit], pa.int64()), pa.array([h[1] for h in hit], spans_type),
                pa.array([h[2] for h in hit], pa.list_(pa.string()))], names=["row_id", "hits", "items"])

    return run


def clean(docs: DataFrame, benchmark: DataFrame, size: int = 13, block_bytes: int = 16 << 20) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    judged = occurrences(whole_rows(docs), benchmark, size, doc_id="_row", text=None, block_bytes=block_bytes)
    return judged.filter(~F.col("contaminated")).select("doc_id.*")
