"""Best-fit packing of token sequences by exact-complement hashing.

Only the number of pieces of each length matters for the plan, and lengths are bounded by the sequence.
The plan takes the longest length that is left and looks up what fills its gap exactly: one length,
two, or three, by the sums they have; a combination is used as often as its lengths are available.
What no combination completes goes best-fit, the longest that fits first. The plan is a short list of
slots; each piece finds its own by its length and its number among the pieces of that length.

Pairs and triples use up short pieces that best-fit may need to fill other gaps, so the plan is made with
combinations of up to three, two and one lengths, and the one with the fewest sequences is taken.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layerhouse.llm import tokenizer
from layerhouse.llm.common import saved

ROWS = 1024


def _pair(left: np.ndarray, gap: int) -> tuple[int, int] | None:
    """Two available lengths with the sum ``gap``, the larger as large as possible."""
    low = np.arange(1, gap // 2 + 1)
    fits = (left[low] > 0) & (left[gap - low] > 0)
    if gap % 2 == 0 and gap and left[gap // 2] < 2:
        fits[gap // 2 - 1] = False
    found = np.flatnonzero(fits)
    return (gap - int(low[found[0]]), int(low[found[0]])) if len(found) else None


def _complement(left: np.ndarray, gap: int, most: int) -> tuple[int, ...] | None:
    """One to ``most`` (three) available lengths that fill ``gap`` exactly."""
    if left[gap]:
        return (gap,)
    if most > 1 and (pair := _pair(left, gap)):
        return pair
    for a in () if most < 3 else range(gap - 2, gap // 3 - 1, -1):
        if a > 0 and left[a]:
            left[a] -= 1
            pair = _pair(left, gap - a)
            left[a] += 1
            if pair:
                return (a, *pair)
    return None


def plan(counts: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how often) such that every piece is placed once and none exceeds ``size``."""
    return min((_plan(counts, size, most) for most in (3, 2, 1)), key=lambda made: sum(times for _, times in made))


def _plan(counts: dict[int, int], size: int, most: int) -> list[tuple[tuple[int, ...], int]]:
    left = np.zeros(size + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    out: list[tuple[tuple[int, ...], int]] = []

    def take(lengths: tuple[int, ...]) -> None:
        need = {x: lengths.count(x) for x in lengths}
        times = min(int(left[x]) // n for x, n in need.items())
        for x, n in need.items():
            left[x] -= n * times
        out.append((lengths, times))

    if left[size]:
        take((size,))
    for length in range(size - 1, 0, -1):
        while left[length]:
            left[length] -= 1
            found = _complement(left, size - length, most)
            left[length] += 1
            if found is None:
                break
            take((length, *found))
    while len(rest := np.flatnonzero(left)):
        lengths, gap = [int(rest[-1])], size - int(rest[-1])
        left[lengths[0]] -= 1
        while gap and len(fits := np.flatnonzero(left[:gap + 1])):
            lengths.append(int(fits[-1]))
            left[fits[-1]] -= 1
            gap -= int(fits[-1])
        for x in lengths:
            left[x] += 1
        take(tuple(lengths))
    return out


def slots(chosen: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By length: first piece number of each slot, its first sequence, its place in the sequence."""
    taken: dict[int, int] = {}
    made: dict[int, list] = {}
    first = 0
    for lengths, times in chosen:
        place = 0
        for x in lengths:
            made.setdefault(x, []).append((taken.get(x, 0), first, place))
            taken[x] = taken.get(x, 0) + times
            place += x
        first += times
    return {x: tuple(np.array(c, np.int64) for c in zip(*rows)) for x, rows in made.items()}


_PIECES = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()), ("ids_crc32", pa.int64()),
    ("task", pa.int32()), ("rank", pa.int64())])


def cut(docs: DataFrame, size: int, path: str, end: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, task, rank): the pieces, numbered by length within a task."""

    def run(batches):
        encoder, seen = tokenizer.load(path), np.zeros(size + 1, np.int64)
        task = TaskContext.get().partitionId()
        for batch in (b.slice(a, ROWS) for b in batches for a in range(0, b.num_rows, ROWS)):
            ids, n = encoder.encode(batch.column(1))
            stops = np.cumsum(n)
            total = n + 1
            head = (total - 1) % size + 1
            pieces = (total - head) // size + 1
            doc = np.repeat(np.arange(len(n)), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = np.where(piece > 0, head[doc] + (piece - 1) * size, 0)
            length = np.where(piece > 0, size, head[doc])
            stop = start + length == total[doc]
            at = (stops - n)[doc] + start
            raw, tail = ids.astype("<u4"), np.array([end], "<u4").tobytes()
            crc = [zlib.crc32(tail, c) if last else c for c, last in zip(
                (zlib.crc32(raw[a:a + k]) for a, k in zip(at.tolist(), (length - stop).tolist())), stop.tolist())]
            order = np.argsort(length, kind="stable")
            ranked = length[order]
            within = np.arange(len(ranked)) - np.searchsorted(ranked, ranked)
            rank = np.empty(len(ranked), np.int64)
            rank[order] = within + seen[ranked]
            seen += np.bincount(length, minlength=size + 1)
            yield pa.record_batch([
                batch.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length, pa.int32()),
                pa.array(crc, pa.int64()), pa.array(np.full(len(doc), task), pa.int32()), pa.array(rank)], schema=_PIECES)

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return source.mapInArrow(
        run, "doc_id long, piece int, start long, length int, ids_crc32 long, task int, rank long")


def _place(chosen) -> Callable:
    def run(batches):
        table = chosen.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("number").to_numpy()
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for x in np.unique(length).tolist():
                mine = np.flatnonzero(length == x)
                first, start, place = table[x]
                slot = np.searchsorted(first, number[mine], side="right") - 1
                sequence[mine] = start[slot] + number[mine] - first[slot]
                offset[mine] = place[slot]
            yield pa.record_batch(
                [*(batch.column(i) for i in range(5)), pa.array(sequence), pa.array(offset)],
                names=[*batch.schema.names[:5], "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, size: int = 1024, end: int = 2, path: str | None = None,
         doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, sequence_id, offset), one for each piece.

    A document is its ids and the id ``end``; one longer than ``size`` is cut, with the shorter piece first.
    Null and empty texts are one piece of length 1. Null doc_ids and repeated rows are packed like all others; an
    empty table gives no rows. The plan has one entry for each combination, at most some times ``size``,
    whatever the number of documents; it is all that is sent to the tasks.
    """
    pieces = saved(cut(docs, size, path or tokenizer.vocabulary_path(), end, doc_id, text), "pieces")
    held = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = held.withColumn("before", F.sum("n").over(
        Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)))
    counts = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= size rows
    chosen = docs.sparkSession.sparkContext.broadcast(slots(plan(counts, size)))
    numbered = pieces.join(before.select("task", "length", "before"), ["task", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.coalesce("before", F.lit(0))).alias("number"))
    return numbered.mapInArrow(
        _place(chosen), "doc_id long, piece int, start long, length int, ids_crc32 long, sequence_id long, offset long").select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset")
