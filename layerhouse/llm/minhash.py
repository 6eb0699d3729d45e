"""Document fingerprints by one-permutation MinHash with optimal densification and b-bit packing.

Each word shingle is hashed once. The high bits of the hash choose a bin, the smallest hash of a bin is its
value. An empty bin takes the value of the first full bin in a random order of its own, the same
for every document, mixed with the empty bin's number, so that copies of one value do not all share its low byte. The low
byte of each value is stored; two different values share it by chance once in 256, which the likeness is corrected for.
"""

from __future__ import annotations

import hashlib
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerhouse.llm.common import saved
from layerhouse.llm.neighbours import beside, ordered

BINS = 256
CHANCE = 1 / 256
SHINGLE = 5
PIECE_CHARS = 1 << 22
ROWS = 512


@cache
def _probe_rank() -> np.ndarray:
    """[i, j]: how late an empty bin i asks bin j. Random orders, which is what random probing visits."""
    draw = np.random.default_rng(7)
    return np.argsort(np.argsort(draw.random((BINS, BINS)), axis=1), axis=1).astype(np.uint16)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(text: bytes):
    """Arrays of the words' hashes; long texts come in parts cut at white space."""
    start = 0
    while start < len(text):
        end = min(start + PIECE_CHARS, len(text))
        while end < len(text) and text[end] not in b" \t\n\v\f\r":
            end += 1
        yield np.fromiter(map(xxhash.xxh64_intdigest, text[start:end].lower().split()), np.uint64)
        start = end


def _least(hashes: np.ndarray) -> np.ndarray:
    """The smallest hash of each bin that has one, in the order of the bins."""
    hashes = np.sort(hashes)
    bins = (hashes >> np.uint64(56)).astype(np.int64)
    return hashes[np.flatnonzero(np.diff(bins, prepend=-1))]


def fingerprint(text: bytes) -> bytes:
    """One byte for each bin; empty for a text without words. Fewer than five words make one shingle."""
    least, held = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    multipliers = [np.uint64(pow(0x9E3779B97F4A7C15, i, 2**64)) for i in range(SHINGLE)]
    for words in _word_hashes(text):
        words = np.concatenate([held, words])
        held = words[max(0, len(words) - SHINGLE + 1):]
        n = len(words) - SHINGLE + 1
        if n > 0:
            mixed = sum((words[i:n + i] * m for i, m in enumerate(multipliers)), np.zeros(n, np.uint64))
            least = _least(np.concatenate([least, _mixed(mixed)]))
    if not len(least):
        if not len(held):
            return b""
        mixed = (held * np.array(multipliers[:len(held)])).sum(keepdims=True) + np.uint64(len(held))
        least = _mixed(mixed)
    full = (least >> np.uint64(56)).astype(np.int64)
    values = np.zeros(BINS, np.uint8)
    low = (least & np.uint64(255)).astype(np.uint8)
    values[full] = low
    if len(full) < BINS:
        empty = np.ones(BINS, bool)
        empty[full] = False
        empty = np.flatnonzero(empty)
        lent = least[_probe_rank()[np.ix_(empty, full)].argmin(axis=1)]
        values[empty] = (_mixed(lent + empty.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) & np.uint64(255)).astype(np.uint8)
    return values.tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """Estimated share of common shingles, from 0 to 1; equal fingerprints give 1."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    same = np.count_nonzero(np.frombuffer(a, np.uint8) == np.frombuffer(b, np.uint8)) / BINS
    return max(0.0, (same - CHANCE) / (1 - CHANCE))


FIELDS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, "
          "near_edited double, near_next double")
_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.binary()),
    ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ("part", pa.int32()), ("edge", pa.int32()), ("text", pa.string())])


def _judged(doc_id, text: str, own: bytes, following: str, near: bytes, part=None) -> tuple:
    cut = len(text) // 3
    edited = (text[:len(text) - cut] + following[:cut]).encode()
    changed = fingerprint(edited)
    return (doc_id, len(text), hashlib.sha256(edited).hexdigest(), own, changed, likeness(own, changed),
            likeness(own, near), part, 0, None)


def _batched(rows):
    held = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), _SCHEMA)], schema=_SCHEMA)
            held = []
    if held:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), _SCHEMA)], schema=_SCHEMA)


def _partition(batches):
    """Finished rows, and at the ends of the partition its first text (edge 1) and its last row (edge 2)."""

    def rows():
        part, last = TaskContext.get().partitionId(), None
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                own = fingerprint(text.encode())
                if last is None:
                    yield (None, None, None, own, None, None, None, part, 1, text)
                else:
                    yield _judged(*last, text, own)
                last = (doc_id, text, own)
        if last:
            yield (last[0], None, None, last[2], None, None, None, part, 2, last[1])

    return _batched(rows())


def _ends(batches):
    for batch in batches:
        yield from _batched(
            _judged(r["doc_id"], r["text"], r["fingerprint"], r["next_text"], r["next_fingerprint"]) for r in batch.to_pylist())


def edited_likeness(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    Each text is compared with itself after an edit, whose last third comes from the start of the next
    document in descending doc_id, and with that document. The last document is followed by the first, a
    single one by itself. Null texts count as empty; null doc_ids come last; rows of one id are
    ordered by a hash of the text. Texts without words have an empty fingerprint: equal to each other, unlike all else.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    extra = ", part int, edge int, text string"
    done = saved(ordered(docs, F.col("doc_id").desc_nulls_last(), ties="text").mapInArrow(_partition, FIELDS + extra), "minhash")
    first = done.filter("edge = 1").select(
        F.col("part").alias("after"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_fingerprint"))
    links = beside(done.filter("edge = 1").select("part"))
    least = links.agg(F.min("part").alias("least"))
    links = links.join(least).select("part", F.coalesce("after", "least").alias("after"))
    ends = done.filter("edge = 2").join(links, "part").join(first, "after").select(
        "doc_id", "text", "fingerprint", "next_text", "next_fingerprint")
    ends = ends.mapInArrow(_ends, FIELDS + extra)
    columns = [f.split()[0] for f in FIELDS.split(", ")]
    return done.filter("edge = 0").select(*columns).unionByName(ends.select(*columns))
