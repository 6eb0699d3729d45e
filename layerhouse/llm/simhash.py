"""Near-duplicate groups by SimHash with deletion-variant signatures.

A 64-bit fingerprint is cut into ``segments`` parts, few enough that of two fingerprints within the
distance one part differs by at most one bit. A part is indexed once for each of its bits with that
bit left out; equal variants meet by equality, and the whole distance is verified.

Two parts of 32 bits serve the usual distance of 3: 64 index rows for each different
fingerprint. A variant shared by more than ``hot`` fingerprints is refined by the same rule on the other
bits. Of a group that meets, only as many verified links are handed on as connect it.
"""

from __future__ import annotations

from itertools import chain, islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from layerhouse.llm.common import saved, string_bytes, text_column, whole_rows
from layerhouse.llm.components import Joined, components

BITS = 64
BLOCK = 1 << 14
PIECE_BYTES = 1 << 22
SPACES = b" \t\n\v\f\r"


def _words(text: bytes):
    """Lists of words; a long text comes in parts of some megabytes, cut at white space."""
    start = 0
    while start < len(text):
        end = min(start + PIECE_BYTES, len(text))
        while end < len(text) and text[end] not in SPACES:
            end += 1
        yield text[start:end].lower().split()
        start = end


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """SimHash of a UTF-8 text: each bit is 1 if it is set in more than half of the shingles' XXH64."""
    held: list[bytes] = []
    votes, n = np.zeros(BITS, np.int64), 0
    for words in _words(text):
        words = held + words
        held = words[max(0, len(words) - shingle + 1):]
        joined = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
        hashes = map(xxhash.xxh64_intdigest, joined, repeat(42))
        while len(block := np.fromiter(islice(hashes, BLOCK), np.uint64)):
            n += len(block)
            bits = np.unpackbits(block.view(np.uint8)).reshape(-1, BITS)
            for part in range(0, len(bits), 255):  # sums of 255 rows fit in a byte
                votes += bits[part:part + 255].sum(0, dtype=np.uint8)
    if n == 0:
        if not held:
            return 0
        return xxhash.xxh64_intdigest(b" ".join(held), 42)
    return int(np.packbits(votes * 2 > n).view(np.uint64)[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """Rows (doc_id, fp): the fingerprint as a signed long. A null or wordless text has 0."""

    def run(batches):
        for batch in batches:
            data, ends = string_bytes(batch.column(1))
            raw = data.tobytes()
            found = [fingerprint(raw[a:b], shingle) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.record_batch(
                [batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, fp long")


def _variants(part, bits: int, first: int):
    """Array of (number of the bit left out, part without it) packed into longs."""
    return [F.lit((first + b) << 32).bitwiseOR(part.bitwiseAND(F.lit(((1 << bits) - 1) & ~(1 << b)))) for b in range(bits)]


def _index(fps: DataFrame, segments: int, within: int = BITS, start: int = 0):
    """One array column: the variants of all ``segments`` parts of bits start .. start + within - 1."""
    edges = [start + within * i // segments for i in range(segments + 1)]
    keys = []
    for a, b in zip(edges[:-1], edges[1:]):
        part = F.shiftrightunsigned(fps["fp"], a).bitwiseAND(F.lit((1 << (b - a)) - 1))
        keys.append(_variants(part, b - a, a))
    return F.array(*chain.from_iterable(keys))


def _met(fps: DataFrame, distance: int, segments: int | None, hot: int) -> DataFrame:
    """Rows (key, finer, fp): the fingerprints that share a variant, those of a crowded one cut further by the rest of the bits.

    Two fingerprints within the distance meet in one of these groups at least: of floor(distance / 2) + 1 parts one
    differs in one bit at most, in the whole fingerprint and again in what is left of it. Variants are counted by an aggregate that
    is joined back, so a crowded one is not gathered in one task; by merging, as Spark would take the 64 variants of a fingerprint
    for no larger than itself and broadcast them. A cut group leaves few bits open, which bounds its size.
    """
    segments = segments or distance // 2 + 1
    if distance > 2 * segments - 1 or BITS // segments > 32:
        raise ValueError("a part could differ in more than one bit, or is too long to be packed")
    indexed = fps.select("fp", F.explode(_index(fps, segments)).alias("key"))
    shared = indexed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    met = saved(indexed.hint("merge").join(shared.hint("merge"), "key"), "variants")
    found = met.filter(F.col("n") <= hot).select("key", F.lit(0).cast("long").alias("finer"), "fp")
    crowded = met.filter(F.col("n") > hot)
    for i in range(segments):
        first, last = BITS * i // segments, BITS * (i + 1) // segments
        mine = crowded.filter((F.shiftright("key", 32) >= first) & (F.shiftright("key", 32) < last))
        others = [(BITS * j // segments, BITS * (j + 1) // segments) for j in range(segments) if j != i]
        cuts = [_index(mine, distance // 2 + 1, b - a, a) for a, b in others]
        if cuts:
            found = found.unionByName(mine.select("key", F.explode(F.concat(*cuts)).alias("finer"), "fp"))
    return found


def links(fps: DataFrame, distance: int = 3, segments: int | None = None, hot: int = 256) -> DataFrame:
    """All pairs (u, v), u > v, of different fingerprints at most ``distance`` bits apart, from rows (fp).

    ``fps`` must hold each fingerprint once. Their number grows with the square of a dense family; :func:`forest` gives
    enough of them for the groups.
    """
    met = _met(fps, distance, segments, hot)
    a, b = met.alias("a"), met.alias("b")
    near = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= distance
    same = [F.col("a.key") == F.col("b.key"), F.col("a.finer") == F.col("b.finer"), F.col("a.fp") > F.col("b.fp")]
    return a.join(b, [*same, near]).select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v")).distinct()


def _tree(group: np.ndarray, distance: int):
    """Pairs within the distance that connect all of a group that such pairs connect, fewer than its members."""
    while len(group) > 1:
        open_, group = [group[:1]], group[1:]
        while open_ and len(group):
            at = open_.pop()
            near = np.bitwise_count(group ^ at) <= distance
            if near.any():
                yield np.repeat(at, near.sum()), group[near]
                open_.extend(np.split(group[near], int(near.sum())))
                group = group[~near]


def forest(fps: DataFrame, distance: int = 3, segments: int | None = None, hot: int = 256) -> DataFrame:
    """Some of the pairs of :func:`links`, with the same connected components.

    A task gives fewer of them than it meets fingerprints (in blocks of some 16,000), so a dense
    family of copies gives a number of links in proportion to its size.
    """

    def run(batches):
        joined, held, last = Joined(), [], None

        def kept(pairs):
            """Those pairs that connect something in this task, as far as it remembers."""
            nonlocal joined
            pairs = [(u, v) for us, vs in pairs for u, v in zip(us.view(np.int64).tolist(), vs.view(np.int64).tolist()) if joined.join(u, v)]
            if len(joined.root) > BLOCK:
                joined = Joined()
            if pairs:
                yield pa.record_batch([pa.array(side, pa.int64()) for side in zip(*pairs)], names=["u", "v"])

        for batch in batches:
            key, finer = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            fp = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)
            if not len(fp):
                continue
            cuts = np.flatnonzero((key[1:] != key[:-1]) | (finer[1:] != finer[:-1])) + 1
            groups = np.split(fp, cuts)
            if held and last != (key[0], finer[0]):
                yield from kept(_tree(np.concatenate(held), distance))
                held = []
            held.append(groups[0])
            if len(groups) > 1:  # the last one may go on in the next batch
                yield from kept(_tree(np.concatenate(held), distance))
                yield from kept(pair for group in groups[1:-1] for pair in _tree(group, distance))
                held = [groups[-1]]
            last = (key[-1], finer[-1])
        if held:
            yield from kept(_tree(np.concatenate(held), distance))

    met = _met(fps, distance, segments, hot)
    return met.repartition("key", "finer").sortWithinPartitions("key", "finer", "fp").mapInArrow(run, "u long, v long")


def _rooted(docs: DataFrame, doc_id: str, text: str, shingle: int, distance: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) of every row, and (fp, root, least) of every fingerprint: its group and its smallest id."""
    marked = saved(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    fps = saved(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(forest(fps.select("fp"), distance))
    members = fps.join(roots, fps["fp"] == roots["node"], "left")
    return marked, members.select("fp", F.coalesce("root", "fp").alias("root"), "least")


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3) -> DataFrame:
    """Rows (doc_id, fingerprint, component_id), one for each row of ``docs``.

    component_id is the smallest doc_id reachable over links of at most ``distance`` bits. Null texts
    count as empty, empty texts share the fingerprint 0. Null doc_ids are kept but name no group
    (null only where a whole group has no id). Repeated rows stay repeated; an empty table gives none.
    """
    marked, members = _rooted(docs, doc_id, text, shingle, distance)
    smallest = members.groupBy("root").agg(F.min("least").alias("component_id"))
    named = members.join(smallest, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """One row of each group, with all columns: that of the smallest doc_id.

    Rows without doc_id come last; ties (rows of one id, or a group without ids) are decided by the
    fingerprint and then by the smallest text.
    """
    marked, members = _rooted(docs, "doc_id", "text", shingle, distance)
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"))
    by_fp = marked.groupBy("fp").agg(F.min(first).alias("first"))  # a large group of copies is one row from here on
    best = by_fp.join(members, "fp").groupBy("root").agg(F.min(F.struct("first", "fp")).alias("best"))
    kept = best.select(
        F.col("best.first.none").alias("_none"), F.col("best.first.id").alias("_id"), F.col("best.fp").alias("_fp"))
    # The rows are fingerprinted again rather than carried through all of the above. They meet the chosen ones on
    # id and fingerprint, which keeps apart the texts of one id; the same exchange serves the choice of one row.
    rows = _with_fingerprint(whole_rows(docs), shingle).withColumns({
        "_none": F.col("_row.doc_id").isNull(), "_id": F.coalesce(F.col("_row.doc_id").cast("long"), F.lit(0))})
    found = rows.join(kept.hint("merge"), ["_none", "_id", "_fp"], "left_semi")
    once = Window.partitionBy("_none", "_id", "_fp").orderBy(F.col("_row.text"))
    return found.withColumn("_n", F.row_number().over(once)).filter("_n = 1").select("_row.*")


def _with_fingerprint(rows: DataFrame, shingle: int) -> DataFrame:
    """Adds the fingerprint of the text in ``_row`` as ``_fp``."""
    def run(batches):
        for batch in batches:
            data, ends = string_bytes(text_column(batch))
            raw = data.tobytes()
            found = [fingerprint(raw[a:b], shingle) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.record_batch([batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], names=["_row", "_fp"])

    return rows.mapInArrow(run, StructType([rows.schema["_row"], StructField("_fp", LongType())]))
