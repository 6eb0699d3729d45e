"""Prefix trie of conversations, rolled up by centroid decomposition.

Conversations that start with the same turns share the nodes of those turns. A node is named by the smallest
conversation that passes through it and its depth; nodes of one conversation's name form a vertical chain, and a
table of paths says which node a naming conversation passes at each depth.

Subtree totals come from a centroid decomposition. A node weighs its conversations, so the weight of a whole subtree is a
plain sum over the turns of its conversations. In every round each component is split at its centroid, the lowest
node that holds half of its weight: the total below the centroid is added to the nodes between the centroid and the
component's top, and the parts go on alone. A part of at most ``local`` weight is finished inside a task by the same
decomposition; larger ones are split by joins over their nodes, in a number of rounds that grows with the logarithm
of the weight, whatever the depth of the trie.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from layerhouse.llm.common import saved

CHUNK = 4096
LANES = ("s0", "s1", "s2", "s3")
PIECE = 1 << 20
ROWS = 1 << 14


def _digests(batches):
    for batch in batches:
        first, second, words = [], [], []
        for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist()):
            role, text = role.encode(), text.encode()
            mark = hashlib.blake2b(len(role).to_bytes(8, "little") + role + text, digest_size=16).digest()
            first.append(int.from_bytes(mark[:8], "little", signed=True))
            second.append(int.from_bytes(mark[8:], "little", signed=True))
            words.append(len(text.split()))
        yield pa.record_batch(
            [batch.column("conv_id"), batch.column("turn"), batch.column("role"), pa.array(first, pa.int64()),
             pa.array(second, pa.int64()), pa.array(words, pa.int64())],
            names=["conv_id", "turn", "role", "d1", "d2", "words"])


def digested(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, d1, d2, words): 128 bits stand for role and text, null counting as empty."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.filter("conv_id is not null").mapInArrow(
        _digests, "conv_id long, turn long, role string, d1 long, d2 long, words long")


def _local_ranks(batches):
    """Ranks of the rows of a conversation inside one sorted partition, and at its end one row (no digest) with
    the first and the last conversation and how many rows the last one has here."""
    part, first, last, held = TaskContext.get().partitionId(), None, None, 0
    names = ["conv_id", "rank", "part", "d1", "d2", "words", "first"]
    for batch in batches:
        conv = batch.column("conv_id").to_numpy(zero_copy_only=False)
        if not len(conv):
            continue
        first = int(conv[0]) if first is None else first
        starts = np.flatnonzero(np.append(True, conv[1:] != conv[:-1]))
        rank = np.arange(len(conv)) - np.repeat(starts, np.diff(np.append(starts, len(conv))))
        if last == conv[0]:
            until = starts[1] if len(starts) > 1 else len(conv)
            rank[:until] += held
        last, held = int(conv[-1]), int(rank[-1]) + 1
        yield pa.record_batch(
            [batch.column("conv_id"), pa.array(rank, pa.int64()), pa.array(np.full(len(conv), part), pa.int64()),
             batch.column("d1"), batch.column("d2"), batch.column("words"), pa.nulls(len(conv), pa.int64())], names=names)
    if last is not None:
        none = pa.nulls(1, pa.int64())
        yield pa.record_batch(
            [pa.array([last]), pa.array([held]), pa.array([part]), none, none, none, pa.array([first])], names=names)


def ranked(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, rank, d1, d2, words): rank 0, 1, ... by turn (null first), then by role, then by digest.

    The rows are sorted in range partitions, so a conversation may span many tasks. The driver holds three
    numbers of each partition to say how many rows of its first conversation lie in earlier ones.
    """
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("d1"), F.col("d2")]
    local = saved(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
            _local_ranks, "conv_id long, rank long, part long, d1 long, d2 long, words long, first long"), "turns")
    before, last, held = [], None, 0
    for end in sorted(local.filter("first is not null").select("part", "first", "conv_id", "rank").collect()):
        carried = held if end.first == last else 0
        if carried:
            before.append((end.part, end.first, carried))
        held = end.rank + (carried if end.conv_id == end.first else 0)
        last = end.conv_id
    found = local.filter("first is null")
    if before:
        spark = rows.sparkSession
        known = spark.createDataFrame(before, "part long, conv_id long, carried long")
        found = found.join(known, ["part", "conv_id"], "left").withColumn("rank", F.col("rank") + F.coalesce("carried", F.lit(0)))
    return found.select("conv_id", "rank", "d1", "d2", "words")


def rebuilt(turns: DataFrame, block: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns (conv_id, depth from 1, n, d1, d2, words) and lengths (conv_id, n).

    Conversation c takes the first h = crc32(c) mod ``most`` turns of conversation c - c mod ``block`` (all, if
    that has fewer; none, if there is no such one) and then its own turns after its first h.
    """
    own = turns.groupBy("conv_id").agg(F.count("*").alias("own"))
    lent = own.select(F.col("conv_id").alias("base"), F.col("own").alias("lent"))
    base = F.col("conv_id") - F.pmod("conv_id", F.lit(block))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    lengths = own.withColumns({"base": base, "h": h}).join(lent, "base", "left")
    lengths = lengths.withColumn("k", F.least("h", F.coalesce("lent", F.lit(0)))).select(
        "conv_id", "base", "h", "k", (F.col("k") + F.greatest(F.lit(0), F.col("own") - F.col("h"))).alias("n"))
    lengths = saved(lengths, "lengths")
    after = turns.withColumn("h", h).filter("rank >= h").drop("h").join(lengths.select("conv_id", "h", "k", "n"), "conv_id")
    after = after.select("conv_id", (F.col("rank") - F.col("h") + F.col("k") + 1).alias("depth"), "n", "d1", "d2", "words")
    heads = turns.filter((F.pmod("conv_id", F.lit(block)) == 0) & (F.col("rank") < most - 1)).withColumnRenamed("conv_id", "base")
    heads = lengths.filter("k > 0").join(heads, "base").filter("rank < k").select(
        "conv_id", (F.col("rank") + 1).alias("depth"), "n", "d1", "d2", "words")
    return after.unionByName(heads), lengths.select("conv_id", "n")


def _keyed(turns: DataFrame) -> DataFrame:
    """Adds the sums s0 .. s3 over the turns so far, which name the sequence, and ``upper``, those before.

    Each turn's depth and digest give four numbers of 32 bits, so the sums have 128 bits of chance. A long
    conversation is summed in chunks of turns, its chunks by their totals.
    """
    a, b = F.xxhash64("depth", "d1", "d2"), F.xxhash64("d2", "depth", "d1", F.lit(7))
    low = F.lit((1 << 32) - 1)
    parts = dict(zip(LANES, (a.bitwiseAND(low), F.shiftrightunsigned(a, 32), b.bitwiseAND(low), F.shiftrightunsigned(b, 32))))
    rows = turns.withColumns({**parts, "chunk": F.floor((F.col("depth") - 1) / CHUNK)})
    so_far = Window.partitionBy("conv_id", "chunk").orderBy("depth")
    inner = rows.withColumns({f"t{i}": F.sum(lane).over(so_far) for i, lane in enumerate(LANES)})
    totals = rows.filter(F.col("n") > CHUNK).groupBy("conv_id", "chunk").agg(*[F.sum(lane).alias(lane) for lane in LANES])
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("conv_id", "chunk", *[F.sum(lane).over(earlier).alias(f"u{i}") for i, lane in enumerate(LANES)])
    joined = inner.join(totals, ["conv_id", "chunk"], "left")
    ends = [F.col(f"t{i}") + F.coalesce(f"u{i}", F.lit(0)) for i in range(4)]
    return joined.select(
        "conv_id", "depth", "n", "words", *[end.alias(lane) for lane, end in zip(LANES, ends)],
        F.struct(*[(end - F.col(lane)).alias(lane) for lane, end in zip(LANES, ends)]).alias("upper"))


def _nodes(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row per node: name (m, d), parent's name, conversations, weight of the subtree, children, own saving."""
    below = rows.groupBy("depth", *LANES).agg(
        F.min("conv_id").alias("m"), F.count("*").alias("n_convs"), F.sum(F.col("n") - F.col("depth") + 1).alias("w"),
        F.max("words").alias("words"), F.min("upper").alias("upper"))
    below = saved(below, "nodes")
    root = lengths.agg(F.min("conv_id").alias("m"), F.count("*").alias("n_convs"), F.sum(F.col("n") + 1).alias("w")).filter(
        "m is not null")
    top = root.select("m").scalar()
    inner = below.filter("depth > 1")
    named = below.select(F.col("m").alias("pm"), (F.col("depth") + 1).alias("depth"), *[F.col(x).alias(f"p{x}") for x in LANES])
    linked = inner.join(named, [inner["depth"] == named["depth"], *[F.col(f"upper.{x}") == F.col(f"p{x}") for x in LANES]])
    plain = [F.col("n_convs"), F.col("w"), ((F.col("n_convs") - 1) * F.col("words")).alias("own"), *[F.col(x) for x in LANES]]
    nodes = linked.select("m", inner["depth"].alias("d"), "pm", *plain).unionByName(
        below.filter("depth = 1").select("m", F.col("depth").alias("d"), top.alias("pm"), *plain)).unionByName(
        root.select("m", F.lit(0).cast("long").alias("d"), F.lit(None).cast("long").alias("pm"), "n_convs", "w",
                    F.lit(0).cast("long").alias("own"), *[F.lit(0).cast("long").alias(x) for x in LANES]))
    nodes = saved(nodes, "named")
    children = nodes.filter("d > 0").groupBy(F.col("pm").alias("m"), (F.col("d") - 1).alias("d")).agg(F.count("*").alias("n_children"))
    return nodes.join(children, ["m", "d"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))


STATE = ["m", "d", "pm", "n_convs", "n_children", "w", "own", "cm", "cd", "total", "leaves_up", "saved_up"]


def _split(big: DataFrame, paths: DataFrame) -> DataFrame:
    """One round: every component is split at its centroid. Centroids come back with ``total`` 0, finished."""
    at = saved(big.filter(F.col("w") * 2 >= F.col("total")).groupBy("cm", "cd").agg(
        F.min_by(F.struct("m", "d", "w"), "w").alias("v")).select(
        "cm", "cd", F.col("v.m").alias("vm"), F.col("v.d").alias("vd"), F.col("v.w").alias("vw")), "centroids")
    beside = big.join(at, ["cm", "cd"])
    # The chains below a centroid, named by the child they hang from.
    step = paths.select(F.col("conv_id").alias("m"), (F.col("t") - 1).alias("vd"), F.col("rep").alias("child"), "above")
    chains = beside.filter("d > vd").select("cm", "cd", "m", "vm", "vd").distinct().join(step, ["m", "vd"]).filter(
        "above = vm").select("cm", "cd", "m", "child")
    marked = saved(
        beside.join(chains, ["cm", "cd", "m"], "left").withColumns({
            "is_v": (F.col("m") == F.col("vm")) & (F.col("d") == F.col("vd")),
            "child": F.when(F.col("d") > F.col("vd"), F.col("child"))}), "marked")
    totals = marked.filter("is_v or child is not null").groupBy("cm", "cd").agg(
        F.sum((F.col("n_children") == 0).cast("long")).alias("leaves"), F.sum("own").alias("saving"))
    walked = at.join(paths.withColumnRenamed("conv_id", "vm"), "vm").filter("t >= cd and t < vd").select(
        "cm", "cd", F.col("rep").alias("m"), F.col("t").alias("d"))
    walked = walked.unionByName(at.filter("cd = 0 and vd > 0").select("cm", "cd", F.col("cm").alias("m"), F.col("cd").alias("d")))
    found = marked.join(walked.withColumn("on_path", F.lit(True)), ["cm", "cd", "m", "d"], "left").join(totals, ["cm", "cd"])
    gets = F.col("is_v") | F.col("on_path").isNotNull()
    apart = F.col("child").isNotNull()
    moved = found.select(
        "m", "d", "pm", "n_convs", "n_children", "own", "is_v",
        (F.col("w") - F.when(F.col("on_path"), F.col("vw")).otherwise(0)).alias("w"),
        F.when(apart, F.col("child")).otherwise(F.col("cm")).alias("cm"),
        F.when(apart, F.col("vd") + 1).otherwise(F.col("cd")).alias("cd"),
        (F.col("leaves_up") + F.when(gets, F.col("leaves")).otherwise(0)).alias("leaves_up"),
        (F.col("saved_up") + F.when(gets, F.col("saving")).otherwise(0)).alias("saved_up"))
    moved = saved(moved, "moved")
    sizes = moved.filter("not is_v").groupBy("cm", "cd").agg(F.max("w").alias("total"))
    parts = moved.filter("not is_v").join(sizes, ["cm", "cd"]).select(*STATE)
    return saved(parts.unionByName(moved.filter("is_v").withColumn("total", F.lit(0).cast("long")).select(*STATE)), "parts")


def decompose(parent: list[int], values: list[tuple[int, int]]) -> list[list[int]]:
    """Subtree sums of one tree by centroid decomposition; parents stand before their children, the top has -1."""
    n = len(parent)
    sums = [[0, 0] for _ in range(n)]
    label = [0] * n
    todo = [list(range(n))]
    size = [0] * n
    while todo:
        nodes = todo.pop()
        if len(nodes) == 1:
            x = nodes[0]
            sums[x][0] += values[x][0]
            sums[x][1] += values[x][1]
            continue
        top, here = nodes[0], label[nodes[0]]
        for x in nodes:
            size[x] = 1
        for x in reversed(nodes):
            if x != top:
                size[parent[x]] += size[x]
        half = len(nodes)
        v = next(x for x in reversed(nodes) if 2 * size[x] >= half)  # the lowest ones stand last
        parts, upper, a, b = {}, [], 0, 0
        label[v] = -1 - v
        for x in nodes:
            if x != top and x != v:
                p = parent[x]
                if p == v:
                    label[x] = n + x
                    parts[n + x] = []
                elif label[p] != here:
                    label[x] = label[p]
            if label[x] == here:
                upper.append(x)
            else:
                a += values[x][0]
                b += values[x][1]
                if x != v:
                    parts[label[x]].append(x)
        x = v
        while True:
            sums[x][0] += a
            sums[x][1] += b
            if x == top:
                break
            x = parent[x]
        todo.extend(parts.values())
        if upper:
            todo.append(upper)
    return sums


def _finished(rows: list[tuple]):
    """Adds the sums inside a component to what its nodes have got from centroids below them."""
    place = {(m, d): i for i, (m, d, *_) in enumerate(rows)}
    parent = [place.get((r[2], r[1] - 1), -1) if i else -1 for i, r in enumerate(rows)]
    for r, (leaves, saving) in zip(rows, decompose(parent, [(int(r[4] == 0), r[5]) for r in rows])):
        yield r[0], r[1], r[2], r[3], r[4], r[8] + leaves, r[9] + saving


_OUT = pa.schema([(c, pa.int64()) for c in ("m", "d", "pm", "n_convs", "n_children", "n_leaves", "saved_tokens")])


def _components(batches):
    """Sorted components one after the other; one of them is held at a time."""
    held, name, out = [], None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[6:8] != name:
                out.extend(_finished(held) if held else ())
                held, name = [], row[6:8]
                if len(out) >= ROWS:
                    yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out)], schema=_OUT)
                    out = []
            held.append(row)
    out.extend(_finished(held) if held else ())
    if out:
        yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out)], schema=_OUT)


def rolled_up(nodes: DataFrame, rows: DataFrame, local: int) -> DataFrame:
    """Adds n_leaves and saved_tokens of the subtree to every node."""
    top = nodes.filter("d = 0").select("m", "w")
    state = nodes.select(
        "m", "d", "pm", "n_convs", "n_children", "w", "own", top.select("m").scalar().alias("cm"), F.lit(0).cast("long").alias("cd"),
        top.select("w").scalar().alias("total"), F.lit(0).cast("long").alias("leaves_up"), F.lit(0).cast("long").alias("saved_up"))
    state, paths = saved(state, "parts"), None
    done, small = [], [state.filter(F.col("total") <= local)]
    while not (big := state.filter(F.col("total") > local)).isEmpty():
        if paths is None:
            names = nodes.select("m").distinct()
            walks = rows.join(names, rows["conv_id"] == names["m"], "left_semi").select("conv_id", F.col("depth").alias("d"), *LANES)
            paths = saved(walks.join(nodes.filter("d > 0").select("m", "d", "pm", *LANES), ["d", *LANES]).select(
                "conv_id", F.col("d").alias("t"), F.col("m").alias("rep"), F.col("pm").alias("above")), "paths")
        state = _split(big, paths)
        done.append(state.filter("total = 0"))
        small.append(state.filter((F.col("total") > 0) & (F.col("total") <= local)))
    rest = small[0]
    for part in small[1:]:
        rest = rest.unionByName(part)
    rest = rest.select("m", "d", "pm", "n_convs", "n_children", "own", "cm", "cd", "leaves_up", "saved_up")
    found = rest.repartition("cm", "cd").sortWithinPartitions("cm", "cd", "d", "m").mapInArrow(
        _components, ", ".join(f"{f.name} long" for f in _OUT))
    for part in done:
        found = found.unionByName(part.select(
            "m", "d", "pm", "n_convs", "n_children", F.col("leaves_up").alias("n_leaves"), F.col("saved_up").alias("saved_tokens")))
    return found


def _joined_ids(batches):
    """SHA-256 of the ids of each node; of the nodes at the ends of a partition, whose ids may go on in another, the text."""
    names = ["m", "d", "part", "piece", "sha", "ids"]
    part, out, first, last, ids = TaskContext.get().partitionId(), [], None, None, []

    def pieces():
        for k in range(0, len(ids), PIECE // 16):
            yield (*last, part, k, None, ",".join(map(str, ids[k:k + PIECE // 16])))

    def flush(end: bool):
        if last is not None and (end or last == first):
            out.extend(pieces())
        elif last is not None:
            out.append((*last, part, 0, hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), None))

    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    for batch in batches:
        for m, d, conv in zip(*(c.to_pylist() for c in batch.columns)):
            if (m, d) != last:
                flush(False)
                last, ids = (m, d), []
                first = first or last
            ids.append(conv)
        if out:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
            out.clear()
    flush(True)
    if out:
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)


def _whole_ids(batches):
    """The same for nodes whose ids come in pieces, in order; only the state of the hash is held."""
    names, last, state = ["m", "d", "sha"], None, None

    def ended():
        return pa.record_batch([pa.array([last[0]]), pa.array([last[1]]), pa.array([state.hexdigest()])], names=names)

    for batch in batches:
        for m, d, ids in zip(*(batch.column(c).to_pylist() for c in ("m", "d", "ids"))):
            if (m, d) != last:
                if last:
                    yield ended()
                last, state = (m, d), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
    if last:
        yield ended()


def _ends(rows: DataFrame, lengths: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows (m, d, sha): of the ids of the conversations that end at a node, ascending."""
    at = rows.filter("depth = n").select("conv_id", F.col("depth").alias("d"), *LANES)
    at = at.join(nodes.select("m", "d", *LANES), ["d", *LANES]).select("m", "d", "conv_id")
    at = at.unionByName(lengths.filter("n = 0").select(
        nodes.filter("d = 0").select("m").scalar().alias("m"), F.lit(0).cast("long").alias("d"), "conv_id"))
    at = saved(at, "ends")
    parts = saved(at.repartitionByRange("m", "d", "conv_id").sortWithinPartitions("m", "d", "conv_id").mapInArrow(
        _joined_ids, "m long, d long, part long, piece long, sha string, ids string"), "ids")
    cut = parts.filter("sha is null").select("m", "d", "part", "piece", "ids").repartition("m", "d").sortWithinPartitions(
        "m", "d", "part", "piece").mapInArrow(_whole_ids, "m long, d long, sha string")
    return parts.filter("sha is not null").select("m", "d", "sha").unionByName(cut)


def trie(conversations: DataFrame, block: int = 20, most: int = 4, local: int = 1 << 14) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations (see :func:`rebuilt`).

    Columns: conv_id (smallest member) and depth name the node, parent_conv_id its parent (null for the root);
    n_convs, n_children; n_leaves and saved_tokens of its subtree (words of repeated turns that need not be read again);
    ends_sha256 over the ids of the conversations that end there. ``most`` = 1 leaves the conversations as they are.

    A null turn comes first, rows of one turn are ordered by role and digest, repeated rows stay repeated turns. A null
    role or text counts as empty. Rows without conv_id belong to no conversation. No rows, no nodes.
    """
    turns, lengths = rebuilt(ranked(saved(digested(conversations), "digests")), block, most)
    rows = saved(_keyed(turns), "rows")
    nodes = saved(_nodes(rows, lengths), "trie")
    found = rolled_up(nodes, rows, local).join(_ends(rows, lengths, nodes), ["m", "d"], "left")
    return found.select(
        F.col("m").alias("conv_id"), F.col("d").alias("depth"), F.col("pm").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
