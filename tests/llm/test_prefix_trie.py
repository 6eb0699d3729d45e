import hashlib
import random
import re
import zlib

import pytest

from layerhouse.llm import prefix_trie
from layerhouse.llm.queries import QUERIES
from tests.llm.conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows: list, block: int = 20, most: int = 4) -> list:
    """Rows (conv_id, turn, role, text), unambiguous in their order."""
    own = {}
    for c, turn, role, text in sorted(
            (r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "")):
        own.setdefault(c, []).append((role or "", text or ""))
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most
        built[c] = own.get(c - c % block, [])[:h] + turns[h:]
    nodes = {}
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            nodes.setdefault(tuple(built[c][:d]), []).append(c)
    children, leaves, saving = {}, {}, {}
    for key in nodes:
        if key:
            children[key[:-1]] = children.get(key[:-1], 0) + 1
    for key in sorted(nodes, key=len, reverse=True):
        if key not in children:
            leaves[key] = 1
        words = len(WORD.findall(key[-1][1])) if key else 0
        saving[key] = saving.get(key, 0) + (len(nodes[key]) - 1) * words
        if key:
            leaves[key[:-1]] = leaves.get(key[:-1], 0) + leaves[key]
            saving[key[:-1]] = saving.get(key[:-1], 0) + saving[key]
    return sorted((
        min(cs), len(k), min(nodes[k[:-1]]) if k else None, len(cs), children.get(k, 0), leaves[k], saving[k],
        hashlib.sha256(",".join(str(c) for c in cs if len(built[c]) == len(k)).encode()).hexdigest()) for k, cs in nodes.items())


def found(frame) -> list:
    return sorted(tuple(r) for r in frame.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect())


def drawn(seed: int, n: int = 240) -> list:
    """Few texts, so that many conversations share turns; a long one, exact copies, turnless ones after rebuilding."""
    draw = random.Random(seed)
    rows = []
    for c in range(-25, n):
        if draw.random() < 0.1:
            continue
        for turn in range(draw.choice([1, 1, 2, 3, 5, 9])):
            rows.append((c, turn, draw.choice(["user", "assistant"]), draw.choice(["a b", "a b c", "d\te", "", "ä ö"])))
    rows += [(1000 + c, t, "user", f"same {t}") for c in range(60) for t in range(4)]
    rows += [(5000, t, "user", f"turn {t % 7}") for t in range(700)]
    return rows


@pytest.mark.parametrize("local", [1, 40, 1 << 14])
def test_equals_brute_force(spark, local):
    rows = drawn(3)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    assert found(prefix_trie.trie(frame, local=local)) == brute(rows)


def test_one_conversation_over_many_partitions_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 16)
    rows = [(c, t, "user", f"turn {t}" if t < 150 + c else "x") for c in (40, 41, 42) for t in range(300)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    assert found(prefix_trie.trie(frame, local=50)) == brute(rows)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(QUERIES["op13_prefix_trie"](spark, SF)) == brute(rows)


def test_odd_rows(spark):
    long = "word " * 100_000
    rows = [(1, None, "user", "first"), (1, 0, None, None), (1, 1, "user", long), (None, 0, "user", "nobody's"), (2, None, None, None),
            (3, 1, "user", ""), (3, 1, "user", ""), (3, 5, "b", "tie"), (3, 5, "a", "tie"), (20, 2, "user", " \n "), (21, 0, "user", "q")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "'clash' as depth", "1 as m", "2 as `a.b`", "3 as rank")
    assert found(prefix_trie.trie(frame)) == brute(rows)


def test_no_rows(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.trie(none).count() == 0
    nameless = spark.createDataFrame([(None, 1, "user", "x")], "conv_id long, turn long, role string, text string")
    assert prefix_trie.trie(nameless).count() == 0


def test_decompose_of_paths_stars_and_random_trees():
    draw = random.Random(5)
    for n in (1, 2, 3, 50, 400):
        for kind in ("path", "star", "random"):
            parent = [-1] + [{"path": i, "star": 0, "random": draw.randrange(i + 1)}[kind] for i in range(n - 1)]
            order = sorted(range(n), key=lambda i: _depth(parent, i))
            new = {old: i for i, old in enumerate(order)}
            parent = [-1 if parent[o] < 0 else new[parent[o]] for o in order]
            values = [(draw.randrange(3), draw.randrange(9)) for _ in range(n)]
            sums = [list(v) for v in values]
            for i in reversed(range(1, n)):
                for k in (0, 1):
                    sums[parent[i]][k] += sums[i][k]
            assert prefix_trie.decompose(parent, values) == sums


def _depth(parent: list, i: int) -> int:
    d = 0
    while parent[i] >= 0:
        i, d = parent[i], d + 1
    return d


def test_plan_has_no_product(spark):
    frame = spark.read.parquet(f"{SF}/conversations.parquet")
    plan = prefix_trie.trie(frame)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
