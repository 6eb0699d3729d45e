import re

import pytest
import xxhash
from pyspark.sql import functions as F

from layerhouse.llm import simhash
from layerhouse.llm.components import components
from layerhouse.llm.queries import QUERIES
from tests.llm.conftest import SF

FOLD = str.maketrans({c: chr(c + 32) for c in range(65, 91)})


def brute(text: str | None, size: int = 3) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(rows: list) -> list:
    prints = [brute(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted(((d, f"{p:016x}", least.get(find(i))) for i, ((d, _), p) in enumerate(zip(rows, prints))), key=str)


def test_query_equals_brute_force(spark, documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    found = sorted((tuple(r) for r in QUERIES["op1_simhash"](spark, SF).select("doc_id", "fingerprint", "component_id").collect()), key=str)
    assert found == brute_groups(rows)


def test_odd_rows(odd_documents):
    rows = [tuple(r) for r in odd_documents.select("doc_id", "text").collect()]
    found = sorted((tuple(r) for r in simhash.groups(odd_documents).collect()), key=str)
    assert found == brute_groups(rows)


def test_no_rows(no_documents):
    assert simhash.groups(no_documents).count() == 0
    assert simhash.deduplicate(no_documents).count() == 0


def test_long_text_in_parts(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(5000))
    whole = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "PIECE_BYTES", 1000)
    assert simhash.fingerprint(text.encode()) == whole == brute(text)


@pytest.mark.parametrize("hot", [1, 3, 256])
def test_links_are_complete_in_a_crowded_neighbourhood(spark, hot):
    """All fingerprints within two bits of one: every variant is crowded, no link may be lost."""
    base = 0x0123456789ABCDEF
    near = [base] + [base ^ (1 << i) ^ (1 << j) for i in range(0, 64, 5) for j in range(i + 1, 64, 7)]
    signed = sorted({x - (1 << 64) if x >> 63 else x for x in near})
    fps = spark.createDataFrame([(x,) for x in signed], "fp long")
    found = {(r.u, r.v) for r in simhash.links(fps, hot=hot).collect()}
    mask = (1 << 64) - 1
    assert found == {(a, b) for a in signed for b in signed if a > b and ((a ^ b) & mask).bit_count() <= 3}


@pytest.mark.parametrize("hot", [1, 3, 256])
def test_forest_connects_what_the_links_connect(spark, hot):
    base, rows = 0x0123456789ABCDEF, set()
    for k in range(40):  # chains of two bits a step beside dense families
        step = base ^ (k * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFF0000)
        rows |= {step, step ^ 3, step ^ 15, step ^ 63, step ^ 255, step ^ (1 << 40), step ^ (7 << 50)}
    rows |= {base ^ (1 << i) ^ (1 << j) for i in range(0, 64, 3) for j in range(i + 1, 64, 5)}
    signed = sorted(x - (1 << 64) if x >> 63 else x for x in rows)
    fps = spark.createDataFrame([(x,) for x in signed], "fp long")
    found = [(r.u, r.v) for r in simhash.forest(fps, hot=hot).collect()]
    mask = (1 << 64) - 1
    assert all(1 <= ((a ^ b) & mask).bit_count() <= 3 for a, b in found)
    assert _roots(signed, found) == _roots(signed, [(a, b) for a in signed for b in signed if a > b and ((a ^ b) & mask).bit_count() <= 3])


def _roots(nodes: list, edges: list) -> dict:
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def test_links_of_a_dense_family_grow_in_proportion(spark):
    """Near copies of one text: twice the family, about twice the links."""
    def links(n):
        base = 0x0F0F12345678FFFF
        rows = sorted({base ^ (1 << (i % 64)) ^ (1 << (i * 7 % 61)) ^ (1 << (i * 13 % 59)) for i in range(n)})
        fps = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in rows], "fp long")
        return simhash.forest(fps).distinct().count() / len(rows)

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert links(6000) < tasks and links(1500) < tasks


def test_deduplicate_keeps_the_smallest_id_of_each_group(odd_documents):
    kept = simhash.deduplicate(odd_documents)
    assert kept.columns == odd_documents.columns
    rows = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    texts = {r.text for r in odd_documents.select("text").collect()}
    assert (1, "The quick brown fox jumps over the lazy dog near the old river bank.") in rows
    assert (1, "another text of the same id") in rows
    assert [d for d, t in rows if not (t or "").split()] == [2]  # null, empty and blank texts are one group
    assert sum(1 for d, _ in rows if d is None) == 1
    assert len(rows) == len({brute(t) for t in texts})


def test_components_of_long_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(100, 200)]
    hub = [(1000, 1000 + i) for i in range(1, 60)]
    edges = spark.createDataFrame([*chain, *hub, (5, 5), (7, 7)], "u long, v long").unionByName(
        spark.createDataFrame([(None, 3)], "u long, v long"))
    found = {r.node: r.root for r in components(edges).collect()}
    assert found == {**{i: 100 for i in range(100, 201)}, **{1000 + i: 1000 for i in range(60)}}


def test_plan_has_no_product(spark, documents):
    fps = simhash.fingerprints(documents).select("fp").distinct()
    plan = simhash.links(fps)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert documents.select(F.count("*")).first()[0] == 200


def test_deduplicate_of_one_id_with_many_texts_makes_no_pairs(spark):
    """A third of the rows has no id, another third one id: each joins its own text only."""
    docs = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit(7)).otherwise(F.col("id")).cast("long").alias("doc_id"),
        F.concat_ws(" ", *[F.md5(F.concat(F.col("id").cast("string"), F.lit(str(i)))) for i in range(9)]).alias("text"))
    docs = docs.unionByName(docs)
    kept = simhash.deduplicate(docs)
    assert kept.count() == 900 and kept.distinct().count() == 900
    plan = kept._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_no_task_needs_two_python_workers(spark, documents, monkeypatch):
    """The forest and the first contraction are both Python operators: they run in tasks of their own."""
    plans, written = [], components.__globals__["_written"]

    def seen(edges):
        plans.append(edges._jdf.queryExecution().optimizedPlan().toString())
        return written(edges)

    monkeypatch.setitem(components.__globals__, "_written", seen)
    assert simhash.groups(documents).count() == documents.count()
    assert plans and plans[0].count("MapInArrow") == 1
