"""Versioned dimensions: the state table, replays, histories, surrogate keys."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from layerhouse.operators import scd
from layerhouse.operators.keys import largest
from layerhouse.operators.quality import duplicate_groups, not_one_current

SPEC = scd.Scd2Spec(key=("k",), tracked=("nome",), overwrite=("price",), carried=("note",), surrogate="sk")
INCOMING = "k string, nome string, price decimal(10,2), note string"


def batch(spark, rows):
    return spark.createDataFrame([(k, n, Decimal(p), t) for k, n, p, t in rows], INCOMING)


def day(n):
    return f"2024-01-{n:02d} 00:00:00"


def state(dim):
    rows = dim.select("k", "nome", "price", "note", F.dayofmonth("valid_from").alias("f"),
                      F.dayofmonth("valid_to").alias("t"), "is_current").collect()
    return sorted(tuple(r) for r in rows)


def step(dim, incoming, n):
    """Writes nothing: rows are collected, as a table would hold them between batches."""
    spark = dim.sparkSession
    after = scd.scd2_apply(dim, incoming, SPEC, day(n), largest(dim, SPEC.surrogate))
    return spark.createDataFrame(after.collect(), after.schema)


def test_state_table(spark):
    d = Decimal
    dim = scd.scd2_initial(batch(spark, [("P1", "A", "1.00", "n1")]), SPEC, day(1))
    dim = spark.createDataFrame(dim.collect(), dim.schema)
    dim = step(dim, batch(spark, [("P1", "A", "1.50", "n2")]), 2)
    assert state(dim) == [("P1", "A", d("1.50"), "n1", 1, None, True)]
    dim = step(dim, batch(spark, [("P1", "B", "2.00", "n3")]), 3)
    third = [("P1", "A", d("1.50"), "n1", 1, 3, False), ("P1", "B", d("2.00"), "n3", 3, None, True)]
    assert state(dim) == third
    dim = step(dim, batch(spark, [("P2", "Z", "9.00", "z")]), 4)
    assert state(dim) == third + [("P2", "Z", d("9.00"), "z", 4, None, True)]
    dim = step(dim, batch(spark, [("P1", "A", "2.50", "n5")]), 5)
    fifth = [
        ("P1", "A", d("1.50"), "n1", 1, 3, False), ("P1", "A", d("2.50"), "n5", 5, None, True),
        ("P1", "B", d("2.00"), "n3", 3, 5, False), ("P2", "Z", d("9.00"), "z", 4, None, True),
    ]
    assert state(dim) == fifth
    again = step(dim, batch(spark, [("P1", "A", "2.50", "n5")]), 6)
    assert state(again) == fifth
    assert sorted(r.sk for r in again.collect()) == sorted(r.sk for r in dim.collect())
    assert duplicate_groups(again, ["sk"]).count() == 0
    assert not_one_current(again, ["k"]).count() == 0


def test_existing_keys_are_not_renumbered(spark):
    first = scd.scd2_initial(batch(spark, [(f"k{i}", "A", "1.00", "") for i in range(300)]), SPEC, day(1))
    first = spark.createDataFrame(first.collect(), first.schema)
    second = step(first, batch(spark, [(f"k{i}", "B" if i % 2 else "A", "1.00", "") for i in range(200, 400)]), 2)
    before = {r.sk: (r.k, r.nome) for r in first.collect()}
    after = {r.sk: (r.k, r.nome) for r in second.collect()}
    assert len(after) == second.count()
    assert all(after[sk] == row for sk, row in before.items())
    assert min(set(after) - set(before)) > max(before)


@pytest.mark.parametrize("rows", [[("P1", "A", "1.00", ""), ("P1", "B", "1.00", "")], [(None, "A", "1.00", "")]])
def test_bad_incoming_keys_fail(spark, rows):
    dim = scd.scd2_initial(batch(spark, [("P0", "A", "1.00", "")]), SPEC, day(1))
    with pytest.raises(PySparkException, match="business key"):
        scd.scd2_apply(dim, batch(spark, rows), SPEC, day(2)).collect()


def test_missing_hash_leaves_the_row_alone(spark):
    dim = scd.scd2_initial(batch(spark, [("P1", "A", "1.00", "n")]), SPEC, day(1))
    dim = dim.withColumn("_hash_diff", F.lit(None).cast("string"))
    after = scd.scd2_apply(dim, batch(spark, [("P1", "B", "2.00", "m")]), SPEC, day(2))
    assert state(after) == [("P1", "A", Decimal("1.00"), "n", 1, None, True)]


def test_new_versions_and_overwrite(spark):
    dim = scd.scd2_initial(batch(spark, [("P1", "A", "1.00", "n"), ("P2", "B", "1.00", "n")]), SPEC, day(1))
    incoming = batch(spark, [("P1", "A", "3.00", "x"), ("P2", "C", "3.00", "x"), ("P3", "D", "3.00", "x")])
    assert [r.k for r in scd.scd2_new_versions(dim, incoming, SPEC, day(2)).collect()] == ["P3"]
    prices = {r.k: r.price for r in scd.scd1_overwrite(dim, incoming, SPEC).collect()}
    assert prices == {"P1": Decimal("3.00"), "P2": Decimal("1.00")}


def snapshots(seed, keys, batches):
    rng = random.Random(seed)
    rows = []
    for n in range(1, batches + 1):
        for k in range(keys):
            if rng.random() < 0.7:
                rows.append((f"k{k}", rng.choice("AB"), str(rng.randint(1, 9)), f"n{n}", n))
    return rows


@pytest.mark.parametrize("chunk", [None, "c"])
def test_history_equals_batch_after_batch(spark, chunk):
    rows = snapshots(7, 30, 5)
    dim = None
    for n in range(1, 6):
        incoming = batch(spark, [r[:4] for r in rows if r[4] == n])
        if dim is None:
            dim = scd.scd2_initial(incoming, SPEC, day(n))
            dim = spark.createDataFrame(dim.collect(), dim.schema)
        else:
            dim = step(dim, incoming, n)
    log = spark.createDataFrame(
        [(k, a, Decimal(p), t, dt.datetime(2024, 1, n), n // 2) for k, a, p, t, n in rows],
        INCOMING + ", ts timestamp, c int")
    log = log.withColumn("ts", F.to_timestamp(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    built = scd.scd2_history(log, SPEC, "ts", chunk)
    assert state(built) == state(dim)


def test_history_of_one_hot_key_in_chunks(spark):
    """One key holds nearly all rows; chunked and plain windows agree, whatever the partitions."""
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.9 else f"k{i % 20}", rng.choice("AAAB"), i) for i in range(3000)]
    log = spark.createDataFrame([(k, a, Decimal(i), "", i, i // 100) for k, a, i in rows],
                                INCOMING + ", seq int, c int")
    plain = scd.scd2_history(log, SPEC, "seq")
    expected = sorted(map(tuple, plain.collect()))
    for partitions in (1, 7):
        chunked = scd.scd2_history(log.repartition(partitions), SPEC, "seq", "c")
        assert sorted(map(tuple, chunked.collect())) == expected
    assert len(expected) > 500


def test_one_current_finds_none_and_two(spark):
    dim = spark.createDataFrame([("a", True), ("a", True), ("b", False), ("c", True)], "k string, is_current boolean")
    assert sorted(map(tuple, not_one_current(dim, ["k"]).collect())) == [("a", 2), ("b", 0)]


def test_publish_drops_technical_columns(spark):
    dim = scd.scd2_initial(batch(spark, [("P1", "A", "1.00", "n")]), SPEC, day(1))
    assert scd.publish_current(dim).columns == ["sk", "k", "nome", "price", "note"]


def test_a_late_batch_fails(spark):
    dim = step(scd.scd2_initial(batch(spark, [("P1", "A", "1.00", "n")]), SPEC, day(5)), batch(spark, []), 6)
    scd.scd2_apply(dim, batch(spark, [("P1", "A", "2.00", "n")]), SPEC, day(2)).collect()  # closes nothing
    for n in (2, 5):
        with pytest.raises(PySparkException, match="not after the version"):
            scd.scd2_apply(dim, batch(spark, [("P1", "B", "1.00", "n")]), SPEC, day(n)).collect()


def test_new_versions_check_their_keys(spark):
    dim = scd.scd2_initial(batch(spark, [("P1", "A", "1.00", "n")]), SPEC, day(1))
    for rows in ([("P2", "A", "1.00", "n"), ("P2", "B", "1.00", "n")], [(None, "A", "1.00", "n")]):
        with pytest.raises(PySparkException, match="business key"):
            scd.scd2_new_versions(dim, batch(spark, rows), SPEC, day(2)).collect()


@pytest.mark.parametrize("chunk", [None, "c"])
def test_history_of_null_keys_and_chunks_and_of_doubled_batches(spark, chunk):
    spec = scd.Scd2Spec(key=("k",), tracked=("a",), overwrite=("p",))
    rows = [(None, 1, "x", 1, None), (None, 2, "y", 2, 1), (1, 1, "x", 3, None), (1, 2, "x", 4, 1), (1, 3, "z", 5, 1)]
    log = spark.createDataFrame(rows, "k int, b int, a string, p int, c int")
    found = sorted(map(tuple, scd.scd2_history(log, spec, "b", chunk).drop("_hash_diff").collect()), key=repr)
    assert found == sorted([(None, "x", 1, 1, 2, False), (None, "y", 2, 2, None, True), (1, "x", 4, 1, 3, False),
                            (1, "z", 5, 3, None, True)], key=repr)
    twice = log.unionByName(spark.createDataFrame([(1, 2, "q", 9, 1)], log.schema))
    with pytest.raises(PySparkException, match="two rows of one key and batch"):
        scd.scd2_history(twice, spec, "b", chunk).collect()


def test_apply_reads_the_current_slice_once(spark, tmp_path):
    dim = scd.scd2_initial(batch(spark, [("P1", "A", "1.00", "n"), ("P2", "A", "1.00", "n")]), SPEC, day(1))
    dim.write.parquet(str(tmp_path / "dim"))
    dim = spark.read.parquet(str(tmp_path / "dim"))
    plan = scd.scd2_apply(dim, batch(spark, [("P1", "B", "1.00", "n")]), SPEC, day(2), 7)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") - plan.count("Union") <= 1
    assert plan.count("FileScan") == 2  # the closed rows and the current ones


def test_keys_are_never_given_out_twice(spark):
    """Keys leave and new ones arrive, several times; the mark is kept like a table's."""
    from layerhouse.operators.keys import keep_keys
    owners, mark = {}, 0
    before = spark.createDataFrame([], "k long, sk long")
    for first, last in ((0, 200), (0, 150), (0, 400), (390, 600), (0, 50)):
        before = keep_keys(spark.range(first, last).select(F.col("id").alias("k")), before, ["k"], "sk", mark)
        before = spark.createDataFrame(before.collect(), before.schema)
        for r in before.collect():
            owners.setdefault(r.sk, set()).add(r.k)
            mark = max(mark, r.sk)
    assert {len(x) for x in owners.values()} == {1}
