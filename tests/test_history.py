"""As-of joins, late batches, patched tables, mergeable distinct counts, NULL and repeated keys, quarantine."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from layerhouse import contracts as c
from layerhouse.contracts import Contract
from layerhouse.functions import random_values as rv
from layerhouse.operators import as_of, cdf, distinct, gold, keys, quality, scd, synthetic
from layerhouse.plans import generate, warehouse
from layerhouse.sources import landing, layout, patched, tables
from layerhouse.streaming.incremental import follow_history
from test_skew import low_thresholds

DAY = dt.datetime(2024, 1, 1)


def day(n):
    return None if n is None else DAY + dt.timedelta(days=n)


@pytest.mark.parametrize("chunk", [as_of.by_month, lambda at: F.lit(1), lambda at: F.unix_date(at.cast("date"))])
def test_with_version_equals_an_interval_search(spark, chunk):
    draw = random.Random(3)
    versions = []
    for key in ["a", "b", "c", "d"]:
        at = draw.randrange(20)
        for v in range(draw.randrange(1, 6)):
            end = at + draw.randrange(1, 40)
            gap = draw.choice([0, 0, 7])
            versions.append((key, day(at), day(end) if v < 4 else None, f"{key}{v}"))
            at = end + gap
    versions += [("a", day(-50), day(-50), "empty"), (None, day(0), None, "nobody"), ("b", None, None, "never")]
    rows = [(i, draw.choice(["a", "b", "c", "d", "e", None]), draw.choice([None, *map(day, range(-60, 250))])) for i in range(400)]
    frame = spark.createDataFrame(rows, "id int, k string, at timestamp").withColumn("name", F.lit("clash"))
    held = spark.createDataFrame(versions, "k string, valid_from timestamp, valid_to timestamp, name string")
    found = {r.id: r._version and r._version.name for r in as_of.with_version(frame, held, ["k"], "at", ["name"], chunk).collect()}
    want = {}
    for i, k, at in rows:
        fits = [n for key, a, b, n in versions if key == k and None not in (k, at, a) and a <= at and (b is None or at < b)]
        assert len(fits) <= 1
        want[i] = fits[0] if fits else None
    assert found == want and {None, "a0"} <= set(want.values())


def test_a_hot_key_is_spread_over_its_chunks(spark):
    """One key has a third of the rows; no task of the window gets more than a month of them."""
    rows = spark.range(0, 30000, 1, 8).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500 + 1).alias("k"),
        F.expr("timestamp'2020-01-01' + make_dt_interval(cast(id % 1440 as int))").alias("at"))
    versions = spark.range(501).select(
        F.col("id").alias("k"), F.lit("2020-06-01").cast("timestamp").alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"), F.col("id").alias("sk"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "48")
    try:
        with low_thresholds(spark):
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            found = as_of.with_version(rows, versions, ["k"], "at", ["sk"]).withColumn("task", F.spark_partition_id())
            sizes = [r["count"] for r in found.filter("k = 0").groupBy("task").count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 10000 and len(sizes) > 12 and max(sizes) < 3000
    assert found.filter("_version.sk = k").count() == found.filter("at >= timestamp'2020-06-01'").count()


def test_fact_as_of_keeps_old_days_when_versions_come(spark):
    lines = spark.createDataFrame([(1, "p", "s", 1, "1.10"), (2, "p", "s", 2, "2.20")],
                                  "order_id int, cod_prodotto string, pos_id string, quantita int, importo_riga string").withColumn(
        "importo_riga", F.col("importo_riga").cast("decimal(10,2)"))
    orders = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 2, 1))], "order_id int, data_ordine date")
    stores = spark.createDataFrame([("s", 9, DAY, None)], "pos_id string, sk_punto_vendita int, valid_from timestamp, valid_to timestamp")
    products = lambda *rows: spark.createDataFrame(rows, "cod_prodotto string, sk_prodotto int, valid_from timestamp, valid_to timestamp")
    one = gold.daily_sales_fact_as_of(lines, orders, products(("p", 1, DAY, None)), stores)
    two = gold.daily_sales_fact_as_of(lines, orders, products(("p", 1, DAY, day(20)), ("p", 2, day(20), None)), stores)
    assert sorted((r.sk_data, r.sk_prodotto) for r in one.collect()) == [(20240101, 1), (20240201, 1)]
    assert sorted((r.sk_data, r.sk_prodotto) for r in two.collect()) == [(20240101, 1), (20240201, 2)]


SPEC = scd.Scd2Spec(key=("k",), tracked=("t",), overwrite=("o",), carried=("c",), surrogate="sk")
LOG = "k string, t string, o int, c int, at timestamp"


def drawn_log(seed):
    draw = random.Random(seed)
    return [(k, draw.choice("xyz"), draw.randrange(100), draw.randrange(100), day(n))
            for k in "abcdefg" for n in draw.sample(range(30), draw.randrange(1, 12))]


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_deliveries_gives_the_history_of_the_log(spark, seed):
    rows = drawn_log(seed)
    draw = random.Random(seed)
    draw.shuffle(rows)
    cuts = [0, *sorted(draw.sample(range(1, len(rows)), 3)), len(rows)]
    dim = spark.createDataFrame([], "sk long, k string, t string, o int, c int, valid_from timestamp, valid_to timestamp, is_current boolean, _hash_diff string")
    seen, owners, mark = [], {}, 0
    for a, b in zip(cuts[:-1], cuts[1:]):
        dim = spark.createDataFrame(
            scd.scd2_merge(dim, spark.createDataFrame(seen, LOG), spark.createDataFrame(rows[a:b], LOG), SPEC, "at", mark).collect(), dim.schema)
        seen += rows[a:b]
        held = dim.collect()
        want = scd.scd2_history(spark.createDataFrame(seen, LOG), SPEC, "at")
        assert sorted(map(tuple, dim.drop("sk").collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
        assert len({r.sk for r in held}) == len(held) and None not in {r.sk for r in held}
        for r in held:  # a surrogate key stays with its key, and with the moment at which its version once began
            assert owners.setdefault(r.sk, (r.k, r.t)) == (r.k, r.t)
        mark = max([mark, *(r.sk for r in held)])


def test_late_arrivals_that_cannot_be_placed_fail(spark):
    log = [("a", "x", 1, 1, day(1)), ("a", "y", 1, 1, day(5))]
    seen = spark.createDataFrame(log, LOG)
    plain = scd.Scd2Spec(key=("k",), tracked=("t",), overwrite=("o",), carried=("c",))
    dim = scd.scd2_history(seen, plain, "at")
    for bad, why in ((("a", "z", 1, 1, day(5)), "two rows of one key"), ((None, "z", 1, 1, day(9)), "NULL business key"),
                     (("a", "z", 1, 1, None), "NULL business key")):
        with pytest.raises(Exception, match=why):
            scd.scd2_merge(dim, seen, spark.createDataFrame([bad], LOG), plain, "at").collect()


def test_an_ordinary_batch_leaves_closed_versions_and_other_keys_alone(spark):
    seen = spark.createDataFrame([("a", "x", 1, 1, day(1)), ("a", "y", 2, 2, day(5)), ("b", "x", 3, 3, day(5))], LOG)
    plain = scd.Scd2Spec(key=("k",), tracked=("t",), overwrite=("o",), carried=("c",))
    dim = scd.scd2_history(seen, plain, "at")
    merged = scd.scd2_merge(dim, seen, spark.createDataFrame([("a", "y", 7, 7, day(8)), ("n", "x", 0, 0, day(8))], LOG), plain, "at")
    assert sorted((r.k, r.t, r.o, r.c, r.valid_from, r.valid_to, r.is_current) for r in merged.collect()) == [
        ("a", "x", 1, 1, day(1), day(5), False), ("a", "y", 7, 2, day(5), None, True), ("b", "x", 3, 3, day(5), None, True),
        ("n", "x", 0, 0, day(8), None, True)]


DIM = Contract("patched_test.dim", "sk BIGINT NOT NULL, k BIGINT NOT NULL, t STRING, o INT, valid_from TIMESTAMP NOT NULL, "
               "valid_to TIMESTAMP, is_current BOOLEAN, _hash_diff STRING", key=("sk",), surrogate="sk")
DIM_SPEC = scd.Scd2Spec(key=("k",), tracked=("t",), overwrite=("o",), surrogate="sk")


def files(spark, name):
    return {f: os.path.getsize(f.removeprefix("file:").replace("///", "/")) for f in spark.table(name).inputFiles()}


def test_a_dimension_is_written_in_proportion_to_what_changes(spark):
    tables.create_schemas(spark, ["patched_test"])
    base = spark.range(4000).select(F.col("id").alias("k"), F.concat(F.lit("t"), F.col("id")).alias("t"), F.lit(1).alias("o"))
    apply = lambda rows, moment, version: patched.apply_to_dimension(spark, DIM, rows, DIM_SPEC, moment, version)
    assert apply(base, "2024-01-01 00:00:00", "v1") == 4000
    plain = scd.scd2_initial(base, DIM_SPEC, "2024-01-01 00:00:00")
    first = files(spark, DIM.name)
    assert apply(base, "2024-01-02 00:00:00", "v2") == 0 and files(spark, DIM.name) == first  # nothing changed, nothing written

    changed = base.withColumn("t", F.when(F.col("k") == 17, F.lit("new")).otherwise(F.col("t"))).unionByName(
        spark.createDataFrame([(9000, "t", 5)], base.schema))
    written = apply(changed, "2024-01-03 00:00:00", "v3")
    second = files(spark, DIM.name)
    assert written < 4000 / 64 * 2 * 2 and set(first) & set(second)
    assert sum(size for f, size in second.items() if f not in first) < sum(first.values()) / 8
    plain = scd.scd2_apply(plain, changed, DIM_SPEC, "2024-01-03 00:00:00", keys.largest(plain, "sk"))
    state = lambda df: sorted(map(tuple, df.drop("sk").collect()), key=repr)
    assert state(spark.table(DIM.name)) == state(plain)
    assert len({r.sk for r in spark.table(DIM.name).collect()}) == 4002

    third = changed.withColumn("o", F.when(F.col("k") == 17, F.lit(8)).otherwise(F.col("o")))
    apply(third, "2024-01-04 00:00:00", "v3")  # the name of a version may come again
    plain = scd.scd2_apply(plain, third, DIM_SPEC, "2024-01-04 00:00:00", keys.largest(plain, "sk"))
    assert state(spark.table(DIM.name)) == state(plain)

    with pytest.raises(Exception, match="duplicate business key"):
        apply(third.unionByName(third.limit(1)), "2024-01-05 00:00:00", "v4")
    broken = plain.limit(3).withColumn("valid_from", F.lit(None).cast("timestamp"))
    with pytest.raises(tables.Rejected):
        patched.commit(broken, DIM, F.lit("c1"), "v5", ["c1"])
    assert state(spark.table(DIM.name)) == state(plain)
    assert len(patched.drop_unread(spark, DIM)) >= 1  # the rejected patch
    assert state(spark.table(DIM.name)) == state(plain)


def test_many_patches_end_in_a_whole_version(spark):
    tables.create_schemas(spark, ["patched_test"])
    contract = Contract("patched_test.fact", "sk_data INT NOT NULL, n INT NOT NULL")
    part = F.col("sk_data")
    frame = lambda rows: spark.createDataFrame(rows, "sk_data int, n int")
    with pytest.raises(ValueError):
        patched.commit(frame([(1, 1)]), contract, part, "v", ["1"])
    patched.commit(frame([(d, 0) for d in range(6)]), contract, part, "whole")
    for i in range(1, 6):
        patched.commit(frame([(i, i)] if i != 3 else []), contract, part, f"p{i}", [str(i)], most=3)
        expected = {0: 0, 1: 1, 2: 2, 3: None, 4: 4, 5: 5}
        want = sorted((d, expected[d] if d <= i else 0) for d in range(6) if d > i or expected[d] is not None)
        assert sorted(map(tuple, spark.table(contract.name).collect())) == want
    assert len(patched._layers(spark, contract)) <= 4
    plan = spark.table(contract.name).filter("sk_data = 2")._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan
    patched.drop_unread(spark, contract)
    assert sorted(map(tuple, spark.table(contract.name).collect())) == want
    assert patched.commit(frame([]), contract, part, "none", []) == 0


def test_untouched_days_keep_their_files(spark):
    tables.create_schemas(spark, ["patched_test"])
    contract = Contract("patched_test.sales", "sk_data INT NOT NULL, q INT NOT NULL")
    orders = spark.createDataFrame([(i, dt.date(2024, 1, 1 + i % 9)) for i in range(90)], "order_id int, data_ordine date")
    lines = spark.createDataFrame([(i, 1, "p", "s", i, 1.0) for i in range(90)],
                                  "order_id int, line_num int, cod_prodotto string, pos_id string, quantita int, importo_riga double")
    fact = lambda o, l: l.join(o, "order_id").groupBy(
        F.date_format("data_ordine", "yyyyMMdd").cast("int").alias("sk_data")).agg(F.sum("quantita").cast("int").alias("q"))
    patched.commit(fact(orders, lines), contract, F.col("sk_data"), "a")
    before = files(spark, contract.name)
    moved = orders.withColumn("data_ordine", F.when(F.col("order_id") == 4, F.lit(dt.date(2024, 1, 8))).otherwise(F.col("data_ordine")))
    more = lines.withColumn("quantita", F.when(F.col("order_id") == 10, 1000).otherwise(F.col("quantita"))).filter("order_id <> 11")
    days = gold.touched_days(orders, moved, lines, more, ["order_id"], ["order_id", "line_num"])
    touched = sorted(r.data_ordine.strftime("%Y%m%d") for r in days.collect())
    assert touched == ["20240102", "20240103", "20240105", "20240108"]
    some = gold.of_days(moved, [int(x) for x in touched])
    patched.commit(fact(some, gold.lines_of(more, some)), contract, F.col("sk_data"), "b", touched)
    assert sorted(map(tuple, spark.table(contract.name).collect())) == sorted(map(tuple, fact(moved, more).collect()))
    after = files(spark, contract.name)
    same = {f for f in before if not any(f"={d}/" in f for d in touched)}
    assert same and same <= set(after) and not (set(before) - same) & set(after)


def test_distinct_states_listed_and_drawn(spark):
    rows = spark.range(0, 200_000, 1, 4).select(
        (F.col("id") % 70_000).alias("pos"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 700)).alias("g"))
    rows = rows.unionByName(spark.createDataFrame([(None, "hot"), (None, "none"), (5, None), (5, None)], "pos long, g string"))
    state = distinct.distinct_state(rows, ["g"], "pos")
    kinds = state.agg(F.count("_listed"), F.count("_bitmap"), F.max(F.size("_listed")), F.max(F.length("_bitmap"))).first()
    assert kinds[0] > 0 and kinds[1] > 0 and kinds[2] <= distinct.MOST_LISTED and kinds[3] == 4096
    plain = lambda df: {r[0]: r[1] for r in df.collect()}
    want = plain(rows.filter("pos is not null").groupBy("g").agg(F.count_distinct("pos")))
    assert plain(distinct.distinct_counts(state, ["g"], "n")) == want
    coarse = F.substring("g", 1, 2).alias("h")
    steps = distinct.distinct_counts(distinct.merge_states(state, [coarse]), ["h"], "n")
    assert plain(steps) == plain(rows.filter("pos is not null").groupBy(coarse).agg(F.count_distinct("pos")))
    assert distinct.distinct_counts(state.limit(0), ["g"], "n").count() == 0


def test_merged_states_of_few_positions_stay_lists(spark):
    """A bucket with a list and a bitmap has one row; a handful of positions does not become a bitmap of 4 KB."""
    rows = spark.range(0, 6000, 1, 4).select(F.col("id").alias("pos"), F.when(F.col("id") < 3000, "hot").otherwise(
        F.concat(F.lit("g"), F.col("id"))).alias("g"), (F.col("id") % 2).alias("half"))
    rows = rows.unionByName(rows.filter("pos between 2990 and 2999").withColumn("g", F.lit(None).cast("string")))
    state = distinct.distinct_state(rows, ["g", "half"], "pos")
    fine = distinct.merge_states(state, ["g"])
    assert fine.filter("_bitmap is not null").select("g").collect() == [("hot",)]
    assert fine.filter("_listed is not null").agg(F.count("*"), F.sum(F.size("_listed"))).first() == (3001, 3010)
    hot = F.coalesce(F.col("g") == "hot", F.col("g").isNull() | (F.col("g") < "g4")).alias("h")
    coarse = distinct.merge_states(fine, [hot])
    assert coarse.groupBy("h", "_bucket").count().filter("count > 1").count() == 0
    plain = lambda df: {r[0]: r[1] for r in df.collect()}
    want = plain(rows.groupBy(hot).agg(F.count_distinct("pos")))
    assert plain(distinct.distinct_counts(coarse, ["h"], "n")) == plain(distinct.distinct_counts(fine, [hot], "n")) == want


def test_change_feed_of_null_and_repeated_keys(spark):
    old = spark.createDataFrame([(None, "a"), (1, "b"), (2, "c")], "k int, v string")
    new = spark.createDataFrame([(None, "a"), (1, "x")], "k int, v string")
    feed = cdf.change_feed(old, new, ["k"])
    assert sorted(map(tuple, feed.collect()), key=repr) == sorted(
        [(1, "b", "update_preimage"), (1, "x", "update_postimage"), (2, "c", "delete")], key=repr)
    assert sorted(map(tuple, cdf.apply_changes(old, feed, ["k"]).collect()), key=repr) == sorted(map(tuple, new.collect()), key=repr)
    gone = cdf.change_feed(old, new.filter("k is not null"), ["k"])
    assert cdf.apply_changes(old, gone, ["k"]).filter("k is null").count() == 0
    for pair in ((old.unionByName(old), new), (old, new.unionByName(new.filter("k is null")))):
        with pytest.raises(Exception, match="occurs twice"):
            cdf.change_feed(*pair, ["k"]).collect()


def test_keep_keys_of_null_and_repeated_keys(spark):
    before = spark.createDataFrame([(None, 5), ("x", 6)], "k string, sk long")
    df = spark.createDataFrame([(None,), ("x",), ("y",)], "k string")
    kept = {r.k: r.sk for r in keys.keep_keys(df, before, ["k"], "sk", 6).collect()}
    assert kept[None] == 5 and kept["x"] == 6 and kept["y"] > 6
    with pytest.raises(Exception, match="two surrogate keys"):
        keys.keep_keys(df, before.unionByName(before), ["k"], "sk", 6).collect()


def test_pick_parent_of_null_groups(spark):
    df = spark.createDataFrame([(i, None if i % 2 else "g") for i in range(40)], "id long, g string")
    parents = spark.createDataFrame([(1, "g"), (2, "g"), (3, None), (4, None)], "s int, g string")
    got = synthetic.pick_parent(df, rv.uniform(1, "p", F.col("id")), parents, ["s"], ["g"]).collect()
    assert len(got) == 40 and all((r.s in (3, 4)) == (r.g is None) for r in got)
    with pytest.raises(Exception, match="no parent"):
        synthetic.pick_parent(df, rv.uniform(1, "p", F.col("id")), parents.filter("g is not null"), ["s"], ["g"]).collect()


def test_two_current_versions_of_one_key_fail(spark):
    spec = scd.Scd2Spec(key=("k",), tracked=("t",))
    one = scd.scd2_initial(spark.createDataFrame([(1, "a")], "k int, t string"), spec, "2024-01-01")
    with pytest.raises(Exception, match="among the current versions"):
        scd.scd2_apply(one.unionByName(one), spark.createDataFrame([(1, "b")], "k int, t string"), spec, "2024-02-01").collect()


def test_digests_tell_the_buckets_that_changed(spark, tmp_path):
    """One row in a hundred changes, all in few buckets: only their folders are read."""
    old = spark.range(5000).select(F.col("id").alias("k"), F.when(F.col("id") % 3 == 0, F.lit("x")).alias("v"), F.lit(None).cast("string").alias("w"))
    few = cdf.bucket_of(["k"], 64).isin(3, 9)
    new = old.withColumn("v", F.when(few, F.lit("new")).otherwise(F.col("v"))).withColumn(
        "w", F.when(few & F.col("v").isNull(), F.lit("w")).otherwise(F.col("w"))).filter("k <> 77")
    stored = []
    for name, df in (("old", old), ("new", new.repartition(5))):
        df.withColumn(cdf.BUCKET, cdf.bucket_of(["k"], 64)).write.partitionBy(cdf.BUCKET).parquet(str(tmp_path / name))
        stored.append(spark.read.parquet(str(tmp_path / name)).select("k", "v", "w", cdf.BUCKET))
    of_77 = spark.createDataFrame([(77,)], "k long").select(cdf.bucket_of(["k"], 64)).first()[0]
    changed = cdf.changed_buckets(cdf.digests(old, ["k"], 64), cdf.digests(new.repartition(3), ["k"], 64))
    assert changed == sorted({3, 9, of_77})
    feed = cdf.change_feed_of_buckets(*stored, ["k"], changed)
    assert sorted(map(tuple, feed.collect()), key=repr) == sorted(map(tuple, cdf.change_feed(old, new, ["k"]).collect()), key=repr)
    plan = feed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [_bucket") >= 2
    swapped = spark.createDataFrame([(1, "a", None)], "k long, v string, w string")
    other = spark.createDataFrame([(1, None, "a")], "k long, v string, w string")
    assert cdf.changed_buckets(cdf.digests(swapped, ["k"]), cdf.digests(other, ["k"]))  # a value that moves over a NULL
    assert cdf.changed_buckets(cdf.digests(old, ["k"]), cdf.digests(old.orderBy(F.desc("k")), ["k"])) == []


def test_constraints_take_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a", 2), (1, None, 3), (2, "b", None), (None, "c", 9)], "k int, v string, n int").write.parquet(path)
    df = spark.read.parquet(path)
    found = quality.constraints(df, ["k"], ["v", "n"], {"n": F.col("n")}, {"small": F.col("n") < 5})
    assert {r.check_name: int(r.value) for r in found.collect()} == {
        "rows": 4, "key": 1, "null v": 1, "null n": 1, "not small": 2, "sum n": 14}
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") <= 2  # once each in the initial and final plan
    empty = quality.constraints(df.limit(0), ["k"], ["v"], {"n": F.col("n")})
    assert {int(r.value) for r in empty.collect()} == {0}


def test_layout_skips_files_for_either_key(spark, tmp_path):
    """Of 64 files, a product or a store is in few; the hot product is cut over several."""
    rows = spark.range(0, 64000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, F.lit(50)).otherwise(F.crc32(F.col("id").cast("string").cast("binary")) % 1000).alias("p"),
        (F.crc32(F.concat(F.lit("s"), F.col("id")).cast("binary")) % 1000).alias("s"), "id")
    path = str(tmp_path / "z")
    layout.laid_out(rows, ["p", "s"], 64, ties=["id"]).write.parquet(path)
    bounds = spark.read.parquet(path).groupBy(F.input_file_name()).agg(
        F.min("p").alias("p0"), F.max("p").alias("p1"), F.min("s").alias("s0"), F.max("s").alias("s1"), F.count("*").alias("n"))
    held = bounds.collect()
    assert len(held) > 50 and max(r.n for r in held) < 4000 and sum(r.n for r in held) == 64000
    reads = lambda c, v: sum(r[f"{c}0"] <= v <= r[f"{c}1"] for r in held)
    assert sum(reads("p", v) for v in range(500, 1000, 25)) / 20 <= 16 and sum(reads("s", v) for v in range(0, 1000, 50)) / 20 <= 28
    assert reads("p", 50) >= 8
    places = spark.createDataFrame([(a, b) for a in range(4) for b in range(4)], "a int, b int")
    curve = {(r.a, r.b): r.z for r in places.select("a", "b", layout.interleaved([F.col("a"), F.col("b")], 2).alias("z")).collect()}
    assert curve == {(a, b): ((a >> 1) << 3 | (b >> 1) << 2 | (a & 1) << 1 | b & 1) for a, b in curve}
    nothing = spark.createDataFrame([], rows.schema)
    assert layout.laid_out(nothing, ["p", "s"], 4).count() == 0
    assert layout.laid_out(spark.createDataFrame([(None, 1, 1), (2, None, 2)], rows.schema), ["p", "s"], 4).count() == 2


def test_a_streamed_batch_that_comes_again_is_merged_once(spark, tmp_path):
    """The folder of a checkpoint is lost: all files are read again under the same numbers."""
    tables.create_schemas(spark, ["stream_test"])
    seen = Contract("stream_test.seen", "k STRING NOT NULL, t STRING, at TIMESTAMP, _batch_id STRING", partition_by=("_batch_id",), appended=True)
    dim = Contract("stream_test.dim", "k STRING NOT NULL, t STRING, valid_from TIMESTAMP NOT NULL, valid_to TIMESTAMP, is_current BOOLEAN, _hash_diff STRING")
    spec = scd.Scd2Spec(key=("k",), tracked=("t",))
    schema = c.text_schema(("k", "t", "at"))
    landing.write_csv(spark.createDataFrame([("a", "x", "2024-01-05 00:00:00"), ("a", "y", "2024-01-01 00:00:00")], schema), str(tmp_path / "in/one"))
    run = lambda n: follow_history(spark, str(tmp_path / "in/*"), schema, {"at": "timestamp"}, seen, dim, spec, "at", str(tmp_path / f"cp{n}"), "r")
    run(1)
    first = sorted(map(tuple, spark.table(dim.name).collect()), key=repr)
    assert [(r[1], r[4]) for r in first] == [("x", True), ("y", False)] and spark.table(seen.name).count() == 2
    run(2)
    assert sorted(map(tuple, spark.table(dim.name).collect()), key=repr) == first and spark.table(seen.name).count() == 2


def test_a_broken_row_in_the_first_run_waits_in_quarantine(spark, tmp_path):
    """One bad day among the orders: the run goes through to the fact; the repaired order is in it the next day."""
    clear = lambda: [spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE") for name in c.SCHEMAS]
    clear()
    path, broken = str(tmp_path / "landing"), str(tmp_path / "broken")
    generate.write_landing(spark, path, 30, 50, 60)
    for table in c.SOURCE_COLUMNS:
        df = landing.read_csv(spark, f"{path}/{table}.csv", c.text_schema(c.SOURCE_COLUMNS[table]))
        if table == "ordini":
            df = df.withColumn("data_ordine", F.when(F.col("order_id") == "ORD-0000007", "2024-13-45").otherwise(F.col("data_ordine")))
        landing.write_csv(df, f"{broken}/{table}.csv")
    warehouse.run(spark, broken, "d1", "2025-01-01 06:00:00")
    assert spark.table("slv_sales.ordini").count() == 59
    waiting = warehouse.quarantined(spark)["slv_sales.ordini"].collect()
    assert [(r.order_id, r.missing) for r in waiting] == [("ORD-0000007", ["data_ordine"])]
    held = spark.table("gld_sales.fact_vendite_giornaliere").agg(F.sum("importo_lordo")).first()[0]
    warehouse.run(spark, path, "d2", "2025-01-02 06:00:00", quarantine=True)
    assert spark.table("slv_sales.ordini").count() == 60 and warehouse.quarantined(spark)["slv_sales.ordini"].count() == 0
    assert spark.table("gld_sales.fact_vendite_giornaliere").agg(F.sum("importo_lordo")).first()[0] > held
    clear()  # other tests begin with an empty warehouse
