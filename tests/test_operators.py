"""Small hand-made cases for the remaining operators."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from layerhouse import contracts
from layerhouse.functions import formats, money, random_values as rv
from layerhouse.functions.hashing import hash_diff
from layerhouse.operators import bronze, calendar_dim, cdf, gold, keys, quality, silver, synthetic


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_latest_row_and_ties(spark):
    df = spark.createDataFrame(
        [(1, "t1", "a", "x"), (1, "t2", "b", "y"), (2, "t1", "a", "z"), (3, "t1", "a", "m"), (3, "t1", "a", "n")],
        "k int, ts string, batch string, v string")
    order = [F.col("ts").desc(), F.col("v").desc()]
    for partitions in (1, 5):
        kept = silver.latest_per_key(df.repartition(partitions), ["k"], order)
        assert rows(kept.select("k", "v")) == [(1, "y"), (2, "z"), (3, "n")]
    with pytest.raises(ValueError):
        silver.latest_per_key(df, ["k"], [])


def test_latest_row_keeps_one_row_per_key_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = silver.latest_per_key(df, ["k"], [F.col("v").desc()])
    text = plan._jdf.queryExecution().executedPlan().toString()
    # The plan is printed from the end: final limit, exchange, partial limit.
    assert text.count("WindowGroupLimit") == 2
    assert text.index("WindowGroupLimit") < text.index("Exchange hashpartitioning") < text.rindex("WindowGroupLimit")


def test_typing_and_rejects(spark):
    df = spark.createDataFrame([(1, "2024-13-45", "12.345"), (2, "2024-01-31", None), (3, None, "x")],
                               "id int, d string, n string")
    types = {"d": "date", "n": "decimal(10,2)"}
    assert rows(silver.apply_types(df, types)) == [
        (1, None, Decimal("12.35")), (2, dt.date(2024, 1, 31), None), (3, None, None)]
    assert rows(silver.cast_rejects(df, ["id"], types)) == [
        (1, "d", "date", "2024-13-45"), (3, "n", "decimal(10,2)", "x")]


def test_bronze_columns(spark):
    raw = bronze.to_bronze(spark.range(2), "ordini", "b1", "2024-06-01 06:00:00")
    assert raw.dtypes == [("id", "string"), ("_ingestion_ts", "timestamp"), ("_source_file", "string"),
                          ("_batch_id", "string")]
    assert {r._source_file for r in raw.collect()} == {"postgres-source/ordini"}
    assert rows(bronze.batch_row_audit(raw)) == [("b1", 2)]


def test_hashes_with_null(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    plain = [r[0] for r in df.select(hash_diff("x", "y", "z")).collect()]
    assert set(plain) == {"23360994fdaa608ee91c88e2901c2e83d5322dc145fafebe06e4d9036d5d1e28"}
    safe = [r[0] for r in df.select(hash_diff("x", "y", "z", null_safe=True)).collect()]
    assert len(set(safe)) == 2


def test_calendar(spark):
    dates = calendar_dim.date_dimension(spark, 2020, 2030).cache()
    assert dates.count() == 4018
    flags = dates.agg(F.count_if("festivo_flag"), F.count_if("ponte_flag"), F.count_if("weekend_flag")).first()
    assert tuple(flags) == (110, 33, 1148)
    assert quality.days_held(dates, 2023, 2024).first().n_giorni == 731
    day = {r.sk_data: r for r in dates.filter("sk_data in (20241225, 20240115, 20241230)").collect()}
    christmas = day[20241225]
    assert (christmas.giorno_settimana, christmas.nome_mese, christmas.trimestre, christmas.festivo_flag,
            christmas.anno_fiscale) == ("Wednesday", "December", 4, True, 2024)
    assert day[20240115].anno_fiscale == 2023
    assert day[20241230].settimana_iso == 1
    dates.unpersist()
    short = calendar_dim.date_dimension(spark, 2021, 2027).filter("sk_data = 20271231").first()
    assert short.giorno_settimana == "Friday" and not short.ponte_flag


def star(spark):
    lines = spark.createDataFrame(
        [("o1", 1, "p1", 2, Decimal("5.00")), ("o1", 2, "p1", 3, Decimal("6.00")), ("o2", 1, "p9", 1, Decimal("4.00"))],
        "order_id string, line_num int, cod_prodotto string, quantita int, importo_riga decimal(10,2)")
    orders = spark.createDataFrame(
        [("o1", "s1", dt.date(2024, 3, 1)), ("o2", "s1", dt.date(2024, 3, 1))],
        "order_id string, pos_id string, data_ordine date")
    products = spark.createDataFrame([(1, "p1", True, 22), (2, "p1", False, 22), (3, "p9", False, 22)],
                                     "sk_prodotto long, cod_prodotto string, is_current boolean, iva_perc int")
    stores = spark.createDataFrame([(7, "s1", True)], "sk_punto_vendita long, pos_id string, is_current boolean")
    return lines, orders, products, stores


def test_daily_fact(spark):
    lines, orders, products, stores = star(spark)
    fact = gold.daily_sales_fact(lines, orders, products, stores)
    assert rows(fact) == [(20240301, 1, 7, None, 1, 5, Decimal("11.00"), Decimal("10.00"), Decimal("0.00"))]
    assert [c for c, _ in fact.dtypes] == contracts.FACT_DAILY_SALES.columns
    own_rate = gold.daily_sales_fact(lines, orders, products, stores, divisor=money.tax_divisor(F.col("iva_perc")))
    assert own_rate.first().importo_netto == Decimal("9.02")
    assert gold.daily_sales_fact(lines, orders, products, stores, days=("2024-03-02", "2024-03-31")).count() == 0
    lost = gold.dropped_lines(lines, orders, products, stores)
    assert rows(lost.select("order_id", "line_num", "missing")) == [("o2", 1, "product")]
    one = orders.filter("order_id <> 'o1'")
    lost = gold.dropped_lines(lines, one, products, stores)
    assert {(r.order_id, r.missing) for r in lost.collect()} == {("o1", "order"), ("o2", "product")}
    no_day = orders.withColumn("data_ordine", F.lit(None).cast("date"))
    assert {r.missing for r in gold.dropped_lines(lines, no_day, products, stores).collect()} == {"day", "product"}


def test_fact_day_range_reaches_the_scan(spark, tmp_path):
    lines, orders, products, stores = star(spark)
    orders.write.parquet(str(tmp_path / "orders"))
    fact = gold.daily_sales_fact(lines, spark.read.parquet(str(tmp_path / "orders")), products, stores,
                                 days=("2024-03-02", "2024-03-31"))
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(data_ordine,2024-03-02)" in plan


def test_unknown_member(spark):
    customers = spark.createDataFrame([("C1", "Ada", "X")], "codice_fiscale string, nome string, extra string")
    customers = contracts.conform(customers, contracts.SILVER_CUSTOMERS)
    dim = gold.customer_dimension(customers, contracts.CUSTOMER_ATTRIBUTES, contracts.UNKNOWN_CUSTOMER,
                                  contracts.UNKNOWN_CUSTOMER_SCHEMA)
    found = {r.codice_fiscale: r.segmento for r in dim.collect()}
    assert found == {"C1": "standard", "UNKNOWN": "sconosciuto"}


def test_checks(spark):
    fact = spark.createDataFrame([(1, 1, 10), (1, 1, 10), (1, 2, 11), (2, 2, None)], "d int, s int, fk int")
    assert rows(quality.duplicate_groups(fact, ["d", "s"])) == [(1, 1, 2)]
    parents = spark.createDataFrame([(10,)], "id int")
    assert rows(quality.orphan_keys(fact, "fk", parents, "id")) == [(11, 1), (None, 1)]
    assert rows(quality.null_counts(fact, ["d", "fk"])) == [("fk", 1)]
    totals = quality.reconcile(fact, F.col("s"), parents, F.col("id"))
    assert rows(totals) == [(Decimal("6.00"), Decimal("10.00"), Decimal("4.00"))]


def test_contract(spark):
    with pytest.raises(ValueError, match="codice_fiscale"):
        contracts.conform(spark.range(1), contracts.SILVER_CUSTOMERS)
    conformed = contracts.conform(spark.range(1).select(F.lit("x").alias("codice_fiscale")), contracts.SILVER_CUSTOMERS)
    assert conformed.columns == contracts.SILVER_CUSTOMERS.columns
    assert contracts.DIM_PRODUCT.required == ["sk_prodotto", "cod_prodotto", "valid_from"]


def test_contract_columns_follow_the_dimension_specs():
    for contract, spec in ((contracts.DIM_PRODUCT, contracts.PRODUCT_SPEC), (contracts.DIM_STORE, contracts.STORE_SPEC)):
        assert set(contract.ddl.replace("NOT NULL", "").split()) >= set(spec.columns)


def test_keys(spark):
    df = spark.range(5000).withColumn("g", (F.col("id") % 3).cast("string"))
    dense = keys.dense_keys(df, ["id"], "sk", after=100)
    assert sorted(r.sk for r in dense.collect()) == list(range(101, 5101))
    fine = keys.dense_keys(df, ["id"], "sk", after=100, digits=3)
    assert rows(fine) == rows(dense.select(*fine.columns))
    strided = [r.sk for r in keys.strided_keys(df.repartition(3), ["id"], "sk", after=7).collect()]
    assert len(set(strided)) == 5000 and min(strided) > 7
    within = keys.dense_position(df, ["id"], "p", within=["g"])
    sizes = within.groupBy("g").agg(F.min("p"), F.max("p"), F.count_distinct("p")).collect()
    assert sorted(tuple(r)[1:] for r in sizes) == [(0, 1665, 1666), (0, 1666, 1667), (0, 1666, 1667)]
    with pytest.raises(ValueError):
        keys.strided_keys(df, ["id"], "sk", digits=9)


def test_change_feed_round_trip(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "d")], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "B"), (3, "c"), (5, "e")], "k int, v string")
    feed = cdf.change_feed(old, new, ["k"])
    assert rows(feed) == sorted([
        (2, "b", "update_preimage"), (2, "B", "update_postimage"), (3, None, "update_preimage"),
        (3, "c", "update_postimage"), (4, "d", "delete"), (5, "e", "insert")], key=repr)
    assert rows(cdf.apply_changes(old, feed, ["k"])) == rows(new)


def test_formats(spark):
    n = F.lit(7)
    got = spark.range(1).select(
        formats.store_key(F.lit("MI"), n), formats.product_key(n), formats.loyalty_card(n), formats.order_key(n),
        formats.time_of_day(F.lit(8), F.lit(5)), formats.store_key(F.lit("MI"), F.lit(12345))).first()
    assert tuple(got) == ("IT-MI-007", "P-00007", "TF-000007", "ORD-0000007", "08:05:00", "IT-MI-12345")


def test_rates_and_amounts(spark):
    got = spark.range(1).select(*[
        money.lookup_rate(F.lit(c), money.TAX_RATE_BY_CATEGORY, money.TAX_RATE_DEFAULT) for c in ("Vini", "Carne", "Pane")
    ], money.line_amount(F.lit(3), F.lit("1.25")), money.net_amount(F.lit(Decimal("0.13")), money.tax_divisor(F.lit(4)))).first()
    assert tuple(got) == (22, 10, 4, Decimal("3.75"), Decimal("0.13"))


def test_random_columns_do_not_depend_on_partitions(spark):
    def drawn(df):
        u = rv.uniform(1, "s", F.col("id"))
        return rows(df.select("id", u, synthetic.quantity(1, F.col("id")), synthetic.unit_price(1, F.col("id"))))

    assert drawn(spark.range(0, 500, 1, 1)) == drawn(spark.range(0, 500, 1, 9))


def test_weighted_choice_shares(spark):
    counts = dict(spark.range(40000).groupBy(synthetic.quantity(5, F.col("id")).alias("q")).count().collect())
    for value, weight in zip(synthetic.QUANTITIES, synthetic.QUANTITY_WEIGHTS):
        assert abs(counts[value] / 40000 - weight / 100) < 0.01


def test_season_lowers_weak_months(spark):
    day = synthetic.seasonal_date(5, F.col("id"), "2023-01-01", "2024-12-31")
    counts = dict(spark.range(100000).groupBy(F.month(day).alias("m")).count().collect())
    # Expected from the rule: a day is drawn again with probability 1 - coefficient.
    for month, expected in ((1, 7632), (8, 7208), (12, 8904)):
        assert abs(counts[month] - expected) < 350


def test_sample_is_distinct_and_complete(spark):
    k, n = F.lit(5), F.lit(8).cast("bigint")
    draws = rv.uniforms(1, "s", F.col("id"), k, 12)
    picked = spark.range(20000).select("id", F.explode(rv.sample_positions(n, k, draws)).alias("p"))
    per_row = picked.groupBy("id").agg(F.count_distinct("p").alias("d"), F.min("p").alias("lo"), F.max("p").alias("hi"))
    assert per_row.agg(F.min("d"), F.max("d"), F.min("lo"), F.max("hi")).first()[:] == (5, 5, 0, 7)
    shares = [r["count"] / 20000 for r in picked.groupBy("p").count().collect()]
    assert len(shares) == 8 and all(abs(s - 5 / 8) < 0.02 for s in shares)


def test_few_products_are_all_taken(spark):
    orders = spark.range(200).withColumnRenamed("id", "order_id")
    products = spark.createDataFrame([("a", Decimal("1.50")), ("b", Decimal("2.00"))], "p string, price decimal(10,2)")
    lines = synthetic.order_lines(orders, "order_id", products, "p", "price", 1)
    per_order = lines.groupBy("order_id").agg(F.count_distinct("p").alias("d"), F.count("*").alias("n")).collect()
    assert len(per_order) == 200 and all(r.d == r.n <= 2 for r in per_order)


def test_parents_are_picked_evenly(spark):
    parents = spark.createDataFrame([(f"s{i}", "A" if i < 3 else "B") for i in range(8)], "s string, g string")
    df = spark.range(8000).withColumn("g", F.when(F.col("id") % 2 == 0, "A").otherwise("B"))
    got = synthetic.pick_parent(df, rv.uniform(1, "p", F.col("id")), parents, ["s"], ["g"])
    counts = dict(got.groupBy("s").count().collect())
    assert sum(counts.values()) == 8000 and len(counts) == 8
    assert max(counts.values()) < 1500 and min(counts.values()) > 650
