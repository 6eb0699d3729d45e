"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from layerhouse.plans.catalogue import QUERIES
from compare import SF
from layerhouse.operators import gold, scd

UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas",
            "FlatMapGroupsInPandas")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"fact_partition_prune"}))
def test_no_products_and_no_python(name, spark):
    plan = plan_of(entry.queries()[name](spark, SF))
    assert [word for word in UNWANTED if word in plan] == []


def test_fact_reads_only_its_columns(spark):
    plan = plan_of(entry.queries()["fact_daily_sales"](spark, SF))
    schemas = [line.split("ReadSchema: ")[1] for line in plan.splitlines() if "ReadSchema" in line]
    assert any("l_orderkey" in s for s in schemas)
    assert not any(c in plan for c in ("l_discount", "l_tax", "o_totalprice", "p_name", "s_name"))


def test_fact_joins_dimensions_after_the_sums(spark):
    """Printed from the end: both dimension joins stand above the last aggregate."""
    plan = plan_of(entry.queries()["fact_daily_sales"](spark, SF))
    above = plan[: plan.index("HashAggregate")]
    assert above.count("HashJoin") + above.count("SortMergeJoin") == 2


def test_date_range_is_pushed_to_the_orders(spark):
    df = entry.queries()["fact_date_range"](spark, SF)
    scan = [line for line in plan_of(df).splitlines() if "o_orderdate" in line and "FileScan" in line]
    assert scan and "1997" in scan[0]


def test_date_range_meets_the_raw_lines_below_the_window(spark):
    plan = plan_of(entry.queries()["fact_date_range"](spark, SF))
    below = plan[plan.rindex("Window ["):]
    assert "LeftSemi" in below and "1997" in below


def test_closed_versions_are_not_shuffled(spark):
    spec = scd.Scd2Spec(key=("k",), tracked=("a",))
    dim = spark.range(5).select(
        F.col("id").alias("k"), F.lit("x").alias("a"), F.current_timestamp().alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"), (F.col("id") > 2).alias("is_current"), F.lit("h").alias("_hash_diff"))
    plan = plan_of(scd.scd2_apply(dim, dim.select("k", "a"), spec, "2024-01-01 00:00:00"))
    closed_branch = plan.split("SortMergeJoin")[0]
    assert "Union" in closed_branch and "Exchange" not in closed_branch


def test_snapshot_history_needs_one_shuffle_by_key(spark):
    spec = scd.Scd2Spec(key=("k",), tracked=("a",), overwrite=("p",))
    log = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("seq"), (F.col("id") % 2).alias("a"),
                                  F.col("id").alias("p"))
    assert plan_of(scd.scd2_history(log, spec, "seq")).count("Exchange hashpartitioning") == 1


def test_changed_lines_are_compared_once(spark):
    """Two feeds, of orders and of lines, are two outer joins; the order heads meet the gained products' lines alone."""
    heads = spark.range(0, 50).select(F.col("id").alias("order_id"), F.lit("2024-01-01").cast("date").alias("data_ordine"))
    lines = spark.range(0, 90).select(
        (F.col("id") % 50).alias("order_id"), F.col("id").alias("line_num"), (F.col("id") % 7).alias("cod_prodotto"),
        F.lit(1).cast("bigint").alias("pos_id"), F.lit(1).alias("quantita"), F.lit("1.00").cast("decimal(10,2)").alias("importo_riga"))
    less = lines.filter("line_num <> 3")
    optimized = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    days = gold.touched_days(heads, heads, less, lines, ["order_id"], ["order_id", "line_num"])
    assert optimized(days).count("Join FullOuter") == 2 and days.count() == 1
    products = spark.range(0, 7).select(F.col("id").alias("cod_prodotto"), F.col("id").alias("sk_prodotto"), F.lit(True).alias("is_current"))
    stores = spark.range(0, 2).select(F.col("id").alias("pos_id"), F.col("id").alias("sk_punto_vendita"), F.lit(True).alias("is_current"))
    fact = gold.daily_sales_fact(lines, heads, products.filter("cod_prodotto <> 6"), stores).localCheckpoint()
    rekeyed = gold.rekeyed_days(fact, lines, heads, products, stores)
    assert optimized(rekeyed).count("Range (0, 50") == 1
    assert [r[0] for r in rekeyed.collect()] == [20240101]
    of_store = heads.withColumn("pos_id", F.lit(1).cast("bigint"))
    assert gold.rekeyed_days(fact, lines.drop("pos_id"), of_store, products, stores).count() == 1
    assert gold.rekeyed_days(fact, lines, heads, products.filter("cod_prodotto <> 6"), stores).count() == 0
