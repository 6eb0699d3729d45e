"""A key that holds a third of all rows is split, and the results stay whole."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from layerhouse.operators import gold, quality, silver
from layerhouse.session import _bytes, adapt

# Sizes that make a small test look like a large skewed shuffle.
LOW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1",
}


@contextmanager
def low_thresholds(spark):
    old = {k: spark.conf.get(k, None) for k in LOW}
    for k, v in LOW.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def lines(spark, n=60000):
    """Order 0 and product 0 hold a third of the lines each."""
    return spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5000).alias("order_id"),
        F.col("id").alias("line_num"),
        F.when(F.col("id") % 3 == 1, F.lit(0)).otherwise(F.col("id") % 400).alias("cod_prodotto"),
        F.lit(1).alias("pos_id"), F.lit(1).alias("quantita"),
        F.lit("1.00").cast("decimal(10,2)").alias("importo_riga"),
    )


def test_fact_with_a_hot_order_and_product(spark):
    orders = spark.range(5000).select(F.col("id").alias("order_id"), F.lit("2024-01-01").cast("date").alias("data_ordine"))
    products = spark.range(400).select(F.col("id").alias("cod_prodotto"), F.col("id").alias("sk_prodotto"), F.lit(True).alias("is_current"))
    stores = spark.range(3).select(F.col("id").alias("pos_id"), F.col("id").alias("sk_punto_vendita"), F.lit(True).alias("is_current"))
    build = lambda: gold.daily_sales_fact(lines(spark), orders, products, stores)
    expected = sorted(map(tuple, build().collect()))
    with low_thresholds(spark):
        fact = build()
        got = sorted(map(tuple, fact.collect()))
        assert "isSkew=true" in final_plan(fact) or "skewed" in final_plan(fact)
    assert got == expected and sum(r[5] for r in got) == 60000


def test_dropped_lines_with_a_hot_product(spark):
    products = spark.range(1, 400).select(F.col("id").alias("cod_prodotto"), F.lit(True).alias("is_current"))
    stores = spark.range(3).select(F.col("id").alias("pos_id"), F.lit(True).alias("is_current"))
    orders = spark.range(5000).select(F.col("id").alias("order_id"), F.lit("2024-01-01").cast("date").alias("data_ordine"))
    with low_thresholds(spark):
        lost = gold.dropped_lines(lines(spark), orders, products, stores)
        assert lost.count() == lines(spark).filter("cod_prodotto = 0").count()


def test_many_copies_of_one_key(spark):
    """Every map task hands on one row of the key."""
    df = spark.range(0, 30000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    kept = silver.latest_per_key(df, ["k"], [F.col("v").desc()])
    assert kept.count() == 20001
    assert kept.filter("k = 0").first().v == 29997
    hot = quality.duplicate_groups(df, ["k"]).first()
    assert (hot.k, hot.n) == (0, 10000)


def test_tasks_take_little_of_a_merged_shuffle(spark):
    """The caller's size for merged partitions is lowered, and kept if it is smaller."""
    advisory, skewed = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"
    old = {k: spark.conf.get(k) for k in (advisory, skewed)}
    try:
        for given, kept in (("64MB", 16 << 20), ("1g", 16 << 20), ("8m", 8 << 20), ("20000", 20000)):
            spark.conf.set(advisory, given)
            spark.conf.set(skewed, "256MB")
            adapt(spark)
            assert _bytes(spark.conf.get(advisory)) == kept
            assert _bytes(spark.conf.get(skewed)) == 64 << 20
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
