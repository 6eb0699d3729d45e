"""Catalogue tables: batches that add up, replaced versions, schemas.

Each query works in a schema of its own, which it leaves with the rows it returns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from layerhouse.contracts import Contract, text_schema
from layerhouse.operators import silver
from layerhouse.plans.catalogue.registry import query, scratch_schema, table
from layerhouse.plans.catalogue.sales import FACT, fact_daily_sales
from layerhouse.session import work_dir
from layerhouse.sources import change_log, layout, tables
from layerhouse.streaming.incremental import follow_latest, typed_view


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_orderstatus AS stato, 'b1' AS _batch_id FROM orders
WHERE o_orderstatus <> 'P'
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), o_orderstatus, 'b2' FROM orders WHERE o_orderstatus = 'P'""")
def sink_append_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches, and the first once more: it replaces itself."""
    contract = Contract(f"{scratch_schema(spark)}.ordini_raw", "order_id STRING, stato STRING, _batch_id STRING",
                        partition_by=("_batch_id",), appended=True)
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_orderstatus").alias("stato"))
    for batch, which in (("b1", "stato <> 'P'"), ("b2", "stato = 'P'"), ("b1", "stato <> 'P'")):
        tables.append_batch(orders.filter(which).withColumn("_batch_id", F.lit(batch)), contract, batch)
    return spark.table(contract.name)


@query("""SELECT p_partkey AS sk, upper(p_name) AS nome FROM part WHERE p_size > 10""")
def sink_replace_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Created empty, filled, replaced; a version without a required value is not shown."""
    contract = Contract(f"{scratch_schema(spark)}.prodotti", "sk BIGINT NOT NULL, nome STRING NOT NULL", key=("sk",), surrogate="sk")
    tables.create_table(spark, contract)
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("sk"), F.col("p_name").alias("nome"), "p_size")
    tables.publish(part.select("sk", "nome"), contract, "v1")
    tables.publish(part.filter("p_size > 10").select("sk", F.upper("nome").alias("nome")), contract, "v2")
    broken = part.select("sk", F.nullif(F.col("nome"), F.col("nome")).alias("nome"))
    try:
        tables.publish(broken, contract, "v3")
    except tables.Rejected:
        pass
    tables.drop_old_versions(spark, contract)
    return spark.table(contract.name)


@query("""SELECT * FROM (VALUES ('ordini_raw', false), ('prodotti', true)) AS t(nome, replaced),
(SELECT count(*) AS n_orders FROM orders) AS o""")
def sink_schema_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A schema with one table of either kind, and how many orders the first holds."""
    schema = scratch_schema(spark)
    raw = Contract(f"{schema}.ordini_raw", "order_id STRING, _batch_id STRING", partition_by=("_batch_id",), appended=True)
    replaced = Contract(f"{schema}.prodotti", "sk BIGINT NOT NULL")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("order_id"), F.lit("b").alias("_batch_id"))
    tables.create_table(spark, replaced)
    tables.append_batch(orders, raw, "b")
    names = [t for t in tables.list_tables(spark, schema) if "__" not in t]
    rows = spark.table(raw.name).agg(F.count(F.lit(1)).alias("n_orders"))
    listed = rows.select(F.explode(F.array(*map(F.lit, names))).alias("nome"), "n_orders")
    return listed.select("nome", (F.col("nome") == "prodotti").alias("replaced"), "n_orders")


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_orderdate AS DATE) AS data_ordine, 'shown' AS dove FROM orders
WHERE o_orderkey % 97 <> 0 OR o_orderkey % 2 = 0
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), NULL, 'data_ordine' FROM orders WHERE o_orderkey % 97 = 0 AND o_orderkey % 2 = 1""")
def sink_quarantine_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some days of the first delivery cannot be read; the second repairs half of them. The rest waits, the table goes on."""
    contract = Contract(f"{scratch_schema(spark)}.ordini", "order_id STRING NOT NULL, data_ordine DATE NOT NULL", key=("order_id",))
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_orderdate").cast("date").cast("string").alias("data_ordine"))
    broken = orders.filter("k % 97 = 0").withColumn("data_ordine", F.concat(F.lit("?"), "data_ordine"))
    raw = orders.filter("k % 97 <> 0").unionByName(broken).withColumn("_batch_id", F.lit("b1"))
    order = [F.col("_batch_id").desc()]
    for version, rows in (("b1", raw), ("b2", raw.unionByName(orders.filter("k % 97 = 0 AND k % 2 = 0").withColumn("_batch_id", F.lit("b2"))))):
        typed = silver.dedup_and_type(rows, ["order_id"], {"data_ordine": "date"}, order, drop=("k",))
        tables.publish(typed, contract, version, quarantine=True)
    shown = spark.table(contract.name).withColumn("dove", F.lit("shown"))
    return shown.unionByName(tables.quarantined(spark, contract).select("order_id", "data_ordine", F.concat_ws(",", "missing").alias("dove")))


DAYS = """a AS (SELECT o_orderkey AS order_id, o_orderstatus AS stato, CAST(o_totalprice AS DECIMAL(12,2)) AS totale FROM orders WHERE o_orderkey % 5 <> 0),
b AS (SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 7 = 0 THEN 'R' ELSE o_orderstatus END AS stato, CAST(o_totalprice AS DECIMAL(12,2)) AS totale
  FROM orders WHERE o_orderkey % 3 <> 0),
c AS (SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 14 = 0 THEN 'X' WHEN o_orderkey % 7 = 0 THEN 'R' ELSE o_orderstatus END AS stato,
  CAST(o_totalprice AS DECIMAL(12,2)) AS totale FROM orders WHERE o_orderkey % 3 <> 1)"""


def _three_versions(spark: SparkSession, sf_dir: str) -> Contract:
    """Three versions of the orders in which rows come, change, go and come back; each is recorded, the last one twice."""
    contract = Contract(f"{scratch_schema(spark)}.ordini", "order_id BIGINT NOT NULL, stato STRING, totale DECIMAL(12,2)", key=("order_id",))
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("stato"), F.col("o_totalprice").cast("decimal(12,2)").alias("totale"))
    status = F.when(F.col("order_id") % 7 == 0, "R").otherwise(F.col("stato"))
    days = (orders.filter("order_id % 5 <> 0"), orders.filter("order_id % 3 <> 0").withColumn("stato", status),
            orders.filter("order_id % 3 <> 1").withColumn("stato", F.when(F.col("order_id") % 14 == 0, "X").otherwise(status)))
    for n, rows in enumerate(days):
        tables.publish(rows, contract, f"d{n}")
        change_log.record(spark, contract)
    change_log.record(spark, contract)
    return contract


def _feed_sql(number: int, old: str, new: str) -> str:
    differ = f"{old} JOIN {new} USING (order_id) WHERE ({old}.stato, {old}.totale) IS DISTINCT FROM ({new}.stato, {new}.totale)"
    return (
        f"SELECT {new}.*, 'insert' AS _change_type, {number} AS _number FROM {new} WHERE order_id NOT IN (SELECT order_id FROM {old}) "
        f"UNION ALL SELECT {old}.*, 'delete', {number} FROM {old} WHERE order_id NOT IN (SELECT order_id FROM {new}) "
        f"UNION ALL SELECT {old}.*, 'update_preimage', {number} FROM {differ} UNION ALL SELECT {new}.*, 'update_postimage', {number} FROM {differ}")


@query(f"WITH {DAYS} SELECT *, 'insert' AS _change_type, 1 AS _number FROM a UNION ALL {_feed_sql(2, 'a', 'b')} UNION ALL {_feed_sql(3, 'b', 'c')}")
def change_log_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes of three versions, kept for all of them."""
    contract = _three_versions(spark, sf_dir)
    return spark.table(change_log.log_of(contract).name).drop(change_log.VERSION)


@query(f"WITH {DAYS} SELECT 2 AS seen, * FROM b UNION ALL SELECT 3, * FROM c")
def change_log_as_recorded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second and the last version again, from the log alone."""
    contract = _three_versions(spark, sf_dir)
    second, last = change_log.as_recorded(spark, contract, 2), change_log.as_recorded(spark, contract)
    return second.select(F.lit(2).alias("seen"), "*").unionByName(last.select(F.lit(3).alias("seen"), "*"))


ORDER_TEXT = text_schema(("order_id", "stato", "totale", "letto"))


@query("""SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 7 = 0 THEN 'R' ELSE o_orderstatus END AS stato,
  CAST(o_totalprice AS DECIMAL(12,2)) AS totale, CASE WHEN o_orderkey % 7 = 0 THEN 3 ELSE 1 END AS letto FROM orders
WHERE o_orderkey % 11 <> 0 OR o_orderkey % 7 = 0""")
def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three drops of order files: one row in seven is read anew, an older reading of some comes last and changes nothing,
    one file comes again under another name. Totals that are no number wait outside the typed table."""
    schema, base = scratch_schema(spark), work_dir(spark, "stream")
    latest = Contract(f"{schema}.raw", "order_id STRING, stato STRING, totale STRING, letto STRING, _ingestion_ts TIMESTAMP, "
                      "_source_file STRING, _batch_id STRING")
    target = Contract(f"{schema}.ordini", "order_id BIGINT NOT NULL, stato STRING, totale DECIMAL(12,2) NOT NULL, letto INT")
    number = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_orderstatus").alias("stato"),
        F.when(F.col("o_orderkey") % 11 == 0, F.concat(F.lit("EUR "), number)).otherwise(number).alias("totale"))
    again = orders.filter("k % 7 = 0").withColumns({"stato": F.lit("R"), "totale": F.regexp_replace("totale", "EUR ", "")})
    drops = (orders.withColumn("letto", F.lit("1")), again.withColumn("letto", F.lit("3")),
             again.filter("k % 2 = 0").withColumns({"stato": F.lit("OLD"), "letto": F.lit("2")}).unionByName(again.withColumn("letto", F.lit("3"))))
    order = [F.col("letto").cast("int").desc(), F.col("stato").desc(), F.col("totale").desc()]
    for n, rows in enumerate(drops):
        rows.drop("k").coalesce(4).write.options(header=True).csv(f"{base}/landing/drop{n}")
        follow_latest(spark, f"{base}/landing/*", ORDER_TEXT, latest, ["order_id"], order, "ordini", f"{base}/checkpoint", "run",
                      "2024-06-01 06:00:00", buckets=16)
    typed_view(spark, latest, target, {"order_id": "BIGINT", "totale": "DECIMAL(12,2)", "letto": "INT"})
    return spark.table(target.name)


@query(f"WITH {FACT} SELECT * FROM fact WHERE sk_prodotto IN (4, 40, 400) OR sk_punto_vendita = 12")
def sink_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact in files along the interleaved bits of product and store: both filters skip files."""
    path = work_dir(spark, "fact")
    fact = fact_daily_sales(spark, sf_dir)
    layout.laid_out(fact, ["sk_prodotto", "sk_punto_vendita"], 32, ties=["sk_data"]).write.parquet(path)
    stored = spark.read.schema(fact.schema).parquet(path)
    return stored.filter(F.col("sk_prodotto").isin(4, 40, 400) | (F.col("sk_punto_vendita") == 12))
