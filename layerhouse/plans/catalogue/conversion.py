"""Raw to typed: text columns, audit columns, deduplication, casts, rejects, contracts, hashes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from layerhouse import contracts
from layerhouse.functions import money
from layerhouse.functions.hashing import hash_diff
from layerhouse.operators import bronze, keys, silver
from layerhouse.plans.catalogue.registry import query, table
from layerhouse.plans.catalogue.sales import LINE_KEY, RAW_LINES, latest_lines, line_order, raw_lines
from layerhouse.sources import landing
from layerhouse.session import work_dir

BATCH, BATCH_TS = "1a2b3c4d", "2024-06-01 06:00:00"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("cliente"),
        F.col("o_orderdate").cast("date").alias("data_ordine"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("totale"),
        F.col("o_orderpriority").alias("priorita"),
    )


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumn("_ingestion_ts", F.col("_ingestion_ts").cast("date"))


ORDERS_TEXT = """SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS cliente,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS data_ordine,
  CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS totale, o_orderpriority AS priorita"""

BRONZE_SQL = f"""{ORDERS_TEXT}, DATE '2024-06-01' AS _ingestion_ts, 'postgres-source/ordini' AS _source_file,
  '{BATCH}' AS _batch_id FROM orders"""


@query(BRONZE_SQL)
def bronze_stringify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(bronze.to_bronze(_orders(spark, sf_dir), "ordini", BATCH, BATCH_TS))


@query(BRONZE_SQL)
def csv_landing_to_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders as CSV with header, read back as text."""
    path = work_dir(spark, "orders-csv")
    orders = _orders(spark, sf_dir)
    landing.write_csv(orders, path)
    text = landing.read_csv(spark, path, contracts.text_schema(orders.columns))
    return _dated(bronze.to_bronze(text, "ordini", BATCH, BATCH_TS))


@query(r"""SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, nullif(c_mktsegment, 'HOUSEHOLD') AS segment,
  CASE WHEN c_acctbal < 0 THEN '' WHEN c_acctbal < 2000 THEN '\N'
    ELSE replace(c_name, '#', '\' || chr(9) || chr(10) || 't' || chr(13) || '\\n') END AS name FROM customer""")
def tsv_null_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    r"""Tab-separated text keeps NULL, the empty string and the text \N apart, and tabs and line breaks in place."""
    path = work_dir(spark, "customer-tsv")
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.nullif("c_mktsegment", F.lit("HOUSEHOLD")).alias("segment"),
        F.when(F.col("c_acctbal") < 0, "").when(F.col("c_acctbal") < 2000, r"\N")
        .otherwise(F.replace("c_name", F.lit("#"), F.lit("\\\t\nt\r\\\\n"))).alias("name"),
    )
    landing.write_tsv(customers, path)
    return landing.read_tsv(spark, path, customers.columns)


@query("""SELECT strftime(l_shipdate, '%Y-%m') AS _batch_id, count(*) AS n_rows FROM lineitem GROUP BY 1""")
def batch_row_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ship month stands for the batch."""
    lines = table(spark, sf_dir, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM").alias("_batch_id"))
    return bronze.batch_row_audit(lines)


LINE_ORDER_SQL = """_ingestion_ts DESC, cod_prodotto DESC, pos_id DESC, importo_riga DESC, quantita DESC"""
LINE_COLUMNS = "order_id, line_num, cod_prodotto, pos_id, quantita, importo_riga"


@query(f"""WITH {RAW_LINES} SELECT {LINE_COLUMNS}, CAST(_ingestion_ts AS DATE) AS _ingestion_ts FROM raw
QUALIFY row_number() OVER (PARTITION BY order_id, line_num ORDER BY {LINE_ORDER_SQL}) = 1""")
def dedup_latest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(latest_lines(spark, sf_dir))


@query("""SELECT user_id, event_id, event_type, CAST(value AS DECIMAL(12,2)) AS value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def dedup_latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    latest = silver.latest_per_key(events, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])
    return latest.select("user_id", "event_id", "event_type", F.col("value").cast("decimal(12,2)").alias("value"), "props")


@query("""WITH twice AS (
  SELECT c_custkey, c_name, CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal, c_mktsegment, 1 AS delivery FROM customer
  UNION ALL
  SELECT c_custkey, upper(c_name), CAST(c_acctbal AS DECIMAL(12,2)), c_mktsegment, 2 FROM customer WHERE c_acctbal >= 0)
SELECT c_custkey, c_name, c_acctbal, c_mktsegment, delivery FROM twice
QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY delivery DESC, c_name DESC) = 1""")
def dedup_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some customers are delivered twice, the second time with another name."""
    first = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.col("c_acctbal").cast("decimal(12,2)").alias("c_acctbal"), "c_mktsegment",
        F.lit(1).alias("delivery"))
    again = first.filter(F.col("c_acctbal") >= 0).withColumns({"c_name": F.upper("c_name"), "delivery": F.lit(2)})
    both = first.unionByName(again)
    return silver.latest_per_key(both, ["c_custkey"], [F.col("delivery").desc(), F.col("c_name").desc()])


@query(f"""WITH text AS ({ORDERS_TEXT} FROM orders)
SELECT order_id, CAST(cliente AS BIGINT) AS cliente, CAST(data_ordine AS DATE) AS data_ordine,
  CAST(totale AS DECIMAL(12,2)) AS totale, priorita FROM text""")
def silver_typed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bronze.to_bronze(_orders(spark, sf_dir), "ordini", BATCH, BATCH_TS)
    types = {"cliente": "bigint", "data_ordine": "date", "totale": "decimal(12,2)"}
    order = [F.col("_ingestion_ts").desc(), F.col("data_ordine").desc(), F.col("totale").desc()]
    typed = silver.dedup_and_type(raw, ["order_id"], types, order)
    return typed.drop("_ingestion_ts", "_batch_id")


@query(f"""WITH {RAW_LINES}, latest AS (SELECT * FROM raw
  QUALIFY row_number() OVER (PARTITION BY order_id, line_num ORDER BY {LINE_ORDER_SQL}) = 1)
SELECT CAST(order_id AS VARCHAR) AS order_id, line_num, CAST(cod_prodotto AS VARCHAR) AS cod_prodotto,
  CAST(pos_id AS VARCHAR) AS pos_id, quantita, importo_riga FROM latest""")
def silver_typed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as raw text with their load time, then one typed row per key."""
    lines = raw_lines(spark, sf_dir)
    text = bronze.stringify(lines.drop("_ingestion_ts"))
    raw = lines.select(*[F.col(c).cast("string").alias(c) for c in text.columns], "_ingestion_ts",
                       F.lit("postgres-source/vendite").alias("_source_file"))
    types = {"line_num": "int", "quantita": "int", "importo_riga": "decimal(10,2)"}
    numbers = {"cod_prodotto": "bigint", "pos_id": "bigint", "importo_riga": "decimal(10,2)", "quantita": "int"}
    order = [F.col("_ingestion_ts").desc()] + [F.col(c).cast(t).desc() for c, t in numbers.items()]
    return silver.dedup_and_type(raw, LINE_KEY, types, order).drop("_ingestion_ts")


BROKEN_SQL = """broken AS (
  SELECT o_orderkey AS order_id,
    CASE WHEN o_orderpriority = '5-LOW' THEN strftime(o_orderdate, '%Y') || '-13-45'
         ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS data_ordine,
    CASE WHEN o_orderstatus = 'P' THEN 'n/a' WHEN o_orderstatus = 'F' THEN NULL
         ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS totale FROM orders)"""


@query(f"""WITH {BROKEN_SQL}
SELECT order_id, 'data_ordine' AS column_name, 'date' AS target_type, data_ordine AS raw_value FROM broken
WHERE data_ordine IS NOT NULL AND try_cast(data_ordine AS DATE) IS NULL
UNION ALL
SELECT order_id, 'totale', 'decimal(12,2)', totale FROM broken
WHERE totale IS NOT NULL AND try_cast(totale AS DECIMAL(12,2)) IS NULL""")
def cast_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.cast_rejects(_broken(spark, sf_dir), ["order_id"], {"data_ordine": "date", "totale": "decimal(12,2)"})


@query(f"""WITH {BROKEN_SQL} SELECT order_id, try_cast(data_ordine AS DATE) AS data_ordine,
  try_cast(totale AS DECIMAL(12,2)) AS totale FROM broken""")
def cast_malformed_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.apply_types(_broken(spark, sf_dir), {"data_ordine": "date", "totale": "decimal(12,2)"})


def _broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates without such a month for low priorities, amounts as words or NULL by status."""
    day = F.col("o_orderdate").cast("date")
    amount = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.concat(F.year(day).cast("string"), F.lit("-13-45")))
        .otherwise(day.cast("string")).alias("data_ordine"),
        F.when(status == "P", "n/a").when(status == "F", F.lit(None)).otherwise(amount).alias("totale"),
    )


@query("""SELECT p_partkey + 1 AS sk_prodotto, CAST(p_partkey AS VARCHAR) AS cod_prodotto, p_name AS nome,
  p_type AS categoria, CAST(p_retailprice AS DECIMAL(10,2)) AS prezzo_unitario, CAST(NULL AS INT) AS iva_perc FROM part""")
def contract_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts brought to the published product contract; the tax rate is not delivered."""
    part = table(spark, sf_dir, "part").select(
        F.col("p_retailprice").alias("prezzo_unitario"), F.col("p_name").alias("nome"),
        F.col("p_type").alias("categoria"), F.col("p_partkey").alias("cod_prodotto"),
        (F.col("p_partkey") + 1).alias("sk_prodotto"), "p_brand",
    )
    return contracts.conform(part, contracts.GOLD_PRODUCT)


@query("""SELECT p_partkey,
  sha256(concat_ws('||', p_name, nullif(p_brand, 'Brand#7'), CAST(p_size AS VARCHAR))) AS hash FROM part""", name="hash_diff")
def hash_diff_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hashed(spark, sf_dir, null_safe=False)


@query("""SELECT p_partkey, sha256(concat_ws('||',
  coalesce(CAST(length(p_name) AS VARCHAR) || ':' || p_name, '-'),
  coalesce(CAST(length(nullif(p_brand, 'Brand#7')) AS VARCHAR) || ':' || nullif(p_brand, 'Brand#7'), '-'),
  coalesce(CAST(length(CAST(p_size AS VARCHAR)) AS VARCHAR) || ':' || CAST(p_size AS VARCHAR), '-'))) AS hash
FROM part""")
def hash_diff_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hashed(spark, sf_dir, null_safe=True)


def _hashed(spark, sf_dir, null_safe):
    columns = (F.col("p_name"), F.nullif("p_brand", F.lit("Brand#7")), F.col("p_size"))
    return table(spark, sf_dir, "part").select("p_partkey", hash_diff(*columns, null_safe=null_safe).alias("hash"))


@query("""SELECT p_partkey, p_name, 1000 + row_number() OVER (ORDER BY md5(CAST(p_partkey AS VARCHAR)), p_partkey)
  AS sk_prodotto FROM part""")
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return keys.dense_keys(part, ["p_partkey"], "sk_prodotto", after=1000)


@query("""WITH d AS (SELECT c_custkey, md5(CAST(c_custkey AS VARCHAR)) AS digest FROM customer),
b AS (SELECT *, CAST('0x' || substr(digest, 1, 3) AS BIGINT) AS bucket FROM d)
SELECT c_custkey, (row_number() OVER (PARTITION BY bucket ORDER BY digest, c_custkey) - 1) * 4096 + bucket + 1
  AS sk_cliente FROM b""")
def surrogate_keys_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    return keys.strided_keys(customers, ["c_custkey"], "sk_cliente")


@query("""WITH d AS (SELECT c_custkey, c_acctbal >= 0 AS early, md5(CAST(c_custkey AS VARCHAR)) AS digest FROM customer),
b AS (SELECT *, CAST('0x' || substr(digest, 1, 3) AS BIGINT) AS bucket FROM d),
first AS (SELECT c_custkey, (row_number() OVER (PARTITION BY bucket ORDER BY digest, c_custkey) - 1) * 4096 + bucket + 1
  AS sk_cliente FROM b WHERE early)
SELECT c_custkey, sk_cliente FROM first
UNION ALL
SELECT c_custkey, (SELECT max(sk_cliente) FROM first)
  + (row_number() OVER (PARTITION BY bucket ORDER BY digest, c_custkey) - 1) * 4096 + bucket + 1 FROM b WHERE NOT early""")
def surrogate_keys_second_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in credit were numbered before and keep their keys; the others follow."""
    customers = table(spark, sf_dir, "customer")
    first = keys.strided_keys(customers.filter(F.col("c_acctbal") >= 0).select("c_custkey"), ["c_custkey"], "sk_cliente")
    return keys.keep_keys(
        customers.select("c_custkey"), first, ["c_custkey"], "sk_cliente", keys.largest(first, "sk_cliente"))


@query("""WITH rated AS (SELECT p_partkey, p_type, CAST(p_retailprice AS DECIMAL(12,2)) AS price,
  CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN 22 WHEN p_type = 'LARGE' THEN 10 ELSE 4 END AS iva_perc FROM part)
SELECT p_partkey, p_type, iva_perc,
  CAST(((CAST(price * 100 AS BIGINT) * 200 + 100 + iva_perc) // (2 * (100 + iva_perc))) / 100 AS DECIMAL(12,2))
  AS net_price FROM rated""")
def tax_rate_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tax rate by category, and the price without it."""
    rate = money.lookup_rate(F.col("p_type"), {"ECONOMY": 22, "PROMO": 22, "LARGE": 10}, 4)
    price = F.col("p_retailprice").cast("decimal(12,2)")
    return table(spark, sf_dir, "part").select(
        "p_partkey", "p_type", rate.alias("iva_perc"),
        money.net_amount(price, money.tax_divisor(rate)).alias("net_price"),
    )


@query("""SELECT c_custkey, CASE WHEN c_nationkey % 5 <> 0 THEN c_nationkey END AS c_nationkey,
  row_number() OVER (PARTITION BY CASE WHEN c_nationkey % 5 <> 0 THEN c_nationkey END
    ORDER BY md5(CAST(c_custkey AS VARCHAR)), c_custkey) - 1 AS position FROM customer""")
def dense_position_null_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without a nation are a group like others."""
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_nationkey") % 5 != 0, F.col("c_nationkey")).alias("c_nationkey"))
    return keys.dense_position(customers, ["c_custkey"], "position", ["c_nationkey"])
