"""Sales fact over orders, lineitem, part and supplier.

The tables play the retail roles: orders are order heads, lineitem is the raw line table with
repeated keys (its ship date is the load time), part is the product, supplier the store.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from layerhouse.contracts import FACT_DAILY_SALES
from layerhouse.functions.dates import date_key, month_start
from layerhouse.operators import distinct, gold, keys, silver
from layerhouse.plans.catalogue.registry import query, scratch_schema, table
from layerhouse.session import work_dir
from layerhouse.sources import patched, tables

LINE_KEY = ("order_id", "line_num")


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_num"),
        F.col("l_partkey").alias("cod_prodotto"),
        F.col("l_suppkey").alias("pos_id"),
        F.col("l_quantity").cast("int").alias("quantita"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("importo_riga"),
        F.col("l_shipdate").alias("_ingestion_ts"),
    )


def line_order() -> list:
    return [F.col(c).desc() for c in ("_ingestion_ts", "cod_prodotto", "pos_id", "importo_riga", "quantita")]


def latest_lines(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    raw = raw_lines(spark, sf_dir)
    return silver.latest_per_key(raw if orders is None else gold.lines_of(raw, orders), LINE_KEY, line_order())


def order_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").cast("date").alias("data_ordine")
    )


def _versions(closed_too: Column) -> Column:
    flags = F.when(closed_too, F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True)))
    return F.explode(flags).alias("is_current")


def product_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A current version of every part, and a closed one of the large ones."""
    versions = table(spark, sf_dir, "part").select("p_partkey", _versions(F.col("p_size") > 25))
    return versions.select(
        (F.col("p_partkey") * 2 + F.when(F.col("is_current"), 2).otherwise(1)).alias("sk_prodotto"),
        F.col("p_partkey").alias("cod_prodotto"), "is_current",
    )


def store_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = table(spark, sf_dir, "supplier").select("s_suppkey", _versions(F.col("s_acctbal") < 0))
    return versions.select(
        (F.col("s_suppkey") * 2 + F.when(F.col("is_current"), 2).otherwise(1)).alias("sk_punto_vendita"),
        F.col("s_suppkey").alias("pos_id"), "is_current",
    )


RAW_LINES = """raw AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_num, l_partkey AS cod_prodotto, l_suppkey AS pos_id,
         CAST(l_quantity AS INT) AS quantita, CAST(l_extendedprice AS DECIMAL(10,2)) AS importo_riga,
         l_shipdate AS _ingestion_ts
  FROM lineitem)"""

LATEST_LINES = RAW_LINES + """, latest AS (
  SELECT * FROM raw
  QUALIFY row_number() OVER (PARTITION BY order_id, line_num ORDER BY _ingestion_ts DESC, cod_prodotto DESC,
                             pos_id DESC, importo_riga DESC, quantita DESC) = 1)"""

DIMS = """product_dim AS (
  SELECT 2 * p_partkey + 2 AS sk_prodotto, p_partkey AS cod_prodotto, true AS is_current FROM part
  UNION ALL SELECT 2 * p_partkey + 1, p_partkey, false FROM part WHERE p_size > 25),
store_dim AS (
  SELECT 2 * s_suppkey + 2 AS sk_punto_vendita, s_suppkey AS pos_id, true AS is_current FROM supplier
  UNION ALL SELECT 2 * s_suppkey + 1, s_suppkey, false FROM supplier WHERE s_acctbal < 0)"""

FACT = LATEST_LINES + ", " + DIMS + """, sums AS (
  SELECT CAST(strftime(o.o_orderdate, '%Y%m%d') AS INT) AS sk_data, p.sk_prodotto, s.sk_punto_vendita,
         CAST(count(DISTINCT l.order_id) AS INT) AS n_transazioni, CAST(sum(l.quantita) AS INT) AS quantita_totale,
         CAST(sum(l.importo_riga) AS DECIMAL(12,2)) AS importo_lordo
  FROM latest l JOIN orders o ON l.order_id = o.o_orderkey
  JOIN product_dim p ON p.cod_prodotto = l.cod_prodotto AND p.is_current
  JOIN store_dim s ON s.pos_id = l.pos_id AND s.is_current
  GROUP BY 1, 2, 3), fact AS (
  SELECT sk_data, sk_prodotto, sk_punto_vendita, CAST(NULL AS BIGINT) AS sk_cliente, n_transazioni,
         quantita_totale, importo_lordo, CAST(round(importo_lordo / 1.10, 2) AS DECIMAL(12,2)) AS importo_netto,
         CAST(0 AS DECIMAL(12,2)) AS sconto_totale FROM sums)"""


@query(f"WITH {FACT} SELECT * FROM fact")
def fact_daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.daily_sales_fact(
        latest_lines(spark, sf_dir), order_heads(spark, sf_dir),
        product_dim(spark, sf_dir), store_dim(spark, sf_dir),
    )


@query(f"WITH {FACT} SELECT * FROM fact WHERE sk_data BETWEEN 19970101 AND 19971231")
def fact_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The date range reaches the scan of the orders, and their raw lines before these are sorted out."""
    orders = gold.orders_between(order_heads(spark, sf_dir), ("1997-01-01", "1997-12-31"))
    return gold.daily_sales_fact(
        latest_lines(spark, sf_dir, orders), orders, product_dim(spark, sf_dir), store_dim(spark, sf_dir))


@query(f"WITH {FACT} SELECT * FROM fact WHERE sk_data BETWEEN 19970101 AND 19971231")
def fact_partition_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole fact written by day, then one year read back: only its directories are opened."""
    path = work_dir(spark, "fact")
    fact = fact_daily_sales(spark, sf_dir)
    tables.clustered(fact, FACT_DAILY_SALES).write.partitionBy(*FACT_DAILY_SALES.partition_by).parquet(path)
    stored = spark.read.schema(fact.schema).parquet(path)
    return stored.filter(F.col("sk_data").between(19970101, 19971231)).select(*fact.columns)


PRODUCT_STARTS = ("1992-03-01", "1994-07-15", "1996-02-29")


def product_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One to three versions of each part; some begin late, some end early, some days lie in a gap."""
    part = table(spark, sf_dir, "part").withColumn("kind", F.col("p_partkey") % 5)
    bound = lambda day: F.lit(day).cast("timestamp")
    a, b, c = map(bound, PRODUCT_STARTS)
    open_ = F.lit(None).cast("timestamp")
    spans = lambda *pairs: F.array(*[F.struct(F.lit(i).alias("v"), x.alias("valid_from"), y.alias("valid_to")) for i, (x, y) in enumerate(pairs)])
    versions = (
        F.when(F.col("kind") == 0, spans((a, b), (b, c), (c, open_)))
        .when(F.col("kind") == 1, spans((b, open_)))
        .when(F.col("kind") == 2, spans((a, b), (c, open_)))
        .when(F.col("kind") == 3, spans((a, c)))
        .otherwise(spans((a, open_)))
    )
    rows = part.select("p_partkey", F.explode(versions).alias("s"))
    return rows.select(
        (F.col("p_partkey") * 4 + F.col("s.v") + 1).alias("sk_prodotto"), F.col("p_partkey").alias("cod_prodotto"),
        "s.valid_from", "s.valid_to", F.col("s.valid_to").isNull().alias("is_current"))


def store_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indebted stores have moved in the middle of a year, at noon: the day itself still belongs to the old place."""
    flags = F.when(F.col("s_acctbal") < 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal", F.explode(flags).alias("v"))
    moved = F.lit("1995-06-17 12:00:00").cast("timestamp")
    first = F.lit("1900-01-01").cast("timestamp")
    return rows.select(
        (F.col("s_suppkey") * 2 + F.col("v") + 1).alias("sk_punto_vendita"), F.col("s_suppkey").alias("pos_id"),
        F.when((F.col("s_acctbal") < 0) & (F.col("v") == 1), moved).otherwise(first).alias("valid_from"),
        F.when(F.col("v") == 0, moved).alias("valid_to"), (F.col("v") == 1).alias("is_current"))


VERSIONS = f"""product_versions AS (
  SELECT 4 * p_partkey + v + 1 AS sk_prodotto, p_partkey AS cod_prodotto, valid_from, valid_to FROM part JOIN (
    VALUES (0, 0, DATE '{PRODUCT_STARTS[0]}', DATE '{PRODUCT_STARTS[1]}'), (0, 1, DATE '{PRODUCT_STARTS[1]}', DATE '{PRODUCT_STARTS[2]}'),
      (0, 2, DATE '{PRODUCT_STARTS[2]}', NULL), (1, 0, DATE '{PRODUCT_STARTS[1]}', NULL),
      (2, 0, DATE '{PRODUCT_STARTS[0]}', DATE '{PRODUCT_STARTS[1]}'), (2, 1, DATE '{PRODUCT_STARTS[2]}', NULL),
      (3, 0, DATE '{PRODUCT_STARTS[0]}', DATE '{PRODUCT_STARTS[2]}'), (4, 0, DATE '{PRODUCT_STARTS[0]}', NULL)
    ) k(kind, v, valid_from, valid_to) ON kind = p_partkey % 5),
store_versions AS (
  SELECT 2 * s_suppkey + 2 AS sk_punto_vendita, s_suppkey AS pos_id,
    CASE WHEN s_acctbal < 0 THEN TIMESTAMP '1995-06-17 12:00:00' ELSE TIMESTAMP '1900-01-01' END AS valid_from,
    CAST(NULL AS TIMESTAMP) AS valid_to FROM supplier
  UNION ALL SELECT 2 * s_suppkey + 1, s_suppkey, TIMESTAMP '1900-01-01', TIMESTAMP '1995-06-17 12:00:00' FROM supplier
  WHERE s_acctbal < 0)"""

SUMS_OF_DAY = LATEST_LINES + ", " + VERSIONS + """, heads AS (
  SELECT o_orderkey AS order_id, CAST(nullif(o_orderdate, DATE '1996-02-29') AS DATE) AS day FROM orders),
sums AS (
  SELECT h.day, CASE WHEN l.cod_prodotto % 50 <> 0 THEN l.cod_prodotto END AS cod_prodotto, l.pos_id,
    count(DISTINCT l.order_id) AS n, sum(l.quantita) AS q, sum(l.importo_riga) AS amount
  FROM latest l JOIN heads h USING (order_id) GROUP BY ALL)"""


def _sales_with_faults(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Lines of which a fiftieth has no product, and order heads of which those of one day have lost it."""
    lines = latest_lines(spark, sf_dir)
    product = F.when(F.col("cod_prodotto") % 50 != 0, F.col("cod_prodotto"))
    heads = order_heads(spark, sf_dir)
    return lines.withColumn("cod_prodotto", product), heads.withColumn(
        "data_ordine", F.nullif("data_ordine", F.lit("1996-02-29").cast("date")))


@query(f"""WITH {SUMS_OF_DAY}
SELECT CAST(strftime(s.day, '%Y%m%d') AS INT) AS sk_data, p.sk_prodotto, t.sk_punto_vendita, CAST(NULL AS BIGINT) AS sk_cliente,
  CAST(n AS INT) AS n_transazioni, CAST(q AS INT) AS quantita_totale, CAST(amount AS DECIMAL(12,2)) AS importo_lordo,
  CAST(round(CAST(amount AS DECIMAL(12,2)) / 1.10, 2) AS DECIMAL(12,2)) AS importo_netto,
  CAST(0 AS DECIMAL(12,2)) AS sconto_totale
FROM sums s
JOIN product_versions p ON p.cod_prodotto = s.cod_prodotto AND s.day >= p.valid_from AND (p.valid_to IS NULL OR s.day < p.valid_to)
JOIN store_versions t ON t.pos_id = s.pos_id AND s.day >= t.valid_from AND (t.valid_to IS NULL OR s.day < t.valid_to)""")
def fact_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact by the versions of each day."""
    return gold.daily_sales_fact_as_of(
        *_sales_with_faults(spark, sf_dir), product_versions(spark, sf_dir), store_versions(spark, sf_dir))


@query(f"""WITH {SUMS_OF_DAY}, placed AS (
  SELECT s.*, p.sk_prodotto, t.sk_punto_vendita FROM sums s
  LEFT JOIN product_versions p ON p.cod_prodotto = s.cod_prodotto AND s.day >= p.valid_from AND (p.valid_to IS NULL OR s.day < p.valid_to)
  LEFT JOIN store_versions t ON t.pos_id = s.pos_id AND s.day >= t.valid_from AND (t.valid_to IS NULL OR s.day < t.valid_to))
SELECT day AS data_ordine, cod_prodotto, pos_id, n AS n_transazioni, CAST(q AS BIGINT) AS quantita_totale,
  CAST(amount AS DECIMAL(20,2)) AS importo_lordo, missing FROM (
    SELECT *, 'day' AS missing FROM placed WHERE day IS NULL
    UNION ALL SELECT *, 'product' FROM placed WHERE day IS NOT NULL AND sk_prodotto IS NULL
    UNION ALL SELECT *, 'store' FROM placed WHERE day IS NOT NULL AND sk_punto_vendita IS NULL) u""")
def fact_as_of_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums that no version of their day takes: no product, no day, before the first version, in a gap, after the end."""
    return gold.dropped_as_of(
        *_sales_with_faults(spark, sf_dir), product_versions(spark, sf_dir), store_versions(spark, sf_dir))


@query(f"""WITH {LATEST_LINES}
SELECT date_trunc('month', o.o_orderdate)::DATE AS mese, p.p_type AS categoria, count(DISTINCT l.order_id) AS n_transazioni
FROM latest l JOIN orders o ON l.order_id = o.o_orderkey JOIN part p ON p.p_partkey = l.cod_prodotto
GROUP BY 1, 2""")
def fact_rollup_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct orders by month and category from the sets kept at the fact's grain: an order in two of its rows counts once."""
    state = _order_sets(spark, sf_dir)
    category = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("cod_prodotto"), F.col("p_type").alias("categoria"))
    rows = state.withColumn("mese", month_start(F.col("data_ordine"))).join(category, "cod_prodotto")
    return distinct.distinct_counts(rows, ["mese", "categoria"], "n_transazioni")


def _order_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads = keys.dense_position(order_heads(spark, sf_dir), ["order_id"], "posto")
    lines = latest_lines(spark, sf_dir).join(heads, "order_id")
    return distinct.distinct_state(lines, ["data_ordine", "cod_prodotto", "pos_id"], "posto")


@query(f"""WITH {LATEST_LINES}
SELECT year(o.o_orderdate) AS anno, count(DISTINCT l.order_id) AS n_transazioni
FROM latest l JOIN orders o ON l.order_id = o.o_orderkey GROUP BY 1""")
def fact_rollup_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two steps: the sets of the days are merged to months and stores, those to years."""
    state = _order_sets(spark, sf_dir).withColumn("mese", month_start(F.col("data_ordine")))
    months = distinct.merge_states(state, ["mese", "pos_id"])
    return distinct.distinct_counts(months, [F.year("mese").cast("bigint").alias("anno")], "n_transazioni")


def _kept(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written once, for steps that read them several times."""
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@query(f"WITH {FACT} SELECT * FROM fact")
def fact_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first delivery lacks some orders and the lines of the last months, one order stands on another day and a product
    has no current version; after the second, only the months it touches are written again."""
    contract = replace(FACT_DAILY_SALES, name=f"{scratch_schema(spark)}.fact", partition_by=())
    part = F.floor(F.col("sk_data") / 100)
    orders = order_heads(spark, sf_dir)
    first_orders = orders.filter("order_id % 1000 <> 3").withColumn(
        "data_ordine", F.when(F.col("order_id") % 1000 == 5, F.date_add("data_ordine", -40)).otherwise(F.col("data_ordine")))
    raw, lines = raw_lines(spark, sf_dir), _kept(latest_lines(spark, sf_dir), "lines")
    first_lines = _kept(silver.latest_per_key(raw.filter("_ingestion_ts <= DATE '1998-03-01'"), LINE_KEY, line_order()), "first_lines")
    products, stores = product_dim(spark, sf_dir), store_dim(spark, sf_dir)
    first_products = products.filter("cod_prodotto <> 7")
    patched.commit(gold.daily_sales_fact(first_lines, first_orders, first_products, stores), contract, part, "first")

    days = gold.touched_days(first_orders, orders, first_lines, lines, ["order_id"], LINE_KEY).select(
        date_key(F.col("data_ordine")).alias("sk_data"))
    rekeyed = gold.rekeyed_days(spark.table(contract.name), lines, orders, products, stores)
    months = sorted(str(r[0]) for r in days.unionByName(rekeyed).select(part).distinct().collect())
    again = orders.filter(F.floor(date_key(F.col("data_ordine")) / 100).cast("string").isin(months))
    fact = gold.daily_sales_fact(latest_lines(spark, sf_dir, again), again, products, stores)
    patched.commit(fact, contract, part, "second", months)
    return spark.table(contract.name)


LOST = "SELECT order_id, line_num, cod_prodotto, pos_id, quantita, importo_riga"


@query(f"""WITH {LATEST_LINES}, heads AS (
  SELECT o_orderkey AS order_id, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS day FROM orders
  WHERE o_orderstatus <> 'P')
{LOST}, 'product' AS missing FROM latest WHERE cod_prodotto NOT IN (SELECT p_partkey FROM part WHERE p_type <> 'PROMO')
UNION ALL
{LOST}, 'store' FROM latest WHERE pos_id NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)
UNION ALL
{LOST}, 'order' FROM latest WHERE order_id NOT IN (SELECT order_id FROM heads)
UNION ALL
{LOST}, 'day' FROM latest WHERE order_id IN (SELECT order_id FROM heads WHERE day IS NULL)""")
def fact_dropped_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Promotional parts and indebted suppliers have no current version here, some orders no head, some no day."""
    products = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("cod_prodotto"), (F.col("p_type") != "PROMO").alias("is_current"))
    stores = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("pos_id"), (F.col("s_acctbal") >= 0).alias("is_current"))
    heads = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "P").select(
        F.col("o_orderkey").alias("order_id"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate").cast("date")).alias("data_ordine"))
    lines = latest_lines(spark, sf_dir).drop("_ingestion_ts")
    return gold.dropped_lines(lines, heads, products, stores)


@query("""SELECT o_orderkey AS order_id, CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS sk_data FROM orders""")
def date_smart_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_heads(spark, sf_dir).select("order_id", date_key(F.col("data_ordine")).alias("sk_data"))


@query("""SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n_orders
FROM orders GROUP BY 1 ORDER BY 1""")
def monthly_order_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        order_heads(spark, sf_dir)
        .groupBy(month_start(F.col("data_ordine")).alias("month"))
        .agg(F.count(F.lit(1)).alias("n_orders"))
        .orderBy("month")
    )
