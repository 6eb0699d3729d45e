"""Synthetic columns and rows derived from the test tables' own rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from layerhouse.functions import formats, random_values as rv
from layerhouse.operators import synthetic as syn
from layerhouse.plans.catalogue.registry import query, table

SEED = 42


def u_sql(stream: str, row_id: str, lane: int = 0) -> str:
    name = f"{stream}-{lane // 2}" if lane // 2 else stream
    digits = f"substr(md5('{SEED}|{name}|' || CAST({row_id} AS VARCHAR)), {1 + 16 * (lane % 2)}, 13)"
    return f"((CAST('0x' || {digits} AS BIGINT) + CAST(0.5 AS DOUBLE)) / CAST({2**52} AS DOUBLE))"


def normal_sql(stream: str, row_id: str, mean: float, deviation: float) -> str:
    return (f"({mean} + {deviation} * sqrt(-2.0 * ln({u_sql(stream, row_id, 0)})) * "
            f"cos(2.0 * pi() * {u_sql(stream, row_id, 1)}))")


def weighted_sql(u: str, values, weights) -> str:
    total, running, arms = sum(weights), 0.0, []
    for value, weight in list(zip(values, weights))[:-1]:
        running += weight
        arms.append(f"WHEN {u} < CAST({running / total!r} AS DOUBLE) THEN {value!r}")
    return f"CASE {' '.join(arms)} ELSE {values[-1]!r} END"


def date_sql(u: str, first: str, last: str) -> str:
    return f"(DATE '{first}' + CAST(floor({u} * (DATE '{last}' - DATE '{first}' + 1)) AS INT))"


@query(f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {weighted_sql(
    u_sql('quantity', "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"),
    syn.QUANTITIES, syn.QUANTITY_WEIGHTS)} AS quantita FROM lineitem""")
def synth_weighted_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A weighted quantity for every line."""
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    row_id = F.concat_ws("-", *[F.col(c).cast("string") for c in columns])
    return table(spark, sf_dir, "lineitem").select(*columns, syn.quantity(SEED, row_id).alias("quantita"))


FIRST, LAST = "2023-01-01", "2024-12-31"
SEASON_SQL = "CASE month(first_draw) " + " ".join(f"WHEN {m} THEN CAST({c!r} AS DOUBLE)" for m, c in syn.SEASON.items()) + " END"


@query(f"""WITH drawn AS (SELECT o_orderkey, {date_sql(u_sql('day', 'o_orderkey', 0), FIRST, LAST)} AS first_draw,
  {u_sql('day', 'o_orderkey', 1)} AS test, {date_sql(u_sql('day', 'o_orderkey', 2), FIRST, LAST)} AS second_draw
  FROM orders)
SELECT o_orderkey, CASE WHEN test > {SEASON_SQL} THEN second_draw ELSE first_draw END AS data_ordine FROM drawn""")
def synth_seasonal_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = syn.seasonal_date(SEED, F.col("o_orderkey"), FIRST, LAST)
    return table(spark, sf_dir, "orders").select("o_orderkey", day.alias("data_ordine"))


@query(f"""SELECT 'TF' AS kind, c_custkey AS number,
  CASE WHEN {u_sql('card', 'c_custkey')} < 0.7 THEN 'TF-' || printf('%06d', c_custkey + 1) END AS code,
  {date_sql(u_sql('registered', 'c_custkey'), '2020-01-01', '2024-12-31')} AS day FROM customer
UNION ALL
SELECT 'P', p_partkey, 'P-' || printf('%05d', p_partkey + 1), NULL FROM part
UNION ALL
SELECT 'ORD', o_orderkey, 'ORD-' || printf('%07d', o_orderkey + 1), CAST(o_orderdate AS DATE) FROM orders
UNION ALL
SELECT 'IT', s_suppkey, 'IT-' || upper(substr(n_name, 1, 2)) || '-' ||
  printf('%03d', s_suppkey + 1),
  {date_sql(u_sql('opened', 's_suppkey'), '2015-01-01', '2022-06-30')}
FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def synth_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Business keys of customers (some without card), products, orders and stores."""
    card, part, order, store = F.col("c_custkey"), F.col("p_partkey"), F.col("o_orderkey"), F.col("s_suppkey")
    cards = table(spark, sf_dir, "customer").select(
        F.lit("TF").alias("kind"), card.alias("number"),
        rv.bernoulli(rv.uniform(SEED, "card", card), syn.LOYALTY_SHARE, formats.loyalty_card(card + 1)).alias("code"),
        rv.uniform_date(rv.uniform(SEED, "registered", card), "2020-01-01", "2024-12-31").alias("day"))
    products = table(spark, sf_dir, "part").select(
        F.lit("P").alias("kind"), part.alias("number"), formats.product_key(part + 1).alias("code"),
        F.lit(None).cast("date").alias("day"))
    orders = table(spark, sf_dir, "orders").select(
        F.lit("ORD").alias("kind"), order.alias("number"), formats.order_key(order + 1).alias("code"),
        F.col("o_orderdate").cast("date").alias("day"))
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    stores = table(spark, sf_dir, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.lit("IT").alias("kind"), store.alias("number"),
        formats.store_key(F.upper(F.substring("n_name", 1, 2)), store + 1).alias("code"),
        rv.uniform_date(rv.uniform(SEED, "opened", store), "2015-01-01", "2022-06-30").alias("day"))
    return cards.unionByName(products).unionByName(orders).unionByName(stores)


@query(f"""SELECT p_partkey, CAST(greatest(0.5, least(round({normal_sql('price', 'p_partkey', 8.5, 4.0)}, 2), 45.0))
  AS DECIMAL(10,2)) AS prezzo_unitario FROM part""")
def synth_clipped_normal(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = syn.unit_price(SEED, F.col("p_partkey"))
    return table(spark, sf_dir, "part").select("p_partkey", price.alias("prezzo_unitario"))


N_LINES_SQL = f"CAST(floor(greatest(1.0, least({normal_sql('lines', 'o_orderkey', 3.5, 1.5)}, 12.0))) AS INT)"


@query(f"SELECT o_orderkey, {N_LINES_SQL} AS n_lines FROM orders")
def synth_lines_per_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", syn.lines_per_order(SEED, F.col("o_orderkey")).alias("n_lines"))


REGIONS, SHARES = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"), (0.35, 0.22, 0.23, 0.15, 0.05)


@query(f"""WITH stores AS (
  SELECT s_suppkey, r_name, row_number() OVER (PARTITION BY r_name ORDER BY md5(CAST(s_suppkey AS VARCHAR)), s_suppkey) - 1 AS pos,
    count(*) OVER (PARTITION BY r_name) AS n
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
customers AS (
  SELECT c_custkey, row_number() OVER (ORDER BY md5(CAST(c_custkey AS VARCHAR)), c_custkey) - 1 AS pos,
    count(*) OVER () AS n FROM customer),
chosen AS (
  SELECT o_orderkey, {weighted_sql(u_sql('store', 'o_orderkey', 0), REGIONS, SHARES)} AS r_name,
    {u_sql('store', 'o_orderkey', 1)} AS us, {u_sql('customer', 'o_orderkey')} AS uc,
    lpad(CAST(CAST(floor({u_sql('time', 'o_orderkey', 0)} * 14) AS INT) + 8 AS VARCHAR), 2, '0') || ':' ||
    lpad(CAST(CAST(floor({u_sql('time', 'o_orderkey', 1)} * 60) AS INT) AS VARCHAR), 2, '0') || ':00' AS ora_ordine
  FROM orders)
SELECT o_orderkey, c.r_name, s_suppkey, c_custkey, ora_ordine FROM chosen c
JOIN stores s ON s.r_name = c.r_name AND s.pos = CAST(floor(us * s.n) AS BIGINT)
JOIN customers k ON k.pos = CAST(floor(uc * k.n) AS BIGINT)""")
def synth_order_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store by weighted region, uniform customer, and a time of day, for every order."""
    order = F.col("o_orderkey")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    stores = (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", "r_name")
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    heads = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        rv.weighted_choice(rv.uniform(SEED, "store", order, 0), REGIONS, SHARES).alias("r_name"),
        formats.time_of_day(
            rv.uniform_index(rv.uniform(SEED, "time", order, 0), 14) + 8,
            rv.uniform_index(rv.uniform(SEED, "time", order, 1), 60),
        ).alias("ora_ordine"),
    )
    placed = syn.pick_parent(heads, rv.uniform(SEED, "store", order, 1), stores, ["s_suppkey"], ["r_name"])
    return syn.pick_parent(placed, rv.uniform(SEED, "customer", order), customers, ["c_custkey"]).select(
        "o_orderkey", "r_name", "s_suppkey", "c_custkey", "ora_ordine")


SAMPLE_DRAWS = "[" + ", ".join(u_sql(f"sample-{i // 2}", "o_orderkey", i % 2) for i in range(12)) + "]"
SAMPLE_PICK = "CAST(floor(draws[step[1] - (n - k) + 1] * (step[1] + 1)) AS BIGINT)"


@query(f"""WITH products AS (
  SELECT p_partkey AS cod_prodotto, CAST(p_retailprice AS DECIMAL(10,2)) AS prezzo_unitario,
    row_number() OVER (ORDER BY md5(CAST(p_partkey AS VARCHAR)), p_partkey) - 1 AS pos FROM part),
wanted AS (
  SELECT o_orderkey AS order_id, least({N_LINES_SQL}, (SELECT count(*) FROM part)) AS k,
    (SELECT count(*) FROM part) AS n, {SAMPLE_DRAWS} AS draws FROM orders),
drawn AS (
  SELECT order_id, list_reduce(
    list_transform(range(n - k, n), lambda j: [j]),
    lambda taken, step: list_append(taken,
      CASE WHEN list_contains(taken, {SAMPLE_PICK}) THEN step[1] ELSE {SAMPLE_PICK} END),
    CAST([] AS BIGINT[])) AS picks FROM wanted),
slots AS (SELECT order_id, unnest(picks) AS pos, unnest(range(1, len(picks) + 1)) AS line_num FROM drawn),
priced AS (
  SELECT order_id, CAST(line_num AS INT) AS line_num, cod_prodotto,
    {weighted_sql(u_sql('quantity', "concat_ws('-', order_id, line_num)"), syn.QUANTITIES, syn.QUANTITY_WEIGHTS)}
      AS quantita, prezzo_unitario
  FROM slots JOIN products USING (pos))
SELECT *, CAST(quantita * prezzo_unitario AS DECIMAL(10,2)) AS importo_riga FROM priced""")
def synth_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with different products for every order of the orders table."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_id"))
    products = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("cod_prodotto"), F.col("p_retailprice").cast("decimal(10,2)").alias("prezzo_unitario"))
    return syn.order_lines(orders, "order_id", products, "cod_prodotto", "prezzo_unitario", SEED)
