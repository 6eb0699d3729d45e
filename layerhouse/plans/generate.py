"""Synthetic source files: stores, products, customers, orders, order lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from layerhouse.contracts import SOURCE_COLUMNS
from layerhouse.functions import formats, money, random_values as rv
from layerhouse.operators import synthetic as syn
from layerhouse.sources.landing import write_csv

# The days that orders are drawn from.
FIRST_DAY, LAST_DAY = "2023-01-01", "2024-12-31"


def stores(spark: SparkSession, seed: int = 42) -> DataFrame:
    """The stores of the fixed clusters, in cluster order; the region is drawn from the cluster's."""
    number = F.col("id") + 1
    last, bounds = 0, []
    for cluster in syn.CLUSTERS:
        last += cluster.stores
        bounds.append((cluster, last))
    u = rv.uniform(seed, "region", number)
    cluster, region = F.lit(None).cast("string"), F.lit(None).cast("string")
    for (name, _, _, regions), upper in reversed(bounds):
        cluster = F.when(number <= upper, F.lit(name)).otherwise(cluster)
        drawn = rv.weighted_choice(u, regions, [1.0] * len(regions))
        region = F.when(number <= upper, drawn).otherwise(region)
    label = F.lpad(number.cast("string"), 3, "0")
    rows = spark.range(last).select(
        number.alias("number"), cluster.alias("cluster"), region.alias("regione"),
        F.concat(F.lit("Negozio "), label).alias("nome"),
        F.concat(F.lit("Via "), label, F.lit(", "), region).alias("indirizzo"),
        F.concat(F.lit("Responsabile "), label).alias("manager"),
        F.concat(F.lit("+39 02 "), F.lpad(number.cast("string"), 7, "0")).alias("telefono"),
        rv.uniform_date(rv.uniform(seed, "opened", number), "2015-01-01", "2022-06-30").alias("data_apertura"),
    )
    return rows.withColumn("pos_id", formats.store_key(F.col("regione"), F.col("number")))


def products(spark: SparkSession, n: int = 500, seed: int = 42) -> DataFrame:
    """Products in runs by category, whose numbers differ by one at most."""
    number = F.col("id") + 1
    slot = F.floor(F.col("id") * len(syn.CATEGORIES) / n).cast("int")
    category = F.element_at(F.array(*[F.lit(c) for c in syn.CATEGORIES]), slot + 1)
    return spark.range(n).select(
        formats.product_key(number).alias("cod_prodotto"),
        F.concat(F.lit("Articolo "), number.cast("string"), F.lit(" "), category).alias("nome"),
        category.alias("categoria"),
        syn.unit_price(seed, number).alias("prezzo_unitario"),
        money.lookup_rate(category, money.TAX_RATE_BY_CATEGORY, money.TAX_RATE_DEFAULT).alias("iva_perc"),
    )


def customers(spark: SparkSession, n: int = 10_000, seed: int = 42) -> DataFrame:
    number = F.col("id") + 1
    text = number.cast("string")
    places = F.array(*[F.struct(F.lit(city).alias("citta"), F.lit(code).alias("provincia")) for city, code in syn.CITIES])
    place = places[rv.uniform_index(rv.uniform(seed, "city", number), len(syn.CITIES)).cast("int")]
    return spark.range(n).select(
        formats.padded("CF", number, 14).alias("codice_fiscale"),
        F.concat(F.lit("Nome"), text).alias("nome"),
        F.concat(F.lit("Cognome"), text).alias("cognome"),
        F.concat(F.lit("cliente"), text, F.lit("@example.com")).alias("email"),
        F.concat(F.lit("+39 333 "), F.lpad(text, 7, "0")).alias("telefono"),
        place["citta"].alias("citta"),
        place["provincia"].alias("provincia"),
        rv.bernoulli(rv.uniform(seed, "card", number), syn.LOYALTY_SHARE, formats.loyalty_card(number))
        .alias("tessera_fedelta"),
        rv.uniform_date(rv.uniform(seed, "registered", number), "2020-01-01", LAST_DAY).alias("data_registrazione"),
    )


def orders(spark: SparkSession, store_rows: DataFrame, customer_rows: DataFrame, n: int = 100_000,
           seed: int = 42) -> DataFrame:
    number = F.col("number")
    base = spark.range(n).select(
        (F.col("id") + 1).alias("number"),
        syn.cluster_choice(seed, F.col("id") + 1).alias("cluster"),
    )
    with_store = syn.pick_parent(
        base, rv.uniform(seed, "store", number, 1), store_rows.select("pos_id", "cluster"), ["pos_id"], ["cluster"]
    )
    with_customer = syn.pick_parent(
        with_store, rv.uniform(seed, "customer", number), customer_rows.select("codice_fiscale"), ["codice_fiscale"]
    )
    hour = rv.uniform_index(rv.uniform(seed, "time", number, 0), 14) + 8
    minute = rv.uniform_index(rv.uniform(seed, "time", number, 1), 60)
    return with_customer.select(
        formats.order_key(number).alias("order_id"), "pos_id", "codice_fiscale",
        syn.seasonal_date(seed, number, FIRST_DAY, LAST_DAY).alias("data_ordine"),
        formats.time_of_day(hour, minute).alias("ora_ordine"),
    )


def write_landing(spark: SparkSession, landing: str, n_products: int = 500, n_customers: int = 10_000,
                  n_orders: int = 100_000, seed: int = 42) -> None:
    """All five CSV folders. Every table is a function of its ids, so none has to be kept."""
    store_rows, product_rows = stores(spark, seed), products(spark, n_products, seed)
    customer_rows = customers(spark, n_customers, seed)
    order_rows = orders(spark, store_rows, customer_rows, n_orders, seed)
    ids = spark.range(n_orders).select(formats.order_key(F.col("id") + 1).alias("order_id"))
    lines = syn.order_lines(ids, "order_id", product_rows, "cod_prodotto", "prezzo_unitario", seed)
    for table, df in (("punti_vendita", store_rows), ("prodotti", product_rows), ("clienti", customer_rows),
                      ("ordini", order_rows), ("vendite", lines)):
        write_csv(df.select(*SOURCE_COLUMNS[table]), f"{landing}/{table}.csv")
