"""Synthetic retail rows, each computed from its own id: no shared generator, no driver loop."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from layerhouse.functions import random_values as rv
from layerhouse.functions.money import line_amount
from layerhouse.operators.keys import dense_position


class Cluster(NamedTuple):
    name: str
    share: float
    stores: int
    regions: tuple[str, ...]


# Share of orders, number of stores and region codes of each cluster.
CLUSTERS = (
    Cluster("Nord-Ovest", 0.35, 15, ("MI", "TO", "GE")),
    Cluster("Nord-Est", 0.22, 10, ("VE", "UD", "TN")),
    Cluster("Centro", 0.23, 12, ("FI", "RM", "PG")),
    Cluster("Sud", 0.15, 9, ("NA", "BA", "CZ")),
    Cluster("Isole", 0.05, 4, ("PA", "CA")),
)

# Cities of customers and their province codes.
CITIES = (("Milano", "MI"), ("Torino", "TO"), ("Genova", "GE"), ("Venezia", "VE"), ("Firenze", "FI"), ("Roma", "RM"),
          ("Napoli", "NA"), ("Bari", "BA"), ("Palermo", "PA"), ("Cagliari", "CA"))

# Share of days kept by month, before the second draw.
SEASON = {1: 0.85, 2: 0.85, 3: 0.95, 4: 1.00, 5: 1.00, 6: 1.05,
          7: 0.95, 8: 0.80, 9: 1.00, 10: 1.05, 11: 1.10, 12: 1.30}

# Quantities of a line and their weights.
QUANTITIES, QUANTITY_WEIGHTS = (1, 2, 3, 4, 5), (50, 25, 15, 7, 3)

# Product categories, in order.
CATEGORIES = (
    "Frutta", "Verdura", "Latticini", "Carne", "Pesce", "Pane", "Pasta", "Bevande", "Surgelati", "Dolci",
    "Pulizia Casa", "Igiene Persona", "Cancelleria", "Pet Food", "Snack", "Conserve", "Condimenti",
    "Cereali", "Vini", "Bio",
)

# Mean, deviation and bounds of unit prices and of lines per order.
PRICE = (8.5, 4.0, 0.50, 45.00)
LINES = (3.5, 1.5, 1, 12)

LOYALTY_SHARE = 0.70


def unit_price(seed: int, row_id: Column, stream: str = "price") -> Column:
    mean, deviation, low, high = PRICE
    drawn = rv.normal(rv.uniform(seed, stream, row_id, 0), rv.uniform(seed, stream, row_id, 1), mean, deviation)
    return rv.clipped(F.round(drawn, 2), low, high).cast("decimal(10,2)")


def lines_per_order(seed: int, row_id: Column, stream: str = "lines") -> Column:
    mean, deviation, low, high = LINES
    drawn = rv.normal(rv.uniform(seed, stream, row_id, 0), rv.uniform(seed, stream, row_id, 1), mean, deviation)
    return F.floor(rv.clipped(drawn, low, high)).cast("int")


def quantity(seed: int, row_id: Column, stream: str = "quantity") -> Column:
    return rv.weighted_choice(rv.uniform(seed, stream, row_id), QUANTITIES, QUANTITY_WEIGHTS)


def cluster_choice(seed: int, row_id: Column, stream: str = "store") -> Column:
    return rv.weighted_choice(
        rv.uniform(seed, stream, row_id), [c.name for c in CLUSTERS], [c.share for c in CLUSTERS]
    )


def seasonal_date(seed: int, row_id: Column, first: str, last: str, stream: str = "day") -> Column:
    u = [rv.uniform(seed, stream, row_id, lane) for lane in range(3)]
    return rv.redrawn_date(u[0], u[1], u[2], SEASON, first, last)


def pick_parent(df: DataFrame, u: Column, parent: DataFrame, key: Sequence[str],
                within: Sequence[str] = (), columns: Sequence[str] = ()) -> DataFrame:
    """A uniformly chosen parent row for every row of ``df`` (inside its ``within`` group).

    Parents get dense positions; each row turns its uniform into one position, so the pick is an
    equi-join and never a product of both tables. A NULL group is a group like others. The job fails on a row
    whose group has no parent.
    """
    wanted = list(dict.fromkeys([*within, *key, *columns]))
    numbered = dense_position(parent.select(*wanted), key, "_position", within)
    by = []
    if within:
        group = F.struct(*within).alias("_group")
        by = ["_group"]
        sizes = parent.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
        sized = df.select("*", group).join(sizes, by, "left")
        numbered = numbered.select("*", group).drop(*within)
        childless = F.concat(F.lit("no parent in the group "), F.to_json("_group"))
    else:
        sized = df.withColumn("_n", F.nullif(parent.agg(F.count(F.lit(1)).alias("_n")).scalar(), F.lit(0)))
        childless = F.lit("no parent at all")
    n = F.when(F.col("_n").isNull(), F.raise_error(childless).cast("bigint")).otherwise(F.col("_n"))
    placed = sized.withColumn("_position", rv.uniform_index(u, n)).drop("_n")
    return placed.join(numbered, [*by, "_position"]).select(*df.columns, *[c for c in wanted if c not in df.columns])


def order_lines(orders: DataFrame, order: str, products: DataFrame, product: str, price: str,
                seed: int) -> DataFrame:
    """Lines of each order: different products, numbered from 1, with quantity and amount.

    The positions of an order's products are computed inside its row, so only the product
    look-up is a join.
    """
    numbered = dense_position(products.select(product, price), [product], "_position")
    size = products.agg(F.count(F.lit(1)))
    wanted = F.least(lines_per_order(seed, F.col(order)).cast("bigint"), F.col("_n"))
    picked = (
        orders.select(order, size.scalar().alias("_n"))
        .select(order, "_n", wanted.alias("_k"))
        .select(order, rv.sample_positions(
            F.col("_n"), F.col("_k"), rv.uniforms(seed, "sample", F.col(order), F.col("_k"), LINES[3])).alias("_p"))
        # The outer form: the plain one adds a filter that computes the whole array twice.
        .select(order, F.posexplode_outer("_p").alias("_slot", "_position"))
    )
    line_id = F.concat_ws("-", F.col(order).cast("string"), (F.col("_slot") + 1).cast("string"))
    qty = quantity(seed, line_id)
    return picked.join(numbered, "_position").select(
        order,
        (F.col("_slot") + 1).alias("line_num"),
        product,
        qty.alias("quantita"),
        F.col(price).alias("prezzo_unitario"),
        line_amount(qty, F.col(price)).alias("importo_riga"),
    )
