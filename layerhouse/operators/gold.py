"""Star schema: daily sales fact and customer dimension."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from layerhouse.functions.dates import date_key
from layerhouse.functions.money import FLAT_NET_RATE, net_amount
from layerhouse.operators.as_of import by_month, with_version
from layerhouse.operators.cdf import change_feed
from layerhouse.operators.scd import current_versions


@dataclass(frozen=True)
class SalesColumns:
    """Names of the columns the fact is built from."""

    order: str = "order_id"
    day: str = "data_ordine"
    product: str = "cod_prodotto"
    store: str = "pos_id"
    quantity: str = "quantita"
    amount: str = "importo_riga"
    product_sk: str = "sk_prodotto"
    store_sk: str = "sk_punto_vendita"


def daily_sales_fact(lines: DataFrame, orders: DataFrame, product_dim: DataFrame, store_dim: DataFrame,
                     names: SalesColumns = SalesColumns(), divisor: Decimal | Column = FLAT_NET_RATE,
                     days: tuple[str, str] | None = None) -> DataFrame:
    """Sales by day, product and store; lines without a current product or store drop out.

    Lines are summed by business key before the dimensions are joined, so the dimension joins
    see rows at fact grain. This equals joining first: a surrogate key belongs to one business
    key. ``days`` (first, last) restricts the orders read; to spare the lines of other days their
    deduplication, give the raw ones through ``lines_of`` first. ``divisor`` may use columns of the product
    dimension.
    """
    n = names
    if days:
        orders = orders_between(orders, days, n.day)
    sums = _sums(lines, orders, n)
    return _measures(
        sums.join(current_versions(product_dim), n.product)
        .join(current_versions(store_dim).select(n.store, n.store_sk), n.store), n, divisor)


def _sums(lines: DataFrame, orders: DataFrame, n: SalesColumns) -> DataFrame:
    return (
        lines.join(orders, n.order)
        .groupBy(n.day, n.product, n.store)
        .agg(
            F.count_distinct(n.order).alias("_orders"),
            F.sum(n.quantity).alias("_quantity"),
            F.sum(n.amount).alias("_amount"),
        )
    )


def _measures(sums: DataFrame, n: SalesColumns, divisor: Decimal | Column) -> DataFrame:
    gross = F.col("_amount").cast("decimal(12,2)")
    return sums.select(
        date_key(F.col(n.day)).alias("sk_data"),
        n.product_sk,
        n.store_sk,
        F.lit(None).cast("bigint").alias("sk_cliente"),
        F.col("_orders").cast("int").alias("n_transazioni"),
        F.col("_quantity").cast("int").alias("quantita_totale"),
        gross.alias("importo_lordo"),
        net_amount(gross, divisor).alias("importo_netto"),
        F.lit(0).cast("decimal(12,2)").alias("sconto_totale"),
    )


def _placed(sums: DataFrame, product_dim: DataFrame, store_dim: DataFrame, n: SalesColumns, attributes: Sequence[str],
            chunk: Callable[[Column], Column]) -> DataFrame:
    """The sums with the versions of their day in ``_product`` and ``_store``."""
    placed = with_version(sums, product_dim, [n.product], n.day, [n.product_sk, *attributes], chunk, "_product")
    return with_version(placed, store_dim, [n.store], n.day, [n.store_sk], chunk, "_store")


def daily_sales_fact_as_of(lines: DataFrame, orders: DataFrame, product_dim: DataFrame, store_dim: DataFrame,
                           names: SalesColumns = SalesColumns(), divisor: Decimal | Column = FLAT_NET_RATE,
                           attributes: Sequence[str] = (), chunk: Callable[[Column], Column] = by_month) -> DataFrame:
    """The daily fact with the product and store versions that were valid at the start of each day.

    A rebuild keeps the surrogate keys of old days, whatever versions came later. Sums without a version of
    their day drop out; ``dropped_as_of`` lists them. ``attributes`` of the product version may be used by
    ``divisor``. The lines are summed first, so the merge with the versions sees rows at fact grain.
    """
    n = names
    placed = _placed(_sums(lines, orders, n), product_dim, store_dim, n, attributes, chunk)
    found = placed.filter("_product IS NOT NULL AND _store IS NOT NULL")
    keys = [F.col("_product")[c].alias(c) for c in (n.product_sk, *attributes)]
    return _measures(found.select(*[c for c in found.columns if c not in ("_product", "_store")], *keys,
                                  F.col("_store")[n.store_sk].alias(n.store_sk)), n, divisor)


def dropped_as_of(lines: DataFrame, orders: DataFrame, product_dim: DataFrame, store_dim: DataFrame,
                  names: SalesColumns = SalesColumns(), chunk: Callable[[Column], Column] = by_month) -> DataFrame:
    """What ``daily_sales_fact_as_of`` leaves out, once for each reason in ``missing``: sums by day, product and store.

    day: the order has none; product, store: no version valid on that day, or no value at all. Lines
    without an order head are listed by ``dropped_lines``.
    """
    n = names
    placed = _placed(_sums(lines, orders, n), product_dim, store_dim, n, (), chunk)
    day = F.col(n.day).isNull()
    reasons = F.array_compact(F.array(
        F.when(day, F.lit("day")), F.when(~day & F.col("_product").isNull(), F.lit("product")),
        F.when(~day & F.col("_store").isNull(), F.lit("store"))))
    lost = placed.filter(day | F.col("_product").isNull() | F.col("_store").isNull())
    return lost.select(n.day, n.product, n.store, F.col("_orders").alias("n_transazioni"), F.col("_quantity").alias("quantita_totale"),
                       F.col("_amount").alias("importo_lordo"), F.explode(reasons).alias("missing"))


def touched_days(orders_before: DataFrame, orders: DataFrame, lines_before: DataFrame, lines: DataFrame,
                 order_key: Sequence[str], line_key: Sequence[str], names: SalesColumns = SalesColumns()) -> DataFrame:
    """The days whose sales differ between two versions of orders and lines, from the change feeds of both.

    An order that moves to another day touches both days; a changed line touches the days that its order had
    and has. Only the columns that the fact is made of are compared.
    """
    n = names
    heads = lambda df: df.select(*dict.fromkeys([*order_key, n.order, n.day, *[c for c in (n.store,) if c in df.columns]]))
    parts = lambda df: df.select(*dict.fromkeys(
        [*line_key, n.order, n.product, n.quantity, n.amount, *[c for c in (n.store,) if c in df.columns]]))
    moved = change_feed(heads(orders_before), heads(orders), order_key).select(n.day)
    changed = change_feed(parts(lines_before), parts(lines), line_key).select(n.order).distinct()
    both = orders_before.select(n.order, n.day).unionByName(orders.select(n.order, n.day))
    of_lines = changed.join(both, n.order).select(n.day)
    return moved.unionByName(of_lines).filter(F.col(n.day).isNotNull()).distinct()


def rekeyed_days(fact: DataFrame, lines: DataFrame, orders: DataFrame, product_dim: DataFrame, store_dim: DataFrame,
                 names: SalesColumns = SalesColumns(), day_key: str = "sk_data") -> DataFrame:
    """Days (as ``day_key``) whose rows a new version of a dimension changes, for the fact by current versions.

    They hold a surrogate key that is current no more, or lines of a product or store whose current key the
    fact does not have at all. Only the latter lines meet the orders.
    """
    n = names
    days = sold = None
    for dim, key, sk in ((product_dim, n.product, n.product_sk), (store_dim, n.store, n.store_sk)):
        now = current_versions(dim).select(key, sk)
        left = fact.select(day_key, sk).distinct().join(now.select(sk), sk, "left_anti").select(day_key)
        gained = now.join(fact.select(sk).distinct(), sk, "left_anti").select(key)
        # The store may be a column of the lines or of the orders.
        of_key = (lines if key in lines.columns else orders).select(n.order, key).join(gained, key, "left_semi").select(n.order)
        if key not in lines.columns:
            of_key = of_key.join(lines.select(n.order), n.order, "left_semi")
        days = left if days is None else days.unionByName(left)
        sold = of_key if sold is None else sold.unionByName(of_key)
    sold = sold.distinct().join(orders.select(n.order, n.day), n.order).select(date_key(F.col(n.day)).alias(day_key))
    return days.unionByName(sold).filter(F.col(day_key).isNotNull()).distinct()


def of_days(orders: DataFrame, day_keys: Sequence[int], names: SalesColumns = SalesColumns()) -> DataFrame:
    """The order heads of the given days, as a condition on the day itself: it reaches the scan."""
    days = [f"{k // 10000:04d}-{k // 100 % 100:02d}-{k % 100:02d}" for k in day_keys]
    return orders.filter(F.col(names.day).isin([F.lit(d).cast("date") for d in days]))


def orders_between(orders: DataFrame, days: tuple[str, str], day: str = SalesColumns.day) -> DataFrame:
    return orders.filter(F.col(day).between(F.lit(days[0]).cast("date"), F.lit(days[1]).cast("date")))


def lines_of(lines: DataFrame, orders: DataFrame, order: str = SalesColumns.order) -> DataFrame:
    """The lines of the given orders. The order is part of a line's key, so this may come before the
    latest line of each key is chosen: all copies of a line go or stay together."""
    return lines.join(orders.select(order), order, "left_semi")


def dropped_lines(lines: DataFrame, orders: DataFrame, product_dim: DataFrame, store_dim: DataFrame,
                  names: SalesColumns = SalesColumns()) -> DataFrame:
    """The lines the fact leaves out, once for each reason in ``missing``.

    order: no order head; day: the head has none; product, store: no current row, or no value at all. The
    store may be a column of the lines or of the orders; without a head the latter is not asked for.
    Lines keep their columns. One pass: the lines stay on the streamed side of each join, which AQE
    splits when a key is hot. Order heads and current dimension rows are unique, so no line is doubled.
    """
    n = names
    of_order = [c for c in (n.store,) if c not in lines.columns]
    heads = orders.select(n.order, F.col(n.day).alias("_day"), *[F.col(c).alias("_store") for c in of_order],
                          F.lit(True).alias("_head"))
    marked = lines.join(heads, n.order, "left")
    if not of_order:
        marked = marked.withColumn("_store", F.col(n.store))
    known = lambda dim, key, name, mark: current_versions(dim).select(F.col(key).alias(name), F.lit(True).alias(mark))
    marked = (
        marked.withColumn("_product", F.col(n.product))
        .join(known(product_dim, n.product, "_product", "_has_product"), "_product", "left")
        .join(known(store_dim, n.store, "_store", "_has_store"), "_store", "left")
    )
    head = F.col("_head").isNotNull()
    store = F.col("_has_store").isNull() & (head if of_order else F.lit(True))
    reasons = F.array_compact(F.array(
        F.when(~head, F.lit("order")), F.when(head & F.col("_day").isNull(), F.lit("day")),
        F.when(F.col("_has_product").isNull(), F.lit("product")), F.when(store, F.lit("store"))))
    lost = marked.filter(~head | F.col("_day").isNull() | F.col("_has_product").isNull() | F.col("_has_store").isNull())
    return lost.select(*lines.columns, F.explode(reasons).alias("missing"))


def with_unknown_member(dim: DataFrame, member: Mapping[str, object], schema: StructType) -> DataFrame:
    """Adds the row that stands for 'not known'; columns it does not name are NULL."""
    row = [F.lit(member.get(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields]
    sentinel = dim.sparkSession.range(1).select(*row)
    return dim.unionByName(sentinel, allowMissingColumns=True)


def customer_dimension(customers: DataFrame, attributes: Sequence[str], member: Mapping[str, object],
                       schema: StructType, segment: str = "standard") -> DataFrame:
    """Chosen attributes, a default segment, and the unknown member."""
    rows = customers.select(*attributes).withColumn("segmento", F.lit(segment))
    return with_unknown_member(rows, member, schema)
