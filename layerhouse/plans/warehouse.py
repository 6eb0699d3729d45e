"""The retail warehouse, layer by layer.

Every step reads landing files or published tables and writes tables, so a step can be run again
alone. ``batch_id`` and ``batch_ts`` come from the caller; the same values give the same tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from layerhouse import contracts as c
from layerhouse.operators import bronze, calendar_dim, cdf, gold, quality, scd, silver
from layerhouse.operators.keys import keep_keys, strided_keys
from layerhouse.sources import change_log, landing as files, tables


#: Tables that are replaced version by version.
PUBLISHED = (c.SILVER_ORDERS, c.SILVER_LINES, c.SILVER_CUSTOMERS, c.DIM_PRODUCT, c.DIM_STORE, c.FACT_DAILY_SALES,
             c.GOLD_CUSTOMER, c.GOLD_DATE, c.GOLD_PRODUCT, c.GOLD_STORE)
#: Checks that only inform: the raw total differs after a repeated delivery, the days depend on the calendar.
INFORMATION = ("raw_total", "silver_total", "days")
FINDINGS = "qa"
#: Tables whose changes are kept for all versions.
LOGGED = (c.SILVER_ORDERS,)


def _publish(df: DataFrame, contract: c.Contract, batch_id: str, quarantine: bool = False) -> int:
    """Rows written; minus the number of kinds of NULLs if the old version stays because of them."""
    try:
        return tables.publish(df, contract, batch_id, quarantine)
    except tables.Rejected as rejected:
        print(rejected)
        return -len(rejected.nulls)


def _landing(spark: SparkSession, landing: str, table: str) -> DataFrame:
    return files.read_csv(spark, f"{landing}/{table}.csv", c.text_schema(c.SOURCE_COLUMNS[table]))


def ingest_bronze(spark: SparkSession, landing: str, batch_id: str, batch_ts: str) -> dict[str, int]:
    """Orders and lines of one delivery into the raw tables; rows loaded per table."""
    tables.create_schemas(spark, c.SCHEMAS)
    loaded = {}
    for table, contract in (("ordini", c.BRONZE_ORDERS), ("vendite", c.BRONZE_LINES)):
        raw = bronze.to_bronze(_landing(spark, landing, table), table, batch_id, batch_ts)
        loaded[contract.name] = tables.append_batch(raw, contract, batch_id)
    return loaded


def newest_first(contract: c.Contract) -> list:
    """Newest load first; within one load, batch id and all values decide, so the pick is fixed."""
    rest = [x for x in contract.columns if x not in ("_ingestion_ts", "_batch_id", "_source_file")]
    return [F.col("_ingestion_ts").desc(), F.col("_batch_id").desc(), *[F.col(x).desc() for x in rest]]


def build_silver(spark: SparkSession, landing: str, batch_id: str, batch_ts: str, quarantine: bool = False) -> dict[str, int]:
    """Typed tables from all raw rows. With ``quarantine``, and where there is no version yet, a broken row is set apart until
    its key is delivered soundly, and the table goes on without it; else the whole table keeps its old version."""
    apart = lambda target: quarantine or not spark.catalog.tableExists(target.name)
    written = {}
    for source, target, types in (
        (c.BRONZE_ORDERS, c.SILVER_ORDERS, c.ORDER_TYPES),
        (c.BRONZE_LINES, c.SILVER_LINES, c.LINE_TYPES),
    ):
        typed = silver.dedup_and_type(spark.table(source.name), target.key, types, newest_first(source))
        written[target.name] = _publish(typed, target, batch_id, apart(target))
    customers = _landing(spark, landing, "clienti")
    one_each = silver.latest_per_key(
        customers, c.SILVER_CUSTOMERS.key, [F.col(x).desc() for x in customers.columns]
    )
    typed = silver.apply_types(one_each, c.CUSTOMER_TYPES).withColumn(
        "_ingestion_ts", F.lit(batch_ts).cast("timestamp")
    )
    written[c.SILVER_CUSTOMERS.name] = _publish(typed, c.SILVER_CUSTOMERS, batch_id, apart(c.SILVER_CUSTOMERS))
    return written


def update_dimensions(spark: SparkSession, landing: str, batch_id: str, batch_ts: str) -> dict[str, int]:
    """One SCD2 batch for products and stores: one pass, one clock, one switch per dimension."""
    written = {}
    for table, contract, spec, types in (
        ("prodotti", c.DIM_PRODUCT, c.PRODUCT_SPEC, c.PRODUCT_TYPES),
        ("punti_vendita", c.DIM_STORE, c.STORE_SPEC, c.STORE_TYPES),
    ):
        incoming = silver.apply_types(_landing(spark, landing, table), types)
        if spark.catalog.tableExists(contract.name):
            dim = scd.scd2_apply(
                spark.table(contract.name), incoming, spec, batch_ts, tables.high_water(spark, contract))
        else:
            dim = scd.scd2_initial(incoming, spec, batch_ts)
        written[contract.name] = _publish(dim, contract, batch_id)
    return written


def build_gold(spark: SparkSession, batch_id: str, first_year: int = 2020, last_year: int = 2030) -> dict[str, int]:
    table = lambda contract: spark.table(contract.name)
    written = {}
    known = gold.customer_dimension(
        table(c.SILVER_CUSTOMERS), c.CUSTOMER_ATTRIBUTES, c.UNKNOWN_CUSTOMER, c.UNKNOWN_CUSTOMER_SCHEMA
    )
    if spark.catalog.tableExists(c.GOLD_CUSTOMER.name):
        customers = keep_keys(known, table(c.GOLD_CUSTOMER), ["codice_fiscale"], "sk_cliente",
                              tables.high_water(spark, c.GOLD_CUSTOMER))
    else:
        customers = strided_keys(known, ["codice_fiscale"], "sk_cliente")
    written[c.GOLD_CUSTOMER.name] = _publish(customers, c.GOLD_CUSTOMER, batch_id)
    fact = gold.daily_sales_fact(
        table(c.SILVER_LINES), table(c.SILVER_ORDERS), table(c.DIM_PRODUCT), table(c.DIM_STORE)
    )
    written[c.FACT_DAILY_SALES.name] = _publish(fact, c.FACT_DAILY_SALES, batch_id)
    dates = calendar_dim.date_dimension(spark, first_year, last_year)
    written[c.GOLD_DATE.name] = _publish(dates, c.GOLD_DATE, batch_id)
    for source, target in ((c.DIM_PRODUCT, c.GOLD_PRODUCT), (c.DIM_STORE, c.GOLD_STORE)):
        written[target.name] = _publish(scd.publish_current(table(source)), target, batch_id)
    return written


def checks(spark: SparkSession) -> dict[str, DataFrame]:
    """The model checks on the published tables. Violations are expected to be empty, the
    reconciliation to show a delta of zero, the day count to be 731 if the calendar holds both years."""
    table = lambda contract: spark.table(contract.name)
    fact, lines = table(c.FACT_DAILY_SALES), table(c.SILVER_LINES)
    amount = F.col("importo_riga").try_cast("decimal(12,2)")
    return {
        "grain": quality.duplicate_groups(fact, c.FACT_DAILY_SALES.key),
        "orphan_products": quality.orphan_keys(fact, "sk_prodotto", table(c.DIM_PRODUCT), "sk_prodotto"),
        "orphan_stores": quality.orphan_keys(fact, "sk_punto_vendita", table(c.DIM_STORE), "sk_punto_vendita"),
        "orphan_days": quality.orphan_keys(fact, "sk_data", table(c.GOLD_DATE), "sk_data"),
        "raw_total": quality.reconcile(table(c.BRONZE_LINES), amount, fact, F.col("importo_lordo")),
        "silver_total": quality.reconcile(lines, F.col("importo_riga"), fact, F.col("importo_lordo"), "tot_slv"),
        "one_current_product": quality.not_one_current(table(c.DIM_PRODUCT), ["cod_prodotto"]),
        "one_current_store": quality.not_one_current(table(c.DIM_STORE), ["pos_id"]),
        "silver_differs": quality.reconcile(
            lines, F.col("importo_riga"), fact, F.col("importo_lordo"), "tot_slv").filter("NOT delta <=> 0"),
        "dropped_lines": gold.dropped_lines(lines, table(c.SILVER_ORDERS), table(c.DIM_PRODUCT), table(c.DIM_STORE)),
        "days": quality.days_held(table(c.GOLD_DATE), 2023, 2024),
    }


def rejects(spark: SparkSession) -> dict[str, DataFrame]:
    """Raw values that the typed layer holds as NULL, by table."""
    return {
        source.name: silver.cast_rejects(spark.table(source.name), [*key, "_batch_id"], types)
        for source, key, types in (
            (c.BRONZE_ORDERS, c.SILVER_ORDERS.key, c.ORDER_TYPES),
            (c.BRONZE_LINES, c.SILVER_LINES.key, c.LINE_TYPES),
        )
    }


def quarantined(spark: SparkSession) -> dict[str, DataFrame]:
    """Rows that the typed tables set apart, by table."""
    return {t.name: tables.quarantined(spark, t) for t in (c.SILVER_ORDERS, c.SILVER_LINES, c.SILVER_CUSTOMERS)}


def contract_checks(spark: SparkSession) -> dict[str, DataFrame]:
    """Primary keys and required columns of every published table."""
    found = {}
    for contract in PUBLISHED:
        df = spark.table(contract.name)
        found[f"{contract.name} key"] = quality.duplicate_groups(df, contract.key)
        found[f"{contract.name} required"] = quality.null_counts(df, contract.required)
    return found


def _counts(spark: SparkSession) -> dict[str, dict]:
    """Of every published table the numbers that its checks need, from one scan each."""
    totals = {c.FACT_DAILY_SALES: {"total": F.col("importo_lordo")}, c.SILVER_LINES: {"total": F.col("importo_riga")}}
    return {
        t.name: dict(quality.constraints(spark.table(t.name), t.key, t.required, totals.get(t)).collect()) for t in PUBLISHED}


def report(spark: SparkSession) -> dict[str, int]:
    """Writes all rows of every check to a table of its own in the schema ``qa``; rows per check.

    The checks in ``INFORMATION`` always have a row; rows of any other are violations. The findings are those of ``checks``,
    ``contract_checks`` and ``rejects``, but keys, required columns and totals of a table come from one scan of it, all foreign
    keys of the fact from another, and keys are listed only where one occurs twice. Rows are counted as they are written.
    """
    tables.create_schemas(spark, [FINDINGS])
    found = {}

    def listed(name: str, df: DataFrame) -> None:
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.format("parquet").mode("overwrite").saveAsTable(
            f"{FINDINGS}.{name.replace('.', '_').replace(' ', '_')}")
        found[name] = seen.get["n"]

    one_row = lambda schema, *values: spark.createDataFrame([values], schema)
    counts, fact, lines = _counts(spark), c.FACT_DAILY_SALES.name, c.SILVER_LINES.name
    total = lambda name: counts[name]["sum total"] if counts[name]["rows"] else None
    for contract in PUBLISHED:
        held = counts[contract.name]
        twice = quality.duplicate_groups(spark.table(contract.name), contract.key)
        listed(f"{contract.name} key", twice if held["key"] else spark.createDataFrame([], twice.schema))
        missing = [(x, int(held[f"null {x}"])) for x in contract.required if held[f"null {x}"]]
        listed(f"{contract.name} required", spark.createDataFrame(missing, "column_name string, n_null long"))
    lost = quality.orphans(spark.table(fact), {
        "sk_prodotto": (spark.table(c.DIM_PRODUCT.name), "sk_prodotto"),
        "sk_punto_vendita": (spark.table(c.DIM_STORE.name), "sk_punto_vendita"),
        "sk_data": (spark.table(c.GOLD_DATE.name), "sk_data")})
    listed("orphans", lost)
    for name, key in (("orphan_products", "sk_prodotto"), ("orphan_stores", "sk_punto_vendita"), ("orphan_days", "sk_data")):
        kind = c.FACT_DAILY_SALES.schema[key].dataType
        mine = spark.table(f"{FINDINGS}.orphans").filter(F.col("foreign_key") == key)
        listed(name, mine.select(F.col("value").cast(kind).alias(key), "n"))
    named = checks(spark)
    totals = {"raw_total": spark.table(c.BRONZE_LINES.name).agg(F.sum(F.col("importo_riga").try_cast("decimal(12,2)"))).first()[0],
              "silver_total": total(lines)}
    for name, first in totals.items():
        second, column = total(fact), "tot_brz" if name == "raw_total" else "tot_slv"
        delta = None if first is None or second is None else abs(first - second)
        listed(name, one_row(f"{column} decimal(22,2), tot_gld decimal(22,2), delta decimal(22,2)", first, second, delta))
    listed("silver_differs", spark.table(f"{FINDINGS}.silver_total").filter("NOT delta <=> 0"))
    listed("grain", spark.table(f"{FINDINGS}.{fact.replace('.', '_')}_key"))
    apart = {f"{name} quarantined": df for name, df in quarantined(spark).items()}
    rest = {name: df for name, df in named.items() if name not in found}
    for name, df in {**rest, **rejects(spark), **apart}.items():
        listed(name, df)
    return found


def order_changes(spark: SparkSession) -> DataFrame | None:
    """Inserted, updated and deleted orders between the version shown and the one before, if that is still there."""
    before = tables.version_before(spark, c.SILVER_ORDERS)
    if before is None:
        return None
    return cdf.change_feed(before, spark.table(c.SILVER_ORDERS.name), c.SILVER_ORDERS.key)


def record_changes(spark: SparkSession) -> dict[str, int]:
    """Adds the changes of the orders since the last record to their log; rows added."""
    return {change_log.log_of(t).name: change_log.record(spark, t) for t in LOGGED}


def clean(spark: SparkSession) -> list[str]:
    """Drops old versions; of the orders the one before stays, for ``order_changes``, and of a logged table the one
    recorded last."""
    dropped = []
    for contract in PUBLISHED:
        if spark.catalog.tableExists(contract.name):
            recorded = change_log.last_recorded(spark, contract)
            dropped += tables.drop_old_versions(spark, contract, contract is c.SILVER_ORDERS, [recorded] if recorded else [])
    return dropped


def run(spark: SparkSession, landing: str, batch_id: str, batch_ts: str, first_year: int = 2020,
        last_year: int = 2030, keep_versions: bool = True, quarantine: bool = False) -> dict[str, int]:
    """One daily run over all layers; rows written per table. Without ``keep_versions`` old ones go at the end.

    ``quarantine``: see ``build_silver``."""
    written = {
        **ingest_bronze(spark, landing, batch_id, batch_ts),
        **build_silver(spark, landing, batch_id, batch_ts, quarantine),
        **update_dimensions(spark, landing, batch_id, batch_ts),
        **build_gold(spark, batch_id, first_year, last_year),
    }
    if not keep_versions:
        clean(spark)
    return written
