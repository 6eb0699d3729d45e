"""Model checks over the test tables, on sound data and on planted faults."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from layerhouse.operators import quality, scd
from layerhouse.plans.catalogue.dimensions import APPLIED, DATES, HISTORY, _applied, dates, history
from layerhouse.plans.catalogue.registry import query, table
from layerhouse.plans.catalogue.sales import (
    DIMS, FACT, LATEST_LINES, RAW_LINES, fact_daily_sales, latest_lines, product_dim, raw_lines,
)

GRAIN = ("sk_data", "sk_prodotto", "sk_punto_vendita")


@query("""WITH keyed AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2),
lines AS (SELECT *, CASE WHEN l_partkey % 10 <> 3 THEN l_partkey END AS product FROM lineitem),
v AS (SELECT count(*) AS a, (SELECT count(*) FROM keyed WHERE n > 1) AS b, count(*) FILTER (WHERE product IS NULL) AS c,
  count(*) FILTER (WHERE l_suppkey IS NULL) AS d, count(*) FILTER (WHERE NOT coalesce(l_quantity < 40, false)) AS e,
  count(*) FILTER (WHERE NOT coalesce(product > 50, false)) AS f, sum(CAST(l_extendedprice AS DECIMAL(10,2))) AS g FROM lines)
SELECT check_name, CAST(value AS DECIMAL(38,2)) AS value FROM (
  SELECT 'rows' AS check_name, CAST(a AS DECIMAL(38,2)) AS value FROM v UNION ALL SELECT 'key', b FROM v UNION ALL SELECT 'null product', c FROM v
  UNION ALL SELECT 'null l_suppkey', d FROM v UNION ALL SELECT 'not quantity', e FROM v UNION ALL SELECT 'not known', f FROM v
  UNION ALL SELECT 'sum amount', g FROM v) u""")
def constraint_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key, required columns, conditions and a total of the raw lines in one pass."""
    lines = table(spark, sf_dir, "lineitem").withColumn("product", F.when(F.col("l_partkey") % 10 != 3, F.col("l_partkey")))
    return quality.constraints(
        lines, ["l_orderkey", "l_linenumber"], ["product", "l_suppkey"], {"amount": F.col("l_extendedprice").cast("decimal(10,2)")},
        {"quantity": F.col("l_quantity") < 40, "known": F.col("product") > 50})


@query("""WITH lines AS (SELECT CASE WHEN l_partkey % 10 <> 3 THEN l_partkey END AS part, l_suppkey AS supplier, l_orderkey AS \"order\" FROM lineitem),
counts AS (SELECT 'part' AS foreign_key, part AS value, count(*) AS n FROM lines GROUP BY 2
  UNION ALL SELECT 'supplier', supplier, count(*) FROM lines GROUP BY 2 UNION ALL SELECT 'order', \"order\", count(*) FROM lines GROUP BY 2)
SELECT foreign_key, CAST(value AS VARCHAR) AS value, n FROM counts WHERE CASE foreign_key
  WHEN 'part' THEN NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = value AND p_size < 40)
  WHEN 'supplier' THEN NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = value AND s_acctbal > 0)
  ELSE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = value) END""")
def orphans_of_all_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three foreign keys of the lines in one pass, against parents of which some are missing."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_partkey") % 10 != 3, F.col("l_partkey")).alias("part"), F.col("l_suppkey").alias("supplier"), F.col("l_orderkey").alias("order"))
    return quality.orphans(lines, {
        "part": (table(spark, sf_dir, "part").filter("p_size < 40"), "p_partkey"),
        "supplier": (table(spark, sf_dir, "supplier").filter("s_acctbal > 0"), "s_suppkey"),
        "order": (table(spark, sf_dir, "orders"), "o_orderkey")})


@query(f"""WITH {FACT} SELECT sk_data, sk_prodotto, sk_punto_vendita, count(*) AS n FROM fact
GROUP BY 1, 2, 3 HAVING count(*) > 1""")
def grain_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact holds its grain: no rows."""
    return quality.duplicate_groups(fact_daily_sales(spark, sf_dir), GRAIN)


@query("""SELECT CAST(l_shipdate AS DATE) AS day, l_suppkey, count(*) AS n FROM lineitem GROUP BY 1, 2
HAVING count(*) > 1""")
def grain_check_on_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines do not hold the grain day by store."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("day"), "l_suppkey")
    return quality.duplicate_groups(lines, ["day", "l_suppkey"])


@query("""SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def pk_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_groups(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(f"""WITH {FACT} SELECT f.sk_prodotto, count(*) AS n FROM fact f
LEFT JOIN product_dim d ON f.sk_prodotto = d.sk_prodotto WHERE d.sk_prodotto IS NULL GROUP BY 1""")
def orphan_fk_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every product of the fact is known: no rows."""
    fact, dim = fact_daily_sales(spark, sf_dir), product_dim(spark, sf_dir)
    return quality.orphan_keys(fact, "sk_prodotto", dim, "sk_prodotto")


@query("""SELECT l_partkey, count(*) AS n FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_type <> 'PROMO') GROUP BY 1""")
def orphan_fk_check_missing_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    parents = table(spark, sf_dir, "part").filter(F.col("p_type") != "PROMO")
    return quality.orphan_keys(table(spark, sf_dir, "lineitem"), "l_partkey", parents, "p_partkey")


RECONCILE = """SELECT CAST(a AS DECIMAL(22,2)) AS tot_brz, CAST(b AS DECIMAL(22,2)) AS tot_gld,
  CAST(abs(a - b) AS DECIMAL(22,2)) AS delta FROM (SELECT sum(importo_riga) AS a FROM {0}),
  (SELECT sum(importo_lordo) AS b FROM fact)"""


@query(f"WITH {FACT} " + RECONCILE.format("raw"))
def reconcile_raw_vs_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table holds repeated deliveries, so its total is larger."""
    fact = fact_daily_sales(spark, sf_dir)
    return quality.reconcile(raw_lines(spark, sf_dir), F.col("importo_riga"), fact, F.col("importo_lordo"))


@query(f"WITH {FACT} " + RECONCILE.format("latest"))
def reconcile_dedup_vs_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After deduplication nothing is missing: delta zero."""
    fact = fact_daily_sales(spark, sf_dir)
    return quality.reconcile(latest_lines(spark, sf_dir), F.col("importo_riga"), fact, F.col("importo_lordo"))


@query(f"""WITH {APPLIED} SELECT cod_prodotto, count(*) FILTER (WHERE is_current) AS n_current FROM applied
GROUP BY 1 HAVING count(*) FILTER (WHERE is_current) <> 1""")
def scd2_one_current_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After a batch every product has one current version: no rows."""
    return quality.not_one_current(_applied(spark, sf_dir), ["cod_prodotto"])


@query(f"""WITH {HISTORY}, faulty AS (SELECT user_id, CASE WHEN event_type = 'error' THEN false
  WHEN event_type = 'signup' THEN true ELSE is_current END AS is_current FROM history)
SELECT user_id, count(*) FILTER (WHERE is_current) AS n_current FROM faulty
GROUP BY 1 HAVING count(*) FILTER (WHERE is_current) <> 1""")
def scd2_one_current_check_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planted faults: keys with several current versions, and keys with none."""
    kind = F.col("event_type")
    current = F.when(kind == "error", False).when(kind == "signup", True).otherwise(F.col(scd.IS_CURRENT))
    return quality.not_one_current(history(spark, sf_dir).withColumn(scd.IS_CURRENT, current), ["user_id"])


@query("""SELECT 'c_mktsegment' AS column_name, count(*) AS n_null FROM customer WHERE c_mktsegment = 'HOUSEHOLD'
UNION ALL SELECT 'c_acctbal', count(*) FROM customer WHERE c_acctbal < 0""")
def not_null_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One segment and negative balances are blanked; the key stays filled and is not listed."""
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("HOUSEHOLD")).alias("c_mktsegment"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"))
    return quality.null_counts(customers, ["c_custkey", "c_mktsegment", "c_acctbal"])


@query(f"WITH {DATES} SELECT count(*) AS n_giorni FROM dim_date WHERE anno BETWEEN 1996 AND 1997")
def date_coverage_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two full years, one of them a leap year: 731."""
    return quality.days_held(dates(spark, sf_dir), 1996, 1997)


@query(f"""WITH {DATES} SELECT data FROM dim_date
WHERE data NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)""")
def date_coverage_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of the calendar without any order."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    return quality.missing_days(dates(spark, sf_dir), "data", orders, "day")
