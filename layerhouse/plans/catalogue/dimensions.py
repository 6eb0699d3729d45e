"""Versioned dimensions, the customer and date dimensions, change feeds."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from layerhouse.contracts import Contract, text_schema
from layerhouse.functions.dates import time_slot
from layerhouse.functions.hashing import hash_diff
from layerhouse.operators import calendar_dim, cdf, gold, keys, scd, silver
from layerhouse.plans.catalogue.registry import query, scratch_schema, table
from layerhouse.session import work_dir
from layerhouse.sources import patched
from layerhouse.streaming.incremental import follow_history

SPEC = scd.Scd2Spec(key=("cod_prodotto",), tracked=("nome", "categoria", "iva_perc"),
                    overwrite=("prezzo_unitario",), surrogate="sk_prodotto")
BATCH_TS = "2024-06-01 00:00:00"


def dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product dimension from part: a current version each, and an older one of the large parts."""
    both = F.when(F.col("p_size") > 25, F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True)))
    rows = table(spark, sf_dir, "part").select("*", F.explode(both).alias("is_current"))
    now = F.col("is_current")
    dim = rows.select(
        (F.col("p_partkey") * 2 + F.when(now, 2).otherwise(1)).alias("sk_prodotto"),
        F.col("p_partkey").alias("cod_prodotto"),
        F.when(now, F.col("p_name")).otherwise(F.concat(F.lit("old "), "p_name")).alias("nome"),
        F.col("p_type").alias("categoria"),
        F.col("p_size").alias("iva_perc"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("prezzo_unitario"),
        F.when(now, F.lit("2024-01-01")).otherwise(F.lit("2023-01-01")).cast("timestamp").alias("valid_from"),
        F.when(~now, F.lit("2024-01-01")).cast("timestamp").alias("valid_to"),
        "is_current",
    )
    return dim.withColumn("_hash_diff", hash_diff("nome", "categoria", "iva_perc")).select(*SPEC.columns)


def delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next batch: one type is absent, one brand changes size, one type changes price, and
    one brand brings new products."""
    part = table(spark, sf_dir, "part")
    known = part.filter(F.col("p_type") != "SMALL").select(
        F.col("p_partkey").alias("cod_prodotto"), F.col("p_name").alias("nome"), F.col("p_type").alias("categoria"),
        (F.col("p_size") + F.when(F.col("p_brand") == "Brand#7", 1).otherwise(0)).alias("iva_perc"),
        (F.col("p_retailprice").cast("decimal(10,2)") + F.when(F.col("p_type") == "LARGE", 1).otherwise(0))
        .cast("decimal(10,2)").alias("prezzo_unitario"),
    )
    new = part.filter(F.col("p_brand") == "Brand#3").select(
        (-F.col("p_partkey") - 1).alias("cod_prodotto"), F.col("p_name").alias("nome"),
        F.col("p_type").alias("categoria"), F.col("p_size").alias("iva_perc"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("prezzo_unitario"),
    )
    return known.unionByName(new)


def _with_dates(dim: DataFrame) -> DataFrame:
    return dim.withColumns({c: F.col(c).cast("date") for c in ("valid_from", "valid_to")})


DIM = """dim AS (
  SELECT *, sha256(concat_ws('||', nome, categoria, CAST(iva_perc AS VARCHAR))) AS _hash_diff FROM (
    SELECT 2 * p_partkey + 2 AS sk_prodotto, p_partkey AS cod_prodotto, p_name AS nome, p_type AS categoria,
      p_size AS iva_perc, CAST(p_retailprice AS DECIMAL(10,2)) AS prezzo_unitario, DATE '2024-01-01' AS valid_from,
      CAST(NULL AS DATE) AS valid_to, true AS is_current FROM part
    UNION ALL
    SELECT 2 * p_partkey + 1, p_partkey, 'old ' || p_name, p_type, p_size, CAST(p_retailprice AS DECIMAL(10,2)),
      DATE '2023-01-01', DATE '2024-01-01', false FROM part WHERE p_size > 25) v)"""

INCOMING = """src AS (
  SELECT *, sha256(concat_ws('||', nome, categoria, CAST(iva_perc AS VARCHAR))) AS _hash_diff FROM (
    SELECT p_partkey AS cod_prodotto, p_name AS nome, p_type AS categoria,
      p_size + CASE WHEN p_brand = 'Brand#7' THEN 1 ELSE 0 END AS iva_perc,
      CAST(CAST(p_retailprice AS DECIMAL(10,2)) + CASE WHEN p_type = 'LARGE' THEN 1 ELSE 0 END AS DECIMAL(10,2))
        AS prezzo_unitario
    FROM part WHERE p_type <> 'SMALL'
    UNION ALL
    SELECT -p_partkey - 1, p_name, p_type, p_size, CAST(p_retailprice AS DECIMAL(10,2)) FROM part
    WHERE p_brand = 'Brand#3') n)"""

OPENED = """opened AS (
  SELECT src.* FROM src LEFT JOIN (SELECT * FROM dim WHERE is_current) cur USING (cod_prodotto)
  WHERE cur.cod_prodotto IS NULL OR cur._hash_diff <> src._hash_diff),
numbered AS (
  SELECT *, md5(CAST(cod_prodotto AS VARCHAR)) AS digest,
    CAST('0x' || substr(md5(CAST(cod_prodotto AS VARCHAR)), 1, 3) AS BIGINT) AS bucket FROM opened)"""

APPLIED = f"""{DIM}, {INCOMING}, {OPENED}, applied AS (
  SELECT d.sk_prodotto, d.cod_prodotto, d.nome, d.categoria, d.iva_perc,
    CASE WHEN d.is_current AND s._hash_diff = d._hash_diff THEN s.prezzo_unitario ELSE d.prezzo_unitario END
      AS prezzo_unitario,
    d.valid_from,
    CASE WHEN d.is_current AND s._hash_diff <> d._hash_diff THEN DATE '2024-06-01' ELSE d.valid_to END AS valid_to,
    CASE WHEN d.is_current AND s._hash_diff <> d._hash_diff THEN false ELSE d.is_current END AS is_current,
    d._hash_diff
  FROM dim d LEFT JOIN src s USING (cod_prodotto)
  UNION ALL
  SELECT (SELECT max(sk_prodotto) FROM dim)
      + (row_number() OVER (PARTITION BY bucket ORDER BY digest, cod_prodotto) - 1) * 4096 + bucket + 1,
    cod_prodotto, nome, categoria, iva_perc, prezzo_unitario, DATE '2024-06-01', NULL, true, _hash_diff
  FROM numbered)"""


@query(f"WITH {APPLIED} SELECT * FROM applied")
def scd2_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_dates(_applied(spark, sf_dir))


def _applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = dimension(spark, sf_dir)
    return scd.scd2_apply(before, delivery(spark, sf_dir), SPEC, BATCH_TS, keys.largest(before, SPEC.surrogate))


@query("""WITH d AS (SELECT p_partkey AS cod_prodotto, p_name AS nome, p_type AS categoria, p_size AS iva_perc,
  CAST(p_retailprice AS DECIMAL(10,2)) AS prezzo_unitario, md5(CAST(p_partkey AS VARCHAR)) AS digest FROM part),
b AS (SELECT *, CAST('0x' || substr(digest, 1, 3) AS BIGINT) AS bucket FROM d)
SELECT (row_number() OVER (PARTITION BY bucket ORDER BY digest, cod_prodotto) - 1) * 4096 + bucket + 1 AS sk_prodotto,
  cod_prodotto, nome, categoria, iva_perc, prezzo_unitario, DATE '2024-06-01' AS valid_from,
  CAST(NULL AS DATE) AS valid_to, true AS is_current,
  sha256(concat_ws('||', nome, categoria, CAST(iva_perc AS VARCHAR))) AS _hash_diff FROM b""")
def scd2_initial_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = dimension(spark, sf_dir).filter("is_current").select("cod_prodotto", *SPEC.attributes)
    return _with_dates(scd.scd2_initial(parts, SPEC, BATCH_TS))


@query(f"""WITH {DIM}, {INCOMING}
SELECT CAST(NULL AS BIGINT) AS sk_prodotto, cod_prodotto, nome, categoria, iva_perc, prezzo_unitario,
  DATE '2024-06-01' AS valid_from, CAST(NULL AS DATE) AS valid_to, true AS is_current, _hash_diff
FROM src WHERE NOT EXISTS (SELECT 1 FROM dim WHERE dim.cod_prodotto = src.cod_prodotto AND dim.is_current
  AND dim.categoria <> 'MEDIUM')""")
def scd2_new_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One product type has lost its current versions: they are opened again with the new keys."""
    dim = dimension(spark, sf_dir).filter(~F.col("is_current") | (F.col("categoria") != "MEDIUM"))
    return _with_dates(scd.scd2_new_versions(dim, delivery(spark, sf_dir), SPEC, BATCH_TS))


@query(f"""WITH {DIM}, {INCOMING}
SELECT d.sk_prodotto, d.cod_prodotto, d.nome, d.categoria, d.iva_perc,
  CASE WHEN d.is_current AND s._hash_diff = d._hash_diff THEN s.prezzo_unitario ELSE d.prezzo_unitario END
    AS prezzo_unitario, d.valid_from, d.valid_to, d.is_current, d._hash_diff
FROM dim d LEFT JOIN src s USING (cod_prodotto)""")
def scd1_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_dates(scd.scd1_overwrite(dimension(spark, sf_dir), delivery(spark, sf_dir), SPEC))


@query(f"""WITH {APPLIED} SELECT * FROM applied WHERE is_current""")
def current_dim_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_dates(scd.current_versions(_applied(spark, sf_dir)))


@query(f"""WITH {APPLIED} SELECT sk_prodotto, cod_prodotto, nome, categoria, iva_perc, prezzo_unitario
FROM applied WHERE is_current""")
def gold_dim_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.publish_current(_applied(spark, sf_dir))


PRODUCT_TABLE = ("sk_prodotto BIGINT NOT NULL, cod_prodotto BIGINT NOT NULL, nome STRING, categoria STRING, iva_perc INT, "
                 "prezzo_unitario DECIMAL(10,2), valid_from TIMESTAMP NOT NULL, valid_to TIMESTAMP, is_current BOOLEAN, _hash_diff STRING")


@query(f"""WITH {APPLIED}, {INCOMING.replace('src AS', 'again AS')}
SELECT cod_prodotto, nome, categoria, iva_perc, prezzo_unitario, valid_from, valid_to, is_current, _hash_diff FROM (
  SELECT d.* REPLACE (CASE WHEN d.is_current AND s.cod_prodotto IS NOT NULL THEN s.prezzo_unitario + 1 ELSE d.prezzo_unitario END AS prezzo_unitario)
  FROM (SELECT * FROM applied WHERE valid_from >= DATE '2024-01-01') d
  LEFT JOIN (SELECT * FROM again WHERE cod_prodotto % 97 = 0) s USING (cod_prodotto)) u""")
def scd2_patched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches on a dimension kept by hash bucket: the last touches a few keys, so it writes their buckets alone.

    The first loads the current versions only; surrogate keys follow the buckets and are left out."""
    contract = Contract(f"{scratch_schema(spark)}.dim", PRODUCT_TABLE, key=("sk_prodotto",), surrogate="sk_prodotto")
    known = dimension(spark, sf_dir).filter("is_current").select("cod_prodotto", *SPEC.attributes)
    second = delivery(spark, sf_dir)
    third = second.filter("cod_prodotto % 97 = 0").withColumn(
        "prezzo_unitario", (F.col("prezzo_unitario") + 1).cast("decimal(10,2)"))
    for version, rows, moment in (("first", known, "2024-01-01 00:00:00"), ("second", second, BATCH_TS), ("third", third, "2024-07-01 00:00:00")):
        patched.apply_to_dimension(spark, contract, rows, SPEC, moment, version)
    return _with_dates(spark.table(contract.name).drop("sk_prodotto"))


STORE_SPEC = scd.Scd2Spec(key=("pos_id",), tracked=("cluster", "regione"), overwrite=("saldo",),
                          carried=("nome",), null_safe_hash=True)


@query("""WITH first AS (
  SELECT s_suppkey AS pos_id, nullif(r_name, 'ASIA') AS cluster, n_name AS regione,
    CAST(s_acctbal AS DECIMAL(10,2)) AS saldo, s_name AS nome
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
hashed AS (SELECT *, sha256(concat_ws('||',
    coalesce(CAST(length(cluster) AS VARCHAR) || ':' || cluster, '-'),
    coalesce(CAST(length(regione) AS VARCHAR) || ':' || regione, '-'))) AS _hash_diff FROM first),
second AS (SELECT *, sha256(concat_ws('||',
    coalesce(CAST(length(cluster) AS VARCHAR) || ':' || cluster, '-'),
    coalesce(CAST(length(regione) AS VARCHAR) || ':' || regione, '-'))) AS _hash_diff FROM (
  SELECT pos_id, CASE WHEN saldo < 0 THEN 'chiuso' ELSE cluster END AS cluster, regione,
    CAST(saldo + 10 AS DECIMAL(10,2)) AS saldo, upper(nome) AS nome FROM first) s)
SELECT a.pos_id, a.cluster, a.regione, CASE WHEN a._hash_diff = b._hash_diff THEN b.saldo ELSE a.saldo END AS saldo,
  a.nome, DATE '2024-01-01' AS valid_from, CASE WHEN a._hash_diff <> b._hash_diff THEN DATE '2024-06-01' END AS valid_to,
  a._hash_diff = b._hash_diff AS is_current, a._hash_diff
FROM hashed a JOIN second b USING (pos_id)
UNION ALL
SELECT b.pos_id, b.cluster, b.regione, b.saldo, b.nome, DATE '2024-06-01', NULL, true, b._hash_diff
FROM hashed a JOIN second b USING (pos_id) WHERE a._hash_diff <> b._hash_diff""")
def scd2_apply_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stores with a name that each version keeps from its opening; indebted ones change cluster."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    first = (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").alias("pos_id"), F.nullif("r_name", F.lit("ASIA")).alias("cluster"),
            F.col("n_name").alias("regione"), F.col("s_acctbal").cast("decimal(10,2)").alias("saldo"),
            F.col("s_name").alias("nome"),
        )
    )
    second = first.withColumns({
        "cluster": F.when(F.col("saldo") < 0, "chiuso").otherwise(F.col("cluster")),
        "saldo": (F.col("saldo") + 10).cast("decimal(10,2)"),
        "nome": F.upper("nome"),
    })
    opened = scd.scd2_initial(first, STORE_SPEC, "2024-01-01 00:00:00")
    return _with_dates(scd.scd2_apply(opened, second, STORE_SPEC, BATCH_TS))


EVENT_SPEC = scd.Scd2Spec(key=("user_id",), tracked=("event_type",), overwrite=("value",), carried=("props",))


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last event of each user and day."""
    events = table(spark, sf_dir, "events").select(
        "user_id", F.col("ts").cast("date").alias("day"), "event_type",
        F.col("value").cast("decimal(12,2)").alias("value"), "props", "ts", "event_id")
    return silver.latest_per_key(events, ["user_id", "day"], [F.col("ts").desc(), F.col("event_id").desc()])


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user has at most one snapshot per day, so no chunks are needed."""
    return scd.scd2_history(snapshots(spark, sf_dir), EVENT_SPEC, "day")


HISTORY = """snap AS (
  SELECT user_id, CAST(ts AS DATE) AS day, event_type, CAST(value AS DECIMAL(12,2)) AS value, props FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1),
marked AS (
  SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY day) AS before FROM snap),
runs AS (
  SELECT *, sum(CASE WHEN before IS NULL OR before <> event_type THEN 1 ELSE 0 END)
    OVER (PARTITION BY user_id ORDER BY day) AS run FROM marked),
spans AS (
  SELECT user_id, run, min(event_type) AS event_type, arg_max(value, day) AS value, arg_min(props, day) AS props,
    min(day) AS valid_from FROM runs GROUP BY user_id, run),
history AS (
  SELECT user_id, event_type, value, props, valid_from,
    lead(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from) AS valid_to,
    lead(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from) IS NULL AS is_current,
    sha256(event_type) AS _hash_diff FROM spans)"""


@query(f"WITH {HISTORY} SELECT * FROM history")
def scd2_history_from_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history(spark, sf_dir)


@query("""WITH marked AS (
  SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events),
runs AS (
  SELECT *, sum(CASE WHEN before IS NULL OR before <> event_type THEN 1 ELSE 0 END)
    OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM marked),
spans AS (
  SELECT user_id, run, min(event_type) AS event_type, CAST(arg_max(value, event_id) AS DECIMAL(12,2)) AS value,
    arg_min(props, event_id) AS props, min(ts) AS valid_from FROM runs GROUP BY user_id, run)
SELECT user_id, event_type, value, props, strftime(valid_from, '%Y-%m-%d %H:%M:%S.%f') AS valid_from,
  strftime(lead(valid_from) OVER (PARTITION BY user_id ORDER BY run), '%Y-%m-%d %H:%M:%S.%f') AS valid_to,
  lead(valid_from) OVER (PARTITION BY user_id ORDER BY run) IS NULL AS is_current,
  sha256(event_type) AS _hash_diff FROM spans""")
def scd2_history_from_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is a batch of its own; ten-minute slots cut the rows of a busy user into pieces."""
    log = table(spark, sf_dir, "events").select(
        "user_id", "ts", "event_id", "event_type", F.col("value").cast("decimal(12,2)").alias("value"), "props",
        time_slot(F.col("ts")).alias("slot"))
    versions = scd.scd2_history(log, EVENT_SPEC, ("ts", "event_id"), chunk="slot")
    return versions.withColumns(
        {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in ("valid_from", "valid_to")}
    )


@query(f"WITH {HISTORY} SELECT * FROM history")
def scd2_late_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third day is delivered first, those before them next, those between last: the history is that of the log in order."""
    log = snapshots(spark, sf_dir).withColumn("turn", F.pmod(F.unix_date("day"), F.lit(3)))
    turns = [_stored(log.filter(F.col("turn") == n).drop("turn"), "delivery") for n in (0, 2, 1)]
    dim, seen = scd.scd2_history(turns[0].withColumn("day", F.col("day").cast("timestamp")), EVENT_SPEC, "day"), turns[0]
    for arrivals in turns[1:]:
        dim = _stored(scd.scd2_merge(dim, seen, arrivals, EVENT_SPEC, "day"), "history")
        seen = seen.unionByName(arrivals)
    return _with_dates(dim)


def _stored(df: DataFrame, purpose: str) -> DataFrame:
    """A delivery or a version of a table as it lies in the shared folder."""
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


CUSTOMER_SCHEMA = text_schema(("codice", "nome", "mercato", "segmento"))


@query("""SELECT 'C' || CAST(c_custkey AS VARCHAR) AS codice, c_name AS nome, c_mktsegment AS mercato,
  'standard' AS segmento FROM customer
UNION ALL SELECT 'UNKNOWN', 'Sconosciuto', NULL, 'sconosciuto'""")
def dim_customer_sentinel(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("codice"),
        F.col("c_name").alias("nome"), F.col("c_mktsegment").alias("mercato"), "c_acctbal",
    )
    unknown = {"codice": "UNKNOWN", "nome": "Sconosciuto", "segmento": "sconosciuto"}
    return gold.customer_dimension(customers, ["codice", "nome", "mercato"], unknown, CUSTOMER_SCHEMA)


DATES = """bounds AS (SELECT make_date(year(min(o_orderdate)), 1, 1) AS first_day,
    make_date(year(max(o_orderdate)), 12, 31) AS last_day FROM orders),
days AS (
  SELECT CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS data, last_day FROM bounds),
dim_date AS (
  SELECT CAST(strftime(data, '%Y%m%d') AS INT) AS sk_data, data, CAST(day(data) AS INT) AS giorno,
    CAST(month(data) AS INT) AS mese, CAST(year(data) AS INT) AS anno, CAST(quarter(data) AS INT) AS trimestre,
    CAST(weekofyear(data) AS INT) AS settimana_iso, dayname(data) AS giorno_settimana, monthname(data) AS nome_mese,
    strftime(data, '%m%d') IN ('0101', '0106', '0425', '0501', '0602', '0815', '1101', '1208', '1225', '1226')
      AS festivo_flag,
    (isodow(data) = 1 AND strftime(data - 1, '%m%d') IN
      ('0101', '0106', '0425', '0501', '0602', '0815', '1101', '1208', '1225', '1226'))
    OR (isodow(data) = 5 AND data + 1 <= last_day AND strftime(data + 1, '%m%d') IN
      ('0101', '0106', '0425', '0501', '0602', '0815', '1101', '1208', '1225', '1226')) AS ponte_flag,
    isodow(data) >= 6 AS weekend_flag,
    CAST(CASE WHEN month(data) >= 7 THEN year(data) ELSE year(data) - 1 END AS INT) AS anno_fiscale
  FROM days)"""


def dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar_dim.date_dimension_for(table(spark, sf_dir, "orders"), F.col("o_orderdate").cast("date"))


@query(f"WITH {DATES} SELECT * FROM dim_date")
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar over the years of the orders."""
    return dates(spark, sf_dir)


OLD_PART = """old AS (SELECT p_partkey, p_name, p_brand, p_size, CAST(p_retailprice AS DECIMAL(10,2)) AS price FROM part)"""
NEW_PART = """new AS (
  SELECT p_partkey, p_name, nullif(p_brand, 'Brand#7') AS p_brand,
    p_size, CAST(p_retailprice AS DECIMAL(10,2)) + CASE WHEN p_type = 'LARGE' THEN 1 ELSE 0 END AS price
  FROM part WHERE p_type <> 'SMALL'
  UNION ALL SELECT -p_partkey - 1, p_name, p_brand, p_size, CAST(p_retailprice AS DECIMAL(10,2)) FROM part
  WHERE p_brand = 'Brand#3')"""


def _part_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    price = F.col("p_retailprice").cast("decimal(10,2)")
    part = table(spark, sf_dir, "part")
    old = part.select("p_partkey", "p_name", "p_brand", "p_size", price.alias("price"))
    raised = (price + F.when(F.col("p_type") == "LARGE", 1).otherwise(0)).cast("decimal(10,2)")
    new = part.filter(F.col("p_type") != "SMALL").select(
        "p_partkey", "p_name", F.nullif("p_brand", F.lit("Brand#7")).alias("p_brand"), "p_size", raised.alias("price"))
    added = old.filter(F.col("p_brand") == "Brand#3").withColumn("p_partkey", -F.col("p_partkey") - 1)
    return old, new.unionByName(added)


FEED = f"""{OLD_PART}, {NEW_PART}, feed AS (
  SELECT new.*, 'insert' AS _change_type FROM new WHERE p_partkey NOT IN (SELECT p_partkey FROM old)
  UNION ALL SELECT old.*, 'delete' FROM old WHERE p_partkey NOT IN (SELECT p_partkey FROM new)
  UNION ALL SELECT old.*, 'update_preimage' FROM old JOIN new USING (p_partkey)
    WHERE (old.p_name, old.p_brand, old.p_size, old.price) IS DISTINCT FROM (new.p_name, new.p_brand, new.p_size, new.price)
  UNION ALL SELECT new.*, 'update_postimage' FROM old JOIN new USING (p_partkey)
    WHERE (old.p_name, old.p_brand, old.p_size, old.price) IS DISTINCT FROM (new.p_name, new.p_brand, new.p_size, new.price))"""


@query(f"WITH {FEED} SELECT p_partkey, p_name, p_brand, p_size, CAST(price AS DECIMAL(10,2)) AS price, _change_type FROM feed")
def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdf.change_feed(*_part_versions(spark, sf_dir), ["p_partkey"])


@query(f"WITH {NEW_PART} SELECT p_partkey, p_name, p_brand, p_size, CAST(price AS DECIMAL(10,2)) AS price FROM new")
def change_feed_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed applied to the old version gives the new one."""
    old, new = _part_versions(spark, sf_dir)
    return cdf.apply_changes(old, cdf.change_feed(old, new, ["p_partkey"]), ["p_partkey"])


@query(f"""WITH {OLD_PART}, new AS (
  SELECT p_partkey, p_name, p_brand, p_size, CAST(p_retailprice AS DECIMAL(10,2)) AS price,
    CASE WHEN p_type = 'LARGE' THEN 'big' END AS label FROM part WHERE p_type <> 'SMALL'),
wide AS (SELECT *, CAST(NULL AS VARCHAR) AS label FROM old)
SELECT *, 'delete' AS _change_type FROM wide WHERE p_partkey NOT IN (SELECT p_partkey FROM new)
UNION ALL SELECT *, 'update_preimage' FROM wide WHERE p_partkey IN (SELECT p_partkey FROM new WHERE label IS NOT NULL)
UNION ALL SELECT *, 'update_postimage' FROM new WHERE label IS NOT NULL""")
def change_feed_added_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The new version has one column more."""
    old, _ = _part_versions(spark, sf_dir)
    part = table(spark, sf_dir, "part").filter(F.col("p_type") != "SMALL")
    new = part.select(
        "p_partkey", "p_name", "p_brand", "p_size", F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
        F.when(F.col("p_type") == "LARGE", "big").alias("label"))
    return cdf.change_feed(old, new, ["p_partkey"])


@query(f"WITH {FEED} SELECT p_partkey, p_name, p_brand, p_size, CAST(price AS DECIMAL(10,2)) AS price, _change_type FROM feed")
def change_feed_by_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both versions lie by bucket with their digests; buckets without a change are not read again."""
    stored, sums = [], []
    for df in _part_versions(spark, sf_dir):
        path = work_dir(spark, "version")
        of_key = cdf.bucket_of(["p_partkey"], 64)
        df.withColumn(cdf.BUCKET, of_key).repartition(cdf.BUCKET).write.partitionBy(cdf.BUCKET).parquet(path)
        stored.append(spark.read.schema(df.withColumn(cdf.BUCKET, of_key).schema).parquet(path))
        sums.append(cdf.digests(df, ["p_partkey"], 64))
    return cdf.change_feed_of_buckets(*stored, ["p_partkey"], cdf.changed_buckets(*sums))


STREAMED = text_schema(("user_id", "event_type", "value", "props", "day"))
STREAM_DIM = ("sk BIGINT NOT NULL, user_id BIGINT NOT NULL, event_type STRING, value DECIMAL(12,2), props STRING, "
              "valid_from TIMESTAMP NOT NULL, valid_to TIMESTAMP, is_current BOOLEAN, _hash_diff STRING")


@query(f"WITH {HISTORY} SELECT * FROM history")
def stream_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshots of the users come as files, the newest third of the days first; the stream runs after each."""
    schema, base = scratch_schema(spark), work_dir(spark, "stream")
    log = snapshots(spark, sf_dir).select(
        "user_id", "event_type", "value", "props", "day", F.pmod(F.unix_date("day"), F.lit(3)).alias("turn"))
    seen = Contract(f"{schema}.seen", "user_id BIGINT NOT NULL, event_type STRING, value DECIMAL(12,2), props STRING, day TIMESTAMP, "
                    "_batch_id STRING", partition_by=("_batch_id",), appended=True)
    dim = Contract(f"{schema}.dim", STREAM_DIM, key=("sk",), surrogate="sk")
    spec = replace(EVENT_SPEC, surrogate="sk")
    types = {"user_id": "bigint", "value": "decimal(12,2)", "day": "timestamp"}
    for n in (2, 0, 1):
        rows = log.filter(F.col("turn") == n).drop("turn")
        rows.select(*[F.col(x).cast("string") for x in STREAMED.names]).coalesce(4).write.options(header=True, quote='"', escape='"').csv(
            f"{base}/landing/drop{n}")
        follow_history(spark, f"{base}/landing/*", STREAMED, types, seen, dim, spec, "day", f"{base}/checkpoint", "run")
    return _with_dates(spark.table(dim.name).drop("sk"))


def _with_null_key(old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The row of one key loses it in both versions; that of another in the new one only, which makes it a change of the NULL row."""
    blank = lambda df, k: df.withColumn("p_partkey", F.nullif("p_partkey", F.lit(k).cast("bigint")))
    return blank(old, 11), blank(new.filter("p_partkey <> 11"), 12)


WITH_NULLS = f"""{OLD_PART}, {NEW_PART},
a AS (SELECT nullif(p_partkey, 11) AS p_partkey, p_name, p_brand, p_size, price FROM old),
b AS (SELECT nullif(p_partkey, 12) AS p_partkey, p_name, p_brand, p_size, CAST(price AS DECIMAL(10,2)) AS price FROM new WHERE p_partkey <> 11)"""


@query(f"""WITH {WITH_NULLS}
SELECT b.*, 'insert' AS _change_type FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.p_partkey IS NOT DISTINCT FROM b.p_partkey)
UNION ALL SELECT a.*, 'delete' FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE a.p_partkey IS NOT DISTINCT FROM b.p_partkey)
UNION ALL SELECT a.*, 'update_preimage' FROM a JOIN b ON a.p_partkey IS NOT DISTINCT FROM b.p_partkey
  WHERE (a.p_name, a.p_brand, a.p_size, a.price) IS DISTINCT FROM (b.p_name, b.p_brand, b.p_size, b.price)
UNION ALL SELECT b.*, 'update_postimage' FROM a JOIN b ON a.p_partkey IS NOT DISTINCT FROM b.p_partkey
  WHERE (a.p_name, a.p_brand, a.p_size, a.price) IS DISTINCT FROM (b.p_name, b.p_brand, b.p_size, b.price)""")
def change_feed_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdf.change_feed(*_with_null_key(*_part_versions(spark, sf_dir)), ["p_partkey"])


@query(f"""WITH {WITH_NULLS} SELECT * FROM b""")
def change_feed_null_keys_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _with_null_key(*_part_versions(spark, sf_dir))
    return cdf.apply_changes(old, cdf.change_feed(old, new, ["p_partkey"]), ["p_partkey"])


NULL_KEYS = """log AS (
  SELECT CASE WHEN user_id % 10 <> 0 THEN user_id END AS user_id, ts, event_id, event_type,
    CAST(value AS DECIMAL(12,2)) AS value, props FROM events),
marked AS (
  SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM log),
runs AS (
  SELECT *, sum(CASE WHEN before IS NULL OR before <> event_type THEN 1 ELSE 0 END)
    OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS run FROM marked),
spans AS (
  SELECT user_id, run, min(event_type) AS event_type, arg_max(value, event_id) AS value,
    arg_min(props, event_id) AS props, min(event_id) AS valid_from FROM runs GROUP BY user_id, run)"""


@query(f"""WITH {NULL_KEYS}
SELECT user_id, event_type, value, props, valid_from,
  lead(valid_from) OVER (PARTITION BY user_id ORDER BY run) AS valid_to,
  lead(valid_from) OVER (PARTITION BY user_id ORDER BY run) IS NULL AS is_current, sha256(event_type) AS _hash_diff
FROM spans""")
def scd2_history_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some events have no user, and the first of each user no chunk: no row may be lost."""
    chunk = F.when(F.col("event_id") >= 500, F.floor(F.col("event_id") / 500))
    log = table(spark, sf_dir, "events").select(
        F.when(F.col("user_id") % 10 != 0, F.col("user_id")).alias("user_id"), "event_id", "event_type",
        F.col("value").cast("decimal(12,2)").alias("value"), "props", chunk.alias("slot"))
    return scd.scd2_history(log, EVENT_SPEC, "event_id", chunk="slot")


@query("""WITH known AS (
  SELECT p_partkey AS k, p_size % 3 AS delivery FROM part),
d AS (SELECT k, delivery, md5(CAST(k AS VARCHAR)) AS digest FROM known),
b AS (SELECT *, CAST('0x' || substr(digest, 1, 3) AS BIGINT) AS bucket FROM d),
first AS (SELECT k, (row_number() OVER (PARTITION BY bucket ORDER BY digest, k) - 1) * 4096 + bucket + 1 AS sk FROM b
  WHERE delivery <> 2),
second AS (SELECT * FROM first WHERE k NOT IN (SELECT k FROM known WHERE delivery = 1)),
third AS (
  SELECT * FROM second
  UNION ALL
  SELECT k, (SELECT max(sk) FROM first) + (row_number() OVER (PARTITION BY bucket ORDER BY digest, k) - 1) * 4096 + bucket + 1
  FROM b WHERE delivery = 2)
SELECT 1 AS delivery, * FROM first UNION ALL SELECT 2, * FROM second UNION ALL SELECT 3, * FROM third""")
def surrogate_keys_three_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second delivery lacks a third of the keys, a third one brings new ones: no key gets a second owner."""
    known = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), (F.col("p_size") % 3).alias("delivery"))
    first = keys.strided_keys(known.filter("delivery <> 2").select("k"), ["k"], "sk")
    mark = keys.largest(first, "sk")
    second = keys.keep_keys(known.filter("delivery = 0").select("k"), first, ["k"], "sk", mark)
    third = keys.keep_keys(known.filter("delivery <> 1").select("k"), second, ["k"], "sk", mark)
    rows = [df.select(F.lit(i + 1).alias("delivery"), "k", "sk") for i, df in enumerate((first, second, third))]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])
