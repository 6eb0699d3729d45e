"""Sinks, catalogue, and the whole pipeline from generated files to checked tables."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from layerhouse import contracts as c
from layerhouse.__main__ import execute, parse
from layerhouse.operators import calendar_dim, gold
from layerhouse.operators.keys import keep_keys, strided_keys
from layerhouse.plans import generate, warehouse
from layerhouse.sources import change_log, landing, tables
from layerhouse.streaming.incremental import ingest_new_files

N_PRODUCTS, N_CUSTOMERS, N_ORDERS = 60, 200, 1500


@pytest.fixture(scope="module")
def first_run(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("landing"))
    generate.write_landing(spark, path, N_PRODUCTS, N_CUSTOMERS, N_ORDERS)
    return path, warehouse.run(spark, path, "b1", "2025-01-01 06:00:00")


def empty(checks, names):
    return {name: checks[name].count() for name in names}


VIOLATIONS = ("grain", "orphan_products", "orphan_stores", "orphan_days", "one_current_product", "one_current_store",
              "dropped_lines", "silver_differs")


def test_first_run(spark, first_run):
    path, written = first_run
    assert written["brz_sales.ordini_raw"] == written["slv_sales.ordini"] == N_ORDERS
    assert written["brz_sales.vendite_raw"] == written["slv_sales.vendite"]
    assert written["slv_sales.dim_prodotto"] == N_PRODUCTS and written["slv_sales.dim_punto_vendita"] == 50
    assert written["gld_customer.dim_cliente"] == N_CUSTOMERS + 1 and written["gld_sales.dim_data"] == 4018
    assert spark.table("gld_sales.fact_vendite_giornaliere").count() == written["gld_sales.fact_vendite_giornaliere"]
    found = warehouse.checks(spark)
    assert set(empty(found, VIOLATIONS).values()) == {0}
    raw = found["raw_total"].first()
    assert raw.delta == Decimal("0.00") and raw.tot_brz > 0
    assert found["silver_total"].first().delta == Decimal("0.00")
    assert found["days"].first().n_giorni == 731
    assert {n: df.count() for n, df in warehouse.contract_checks(spark).items() if df.count()} == {}


def test_generated_values(spark, first_run):
    lines = spark.table("slv_sales.vendite")
    per_order = lines.groupBy("order_id").agg(F.count("*").alias("n"), F.count_distinct("cod_prodotto").alias("d"),
                                              F.max("line_num").alias("m"))
    assert per_order.count() == N_ORDERS
    assert per_order.filter("n <> d OR n <> m OR n > 12").count() == 0
    assert lines.filter("quantita < 1 OR quantita > 5 OR importo_riga <> quantita * prezzo_unitario").count() == 0
    assert spark.table("slv_sales.ordini").filter(~F.col("ora_ordine").rlike("^(0[89]|1[0-9]|2[01]):[0-5][0-9]:00$")).count() == 0
    shares = dict(spark.table("slv_sales.ordini").join(spark.table("slv_sales.dim_punto_vendita"), "pos_id")
                  .groupBy("cluster").count().collect())
    assert abs(shares["Nord-Ovest"] / N_ORDERS - 0.35) < 0.05 and abs(shares["Isole"] / N_ORDERS - 0.05) < 0.03


def test_fact_is_partitioned_and_pruned(spark, first_run):
    fact = spark.table("gld_sales.fact_vendite_giornaliere").filter("sk_data = 20240301")
    assert fact.count() > 0
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sk_data" in plan
    assert all("sk_data=20240301" in f for f in fact.inputFiles()) and fact.inputFiles()


def test_second_run_with_changes(spark, first_run, tmp_path):
    """The same orders delivered again, one product renamed, all prices raised."""
    path, written = first_run
    second = str(tmp_path / "landing")
    for table in c.SOURCE_COLUMNS:
        df = landing.read_csv(spark, f"{path}/{table}.csv", c.text_schema(c.SOURCE_COLUMNS[table]))
        if table == "prodotti":
            df = df.withColumns({
                "nome": F.when(F.col("cod_prodotto") == "P-00001", "Nuovo").otherwise(F.col("nome")),
                "prezzo_unitario": (F.col("prezzo_unitario").cast("decimal(10,2)") + 1).cast("string")})
        landing.write_csv(df, f"{second}/{table}.csv")
    before = {r.cod_prodotto: r.sk_prodotto for r in spark.table("slv_sales.dim_prodotto").collect()}
    raw_before = spark.table("brz_sales.ordini_raw").count()
    customers = lambda: {r.codice_fiscale: r.sk_cliente for r in spark.table("gld_customer.dim_cliente").collect()}
    customer_keys = customers()
    again = warehouse.run(spark, second, "b2", "2025-01-02 06:00:00")
    assert spark.table("brz_sales.ordini_raw").count() == raw_before + N_ORDERS
    assert again["slv_sales.ordini"] == N_ORDERS
    assert customers() == customer_keys
    dim = spark.table("slv_sales.dim_prodotto")
    versions = [(r.nome == "Nuovo", r.is_current, r.sk_prodotto == before["P-00001"])
                for r in dim.filter("cod_prodotto = 'P-00001'").collect()]
    assert sorted(versions) == [(False, False, True), (True, True, False)]
    assert dim.count() == N_PRODUCTS + 1
    assert {r.sk_prodotto == before[r.cod_prodotto] for r in dim.filter("cod_prodotto <> 'P-00001'").collect()} == {True}
    found = warehouse.checks(spark)
    assert set(empty(found, VIOLATIONS).values()) == {0}
    assert found["raw_total"].first().delta > 0
    assert found["silver_total"].first().delta == Decimal("0.00")

    # The same batch once more changes nothing, and old versions can go.
    state = lambda name: sorted(map(tuple, spark.table(name).collect()), key=repr)
    held = {n: state(n) for n in ("slv_sales.dim_prodotto", "gld_sales.fact_vendite_giornaliere", "slv_sales.vendite")}
    warehouse.run(spark, second, "b2", "2025-01-02 06:00:00")
    assert {n: state(n) for n in held} == held
    dropped = tables.drop_old_versions(spark, c.DIM_PRODUCT)
    assert [name[:-9] for name in dropped] == ["slv_sales.dim_prodotto__b1", "slv_sales.dim_prodotto__b2"]
    assert state("slv_sales.dim_prodotto") == held["slv_sales.dim_prodotto"]


def test_catalogue(spark, first_run):
    assert "ordini_raw" in tables.list_tables(spark, "brz_sales")
    assert {"dim_cliente"} <= set(tables.list_tables(spark, "gld_customer"))
    types = dict(spark.table("gld_sales.fact_vendite_giornaliere").dtypes)
    assert [types[f.name] for f in c.FACT_DAILY_SALES.schema.fields] == [
        f.dataType.simpleString() for f in c.FACT_DAILY_SALES.schema.fields]
    with pytest.raises(ValueError):
        tables.publish(spark.range(1), c.GOLD_DATE, "no-dash")


def test_malformed_values_are_listed(spark, first_run, tmp_path):
    """A broken delivery of one order and one line: NULL in the typed layer, listed as rejects."""
    path = str(tmp_path / "broken")
    for table, row in (("ordini", ("ORD-BROKEN", "IT-MI-001", "CF", "2024-13-45", "08:00:00")),
                       ("vendite", ("ORD-BROKEN", "1", "P-00001", "two", "1.00", "2.00")),
                       ("clienti", ("CF", "N", "C", "e", "t", "c", "MI", None, "2024-01-01"))):
        columns = c.SOURCE_COLUMNS[table]
        landing.write_csv(spark.createDataFrame([row], c.text_schema(columns)), f"{path}/{table}.csv")
    assert all(df.count() == 0 for df in warehouse.rejects(spark).values())
    warehouse.ingest_bronze(spark, path, "broken", "2025-01-03 06:00:00")
    found = {name: [(r.column_name, r.raw_value, r._batch_id) for r in df.collect()]
             for name, df in warehouse.rejects(spark).items()}
    assert found == {"brz_sales.ordini_raw": [("data_ordine", "2024-13-45", "broken")],
                     "brz_sales.vendite_raw": [("quantita", "two", "broken")]}
    held = {n: spark.table(n).count() for n in ("slv_sales.ordini", "slv_sales.vendite")}
    written = warehouse.build_silver(spark, path, "broken", "2025-01-03 06:00:00")
    assert written["slv_sales.ordini"] == written["slv_sales.vendite"] == -1
    assert {n: spark.table(n).count() for n in held} == held  # the old versions stay in view
    assert {n: df.count() for n, df in warehouse.contract_checks(spark).items() if df.count()} == {}
    kept = [t for t in tables.list_tables(spark, "slv_sales") if "rejects" in t]
    assert sorted(t.split("__")[0] for t in kept) == ["ordini", "vendite"]
    rejected = {t.split("__")[0]: [r.order_id for r in spark.table(f"slv_sales.{t}").collect()] for t in kept}
    assert rejected == {"ordini": ["ORD-BROKEN"], "vendite": ["ORD-BROKEN"]}


def test_lines_are_in_the_fact_or_listed_as_dropped(spark, first_run):
    lines, orders = spark.table("slv_sales.vendite"), spark.table("slv_sales.ordini")
    products = spark.table("slv_sales.dim_prodotto").withColumn("is_current", F.col("is_current") & (F.col("sk_prodotto") % 7 != 0))
    heads = orders.filter(F.crc32(F.col("order_id").cast("binary")) % 5 != 0)
    lost = gold.dropped_lines(lines, heads, products, spark.table("slv_sales.dim_punto_vendita"))
    fact = gold.daily_sales_fact(lines, heads, products, spark.table("slv_sales.dim_punto_vendita"))
    assert {r.missing for r in lost.select("missing").distinct().collect()} == {"order", "product"}
    amount = lambda df, column: df.agg(F.sum(column)).first()[0]
    once = lost.dropDuplicates(["order_id", "line_num"])
    assert amount(fact, "importo_lordo") + amount(once, "importo_riga") == amount(lines, "importo_riga")


def test_customer_keys_have_one_owner_over_three_deliveries(spark):
    """The customers with the largest keys leave, then new ones arrive."""
    contract = c.Contract("default.clienti_k", "sk BIGINT NOT NULL, k BIGINT NOT NULL", key=("sk",), surrogate="sk")
    owners: dict = {}
    for version, (first, last) in enumerate(((0, 300), (0, 100), (0, 500))):
        incoming = spark.range(first, last).select(F.col("id").alias("k"))
        if version:
            numbered = keep_keys(incoming, spark.table(contract.name), ["k"], "sk", tables.high_water(spark, contract))
        else:
            numbered = strided_keys(incoming, ["k"], "sk")
        tables.publish(numbered, contract, f"v{version}")
        for r in spark.table(contract.name).collect():
            owners.setdefault(r.sk, set()).add(r.k)
    assert {len(x) for x in owners.values()} == {1}


def test_created_tables_can_be_replaced_and_cleaned(spark):
    contract = c.Contract("default.date_x", c.GOLD_DATE.ddl, key=("sk_data",))
    tables.create_table(spark, contract)
    tables.create_table(spark, contract)
    assert spark.table(contract.name).count() == 0
    tables.publish(calendar_dim.date_dimension(spark, 2024, 2024), contract, "v1")
    assert spark.table(contract.name).count() == 366 and tables.version_before(spark, contract).count() == 0
    assert len(tables.drop_old_versions(spark, contract)) == 1 and tables.version_before(spark, contract) is None


def test_changes_of_the_orders(spark, first_run):
    feed = warehouse.order_changes(spark)
    assert feed is None or feed.columns == [*c.SILVER_ORDERS.columns, "_change_type"]


def test_report_finds_what_the_checks_find(spark, first_run):
    apart = {f"{n} quarantined": df for n, df in warehouse.quarantined(spark).items()}
    expected = {**warehouse.checks(spark), **warehouse.contract_checks(spark), **warehouse.rejects(spark), **apart}
    found = warehouse.report(spark)
    assert found.pop("orphans") == sum(found[n] for n in ("orphan_products", "orphan_stores", "orphan_days"))
    assert found == {name: df.count() for name, df in expected.items()}
    for name in warehouse.INFORMATION:
        assert spark.table(f"qa.{name}").collect() == expected[name].collect()


def test_change_log_over_skipped_and_cleaned_versions(spark):
    contract = c.Contract("default.logged", "k BIGINT, v STRING", key=("k",))
    rows = lambda *pairs: spark.createDataFrame(list(pairs), "k long, v string")
    state = lambda df: sorted(map(tuple, df.collect()), key=repr)
    versions = [[(1, "a"), (2, "b"), (None, "n")], [(1, "a"), (3, "c"), (None, None)], [(2, "again"), (3, "c")], [(3, "d")]]
    assert change_log.record(spark, contract) == 0  # nothing published yet
    sizes = []
    for n, pairs in enumerate(versions):
        tables.publish(rows(*pairs), contract, f"v{n}")
        if n != 1:  # this version is passed over
            sizes.append(change_log.record(spark, contract))
            assert change_log.record(spark, contract) == 0
        tables.drop_old_versions(spark, contract, keep=[change_log.last_recorded(spark, contract)])
    assert sizes == [3, 5, 3]  # 3 rows; 1 and NULL go, 2 changes, 3 comes; 2 goes, 3 changes
    assert [state(change_log.as_recorded(spark, contract, n)) for n in (1, 2, 3)] == [
        sorted(versions[n], key=repr) for n in (0, 2, 3)]
    assert state(change_log.as_recorded(spark, contract)) == state(spark.table(contract.name))
    spark.sql(f"DROP TABLE {change_log.last_recorded(spark, contract)}")
    tables.publish(rows((9, "z")), contract, "v9")
    with pytest.raises(ValueError, match="is gone"):
        change_log.record(spark, contract)


def test_change_step_adds_to_the_log(spark, first_run, capsys):
    assert execute(spark, parse(["changes"])) == 0 and execute(spark, parse(["changes"])) == 0
    assert "slv_sales.ordini_change_log: 0 rows added" in capsys.readouterr().out
    assert change_log.as_recorded(spark, c.SILVER_ORDERS).count() == spark.table(c.SILVER_ORDERS.name).count()


def test_check_step_lists_every_violation(spark, first_run, capsys):
    before = spark.table("gld_sales.dim_data")
    held = before.count()
    try:
        tables.publish(before.filter("anno <> 2023"), c.GOLD_DATE, "short")
        assert execute(spark, parse(["check"])) == 1
        assert spark.table("qa.orphan_days").count() > 20
    finally:
        tables.publish(calendar_dim.date_dimension(spark, 2020, 2030), c.GOLD_DATE, "whole")
    assert spark.table("gld_sales.dim_data").count() == held
    assert "orphan_days" in capsys.readouterr().out


def test_large_partitions_are_cut(spark, tmp_path):
    fact = spark.range(200_000).select(F.lit(20240101).alias("sk_data"), F.col("id"), F.rand(1).alias("r"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        contract = c.Contract("x", "sk_data INT, id BIGINT, r DOUBLE", key=("sk_data", "id"), partition_by=("sk_data",))
        tables.clustered(fact, contract).write.partitionBy("sk_data").parquet(str(tmp_path / "hot"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(spark.read.parquet(str(tmp_path / "hot")).inputFiles()) > 2


def test_append_is_idempotent_per_batch(spark):
    contract = c.Contract("default.raw_x", "v STRING, _batch_id STRING", partition_by=("_batch_id",), appended=True)
    load = lambda n, b: tables.append_batch(spark.range(n).select(F.col("id").cast("string").alias("v"), F.lit(b).alias("_batch_id")), contract, b)
    assert [load(3, "a"), load(2, "b"), load(3, "a")] == [3, 2, 3]
    assert dict(spark.table("default.raw_x").groupBy("_batch_id").count().collect()) == {"a": 3, "b": 2}


def test_tsv_keeps_null_and_empty(spark, tmp_path):
    df = spark.createDataFrame([("1", None, ""), ("2", "", "x"), ("3", "a b", None), ("a\tb", "\\N", "\\\\t\t\\"),
                                ("x\ny", "\r\n", "\\n\\"), ("\\", "\\\\", "é")], "a string, b string, c string")
    landing.write_tsv(df, str(tmp_path / "t"))
    back = landing.read_tsv(spark, str(tmp_path / "t"), df.columns)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    with pytest.raises(Exception, match="2 fields expected"):
        landing.read_tsv(spark, str(tmp_path / "t"), ["a", "b"]).collect()


def test_csv_keeps_commas_quotes_and_checks_header(spark, tmp_path):
    df = spark.createDataFrame([("1", 'Via "A", 3'), ("2", None)], "id string, addr string")
    landing.write_csv(df, str(tmp_path / "c"))
    back = landing.read_csv(spark, str(tmp_path / "c"), c.text_schema(["id", "addr"]))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    assert landing.read_csv_header(spark, str(tmp_path / "c")).columns == ["id", "addr"]
    with pytest.raises(Exception):
        landing.read_csv(spark, str(tmp_path / "c"), c.text_schema(["id", "other"])).collect()


def test_new_files_are_loaded_once(spark, tmp_path):
    tables.create_schemas(spark, ["stream_raw"])
    contract = c.Contract("stream_raw.ordini_raw", c.BRONZE_ORDERS.ddl, partition_by=("_batch_id",), appended=True)
    folder, check = str(tmp_path / "in"), str(tmp_path / "check")
    columns = c.SOURCE_COLUMNS["ordini"]

    def deliver(first, n):
        rows = spark.range(first, first + n).select(*[F.concat(F.lit(x), F.col("id").cast("string")).alias(x) for x in columns])
        rows.coalesce(1).write.mode("append").option("header", True).csv(folder)

    deliver(0, 5)
    args = (spark, folder, "ordini", contract, check, "r1", "2025-01-01 06:00:00")
    assert ingest_new_files(*args) == 5
    assert ingest_new_files(*args) == 0
    deliver(5, 3)
    assert ingest_new_files(*args) == 3
    assert spark.table(contract.name).count() == 8
    assert spark.table(contract.name).select("_batch_id").distinct().count() == 2
    swapped = spark.range(1).select(*[F.lit("v").alias(x) for x in (columns[1], columns[0], *columns[2:])])
    swapped.coalesce(1).write.mode("append").option("header", True).csv(folder)
    with pytest.raises(Exception):
        ingest_new_files(*args)
    assert spark.table(contract.name).count() == 8
