"""Table contracts of the retail warehouse: columns, types, keys, partitioning.

Column names, types and value formats are fixed values of the data model.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from layerhouse.operators.scd import Scd2Spec


@dataclass(frozen=True)
class Contract:
    """``ddl`` lists the columns; NOT NULL there makes a column required.

    ``appended`` tables grow by batches, the others are replaced version by version. ``surrogate`` names the
    column whose values are given out once and never again.
    """

    name: str
    ddl: str
    key: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    appended: bool = False
    surrogate: str | None = None

    @cached_property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Columns of the contract, in its order and types.

    A missing optional column becomes NULL; a missing required one is an error at once.
    """
    absent = [c for c in contract.required if c not in df.columns]
    if absent:
        raise ValueError(f"{contract.name}: required columns are missing: {', '.join(absent)}")
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in contract.schema.fields
    ])


AUDIT = "_ingestion_ts TIMESTAMP, _source_file STRING, _batch_id STRING"

# Landing files: all text.
SOURCE_COLUMNS = {
    "punti_vendita": ("pos_id", "nome", "indirizzo", "cluster", "regione", "manager", "telefono", "data_apertura"),
    "prodotti": ("cod_prodotto", "nome", "categoria", "prezzo_unitario", "iva_perc"),
    "clienti": ("codice_fiscale", "nome", "cognome", "email", "telefono", "citta", "provincia",
                "tessera_fedelta", "data_registrazione"),
    "ordini": ("order_id", "pos_id", "codice_fiscale", "data_ordine", "ora_ordine"),
    "vendite": ("order_id", "line_num", "cod_prodotto", "quantita", "prezzo_unitario", "importo_riga"),
}


def text_schema(columns) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def _raw(table: str) -> str:
    return ", ".join(f"{c} STRING" for c in SOURCE_COLUMNS[table]) + ", " + AUDIT


BRONZE_ORDERS = Contract("brz_sales.ordini_raw", _raw("ordini"), partition_by=("_batch_id",), appended=True)
BRONZE_LINES = Contract("brz_sales.vendite_raw", _raw("vendite"), partition_by=("_batch_id",), appended=True)

SILVER_ORDERS = Contract(
    "slv_sales.ordini",
    "order_id STRING NOT NULL, pos_id STRING NOT NULL, codice_fiscale STRING, data_ordine DATE NOT NULL, "
    "ora_ordine STRING, _ingestion_ts TIMESTAMP, _batch_id STRING",
    key=("order_id",),
)
SILVER_LINES = Contract(
    "slv_sales.vendite",
    "order_id STRING NOT NULL, line_num INT NOT NULL, cod_prodotto STRING NOT NULL, quantita INT NOT NULL, "
    "prezzo_unitario DECIMAL(10,2), importo_riga DECIMAL(10,2), _ingestion_ts TIMESTAMP, _batch_id STRING",
    key=("order_id", "line_num"),
)
SILVER_CUSTOMERS = Contract(
    "slv_customer.clienti",
    "codice_fiscale STRING NOT NULL, nome STRING, cognome STRING, email STRING, telefono STRING, citta STRING, "
    "provincia STRING, tessera_fedelta STRING, data_registrazione DATE, _ingestion_ts TIMESTAMP",
    key=("codice_fiscale",),
)

VERSION_COLUMNS = "valid_from TIMESTAMP NOT NULL, valid_to TIMESTAMP, is_current BOOLEAN, _hash_diff STRING"
DIM_PRODUCT = Contract(
    "slv_sales.dim_prodotto",
    "sk_prodotto BIGINT NOT NULL, cod_prodotto STRING NOT NULL, nome STRING, categoria STRING, "
    "prezzo_unitario DECIMAL(10,2), iva_perc INT, " + VERSION_COLUMNS,
    key=("sk_prodotto",), surrogate="sk_prodotto",
)
DIM_STORE = Contract(
    "slv_sales.dim_punto_vendita",
    "sk_punto_vendita BIGINT NOT NULL, pos_id STRING NOT NULL, nome STRING, indirizzo STRING, cluster STRING, "
    "regione STRING, manager STRING, telefono STRING, data_apertura DATE, " + VERSION_COLUMNS,
    key=("sk_punto_vendita",), surrogate="sk_punto_vendita",
)
# The roles of the dimensions' columns.
PRODUCT_SPEC = Scd2Spec(
    key=("cod_prodotto",), tracked=("nome", "categoria", "iva_perc"),
    overwrite=("prezzo_unitario",), surrogate="sk_prodotto",
)
STORE_SPEC = Scd2Spec(
    key=("pos_id",), tracked=("indirizzo", "cluster", "manager"), overwrite=("telefono",),
    carried=("nome", "regione", "data_apertura"), surrogate="sk_punto_vendita",
)

FACT_DAILY_SALES = Contract(
    "gld_sales.fact_vendite_giornaliere",
    "sk_data INT NOT NULL, sk_prodotto BIGINT NOT NULL, sk_punto_vendita BIGINT NOT NULL, sk_cliente BIGINT, "
    "n_transazioni INT NOT NULL, quantita_totale INT NOT NULL, importo_lordo DECIMAL(12,2) NOT NULL, "
    "importo_netto DECIMAL(12,2), sconto_totale DECIMAL(12,2)",
    key=("sk_data", "sk_prodotto", "sk_punto_vendita"), partition_by=("sk_data",),
)
GOLD_CUSTOMER = Contract(
    "gld_customer.dim_cliente",
    "sk_cliente BIGINT NOT NULL, codice_fiscale STRING NOT NULL, nome STRING, cognome STRING, citta STRING, "
    "provincia STRING, tessera_fedelta STRING, segmento STRING, data_registrazione DATE",
    key=("sk_cliente",), surrogate="sk_cliente",
)
GOLD_DATE = Contract(
    "gld_sales.dim_data",
    "sk_data INT NOT NULL, data DATE, giorno INT, mese INT, anno INT, trimestre INT, settimana_iso INT, "
    "giorno_settimana STRING, nome_mese STRING, festivo_flag BOOLEAN, ponte_flag BOOLEAN, "
    "weekend_flag BOOLEAN, anno_fiscale INT",
    key=("sk_data",),
)
GOLD_PRODUCT = Contract(
    "gld_sales.dim_prodotto",
    "sk_prodotto BIGINT NOT NULL, cod_prodotto STRING NOT NULL, nome STRING, categoria STRING, "
    "prezzo_unitario DECIMAL(10,2), iva_perc INT",
    key=("sk_prodotto",),
)
GOLD_STORE = Contract(
    "gld_sales.dim_punto_vendita",
    "sk_punto_vendita BIGINT NOT NULL, pos_id STRING NOT NULL, nome STRING, indirizzo STRING, cluster STRING, "
    "regione STRING, manager STRING, telefono STRING, data_apertura DATE",
    key=("sk_punto_vendita",),
)

# Casts of the raw text columns.
ORDER_TYPES = {"data_ordine": "date"}
LINE_TYPES = {"line_num": "int", "quantita": "int", "prezzo_unitario": "decimal(10,2)",
              "importo_riga": "decimal(10,2)"}
PRODUCT_TYPES = {"prezzo_unitario": "decimal(10,2)", "iva_perc": "int"}
STORE_TYPES = {"data_apertura": "date"}
CUSTOMER_TYPES = {"data_registrazione": "date"}

# The published attributes of customers, and the row for sales without a known customer.
CUSTOMER_ATTRIBUTES = ("codice_fiscale", "nome", "cognome", "citta", "provincia", "tessera_fedelta",
                       "data_registrazione")
UNKNOWN_CUSTOMER = {"codice_fiscale": "UNKNOWN", "nome": "Sconosciuto", "cognome": "Sconosciuto",
                    "segmento": "sconosciuto"}
UNKNOWN_CUSTOMER_SCHEMA = text_schema(
    ("codice_fiscale", "nome", "cognome", "citta", "provincia", "tessera_fedelta", "segmento")
).add("data_registrazione", DateType())

SCHEMAS = ("brz_sales", "slv_sales", "slv_customer", "gld_sales", "gld_customer")
