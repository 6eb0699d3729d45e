"""Reading and writing landing files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

NULL_MARK = r"\N"


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with header; the schema is given (all text), so nothing is read twice to infer it.

    The header must name the schema's columns: a file with other columns fails.
    """
    return (
        spark.read.schema(schema)
        .options(header=True, enforceSchema=False, mode="PERMISSIVE", quote='"', escape='"')
        .csv(path)
    )


def read_csv_header(spark: SparkSession, path: str) -> DataFrame:
    """CSV whose column names come from its header, all text."""
    return spark.read.options(header=True, inferSchema=False, quote='"', escape='"').csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(header=True, quote='"', escape='"').csv(path)


# Escapes of tab-separated text: a backslash first, so that no other is escaped twice.
ESCAPES = (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r"))


def _escaped(value: Column) -> Column:
    for plain, written in ESCAPES:
        value = F.replace(value, F.lit(plain), F.lit(written))
    return value


def _unescaped(value: Column) -> Column:
    """Between two written backslashes every other escape stands alone."""

    def part(text: Column) -> Column:
        for plain, written in ESCAPES[1:]:
            text = F.replace(text, F.lit(written), F.lit(plain))
        return text

    return F.array_join(F.transform(F.split(value, r"\\\\", -1), part), "\\")


def read_tsv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    r"""Tab-separated text where \N is NULL and an empty field is the empty string.

    Read as lines: the CSV reader would turn both into NULL. Backslash, tab, line feed and carriage return are
    escaped by a backslash. A line with another number of fields fails the job.
    """
    fields = F.split("value", "\t", -1)
    wrong = F.concat(F.lit(f"{len(columns)} fields expected: "), F.col("value"))
    checked = F.when(F.size(fields) == len(columns), fields).otherwise(F.raise_error(wrong).cast("array<string>"))
    return spark.read.option("lineSep", "\n").text(path).select(checked.alias("f")).select(*[
        F.when(F.col("f")[i] != NULL_MARK, _unescaped(F.col("f")[i])).alias(c) for i, c in enumerate(columns)
    ])


def write_tsv(df: DataFrame, path: str) -> None:
    r"""Tab-separated text with \N for NULL; the text \N itself is written with its backslash escaped."""
    fields = [F.coalesce(_escaped(F.col(c).cast("string")), F.lit(NULL_MARK)) for c in df.columns]
    df.select(F.concat_ws("\t", *fields).alias("value")).write.mode("overwrite").option("lineSep", "\n").text(path)
