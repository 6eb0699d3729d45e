"""Date dimension and its coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from layerhouse.functions.dates import date_key, fiscal_year, is_bridge_day, is_fixed_holiday


def date_dimension(spark: SparkSession, first_year: int = 2020, last_year: int = 2030) -> DataFrame:
    """One row per day of the years, both ends included."""
    years = spark.range(1).select(
        F.lit(first_year).alias("first_year"), F.lit(last_year).alias("last_year")
    )
    return _days(years)


def date_dimension_for(df: DataFrame, day: Column) -> DataFrame:
    """Date dimension over the full years that the data touches."""
    return _days(df.agg(F.year(F.min(day)).alias("first_year"), F.year(F.max(day)).alias("last_year")))


def _days(years: DataFrame) -> DataFrame:
    first = F.make_date("first_year", F.lit(1), F.lit(1))
    last = F.make_date("last_year", F.lit(12), F.lit(31))
    days = years.select(
        F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("data"), last.alias("_last")
    )
    d = F.col("data")
    return days.select(
        date_key(d).alias("sk_data"),
        d,
        F.dayofmonth(d).alias("giorno"),
        F.month(d).alias("mese"),
        F.year(d).alias("anno"),
        F.quarter(d).alias("trimestre"),
        F.weekofyear(d).alias("settimana_iso"),
        F.date_format(d, "EEEE").alias("giorno_settimana"),
        F.date_format(d, "MMMM").alias("nome_mese"),
        is_fixed_holiday(d).alias("festivo_flag"),
        is_bridge_day(d, F.col("_last")).alias("ponte_flag"),
        (F.weekday(d) >= 5).alias("weekend_flag"),
        fiscal_year(d).alias("anno_fiscale"),
    )
