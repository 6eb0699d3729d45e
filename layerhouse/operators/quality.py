"""Model checks. Each gives the violations (or a one-row comparison) as a DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from layerhouse.operators.scd import IS_CURRENT


def duplicate_groups(df: DataFrame, key: Sequence[str | Column]) -> DataFrame:
    """Keys with more than one row: the grain of a fact, or any primary key."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def orphan_keys(child: DataFrame, foreign_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Foreign keys without parent and their number of rows; NULL counts as one such key.

    The child is counted per key first, so the join sees each key once.
    """
    counts = child.groupBy(foreign_key).agg(F.count(F.lit(1)).alias("n"))
    parents = parent.select(F.col(parent_key).alias("_parent"))
    return counts.join(parents, counts[foreign_key] == F.col("_parent"), "left_anti")


def orphans(child: DataFrame, parents: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows (foreign_key, value, n): the keys without parent of all foreign keys of a table, from one scan of it.

    ``parents`` names for each foreign key the parent table and its key, of the same type; values are shown as text.
    Rows are counted per key and value before the one join. NULL counts as one such value.
    """
    shown = lambda c: F.col(f"`{c}`").cast("string").alias("value")
    pairs = F.array(*[F.struct(F.lit(c).alias("foreign_key"), shown(c)) for c in parents])
    counts = child.select(F.explode(pairs).alias("_p")).groupBy("_p.foreign_key", "_p.value").agg(F.count(F.lit(1)).alias("n"))
    known = [parent.select(F.lit(c).alias("foreign_key"), shown(key)) for c, (parent, key) in parents.items()]
    return counts.join(reduce(DataFrame.unionByName, known), ["foreign_key", "value"], "left_anti")


def reconcile(left: DataFrame, left_amount: Column, right: DataFrame, right_amount: Column,
              left_name: str = "tot_brz", right_name: str = "tot_gld") -> DataFrame:
    """Two totals side by side and their distance, as one row."""
    a = left.agg(F.sum(left_amount).cast("decimal(22,2)").alias(left_name))
    total = right.agg(F.sum(right_amount).cast("decimal(22,2)"))
    distance = F.abs(F.col(left_name) - F.col(right_name)).cast("decimal(22,2)")
    return a.withColumn(right_name, total.scalar()).withColumn("delta", distance)


def not_one_current(dim: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys whose number of current versions is not one, those without any included."""
    return (
        dim.groupBy(*key)
        .agg(F.count_if(F.col(IS_CURRENT)).alias("n_current"))
        .filter(F.col("n_current") != 1)
    )


def null_counts(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Number of NULLs per required column, in one pass; columns without NULLs are left out."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null")) for c in required])
    return counted.select(F.explode(pairs).alias("_p")).select("_p.*").filter(F.col("n_null") > 0)


def days_held(dates: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Days of the date dimension within the years."""
    kept = dates.filter(F.col("anno").between(first_year, last_year))
    return kept.agg(F.count(F.lit(1)).alias("n_giorni"))


def missing_days(expected: DataFrame, expected_day: str, found: DataFrame, found_day: str) -> DataFrame:
    """Expected days that do not occur."""
    have = found.select(F.col(found_day).alias("_day")).distinct()
    return expected.select(expected_day).join(have, F.col(expected_day) == F.col("_day"), "left_anti")


def constraints(df: DataFrame, key: Sequence[str], required: Sequence[str] = (), totals: Mapping[str, Column] | None = None,
                conditions: Mapping[str, Column] | None = None) -> DataFrame:
    """All counts and sums that the checks of one table need, from one scan and one aggregate by key.

    Rows (check_name, value): rows; "key" (keys with more than one row); "null <column>"; "not <condition>" (rows for which a
    condition does not hold, NULL included); "sum <total>". Violations of the first kinds are listed by
    ``duplicate_groups`` and the like, where their number is not zero.
    """
    totals, conditions = totals or {}, conditions or {}
    found = {f"null {c}": F.count_if(F.col(c).isNull()) for c in required}
    found |= {f"not {name}": F.count_if(~F.coalesce(holds, F.lit(False))) for name, holds in conditions.items()}
    found |= {f"sum {name}": F.sum(value) for name, value in totals.items()}
    names = list(found)
    by_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), *[found[name].alias(f"_v{i}") for i, name in enumerate(names)])
    whole = by_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("_rows"), F.count_if(F.col("_n") > 1).alias("_twice"),
        *[F.coalesce(F.sum(f"_v{i}"), F.lit(0)).alias(f"_v{i}") for i in range(len(names))])
    number = lambda c: F.col(c).cast("decimal(38,2)")
    pairs = [("rows", "_rows"), ("key", "_twice"), *[(name, f"_v{i}") for i, name in enumerate(names)]]
    rows = F.array(*[F.struct(F.lit(name).alias("check_name"), number(c).alias("value")) for name, c in pairs])
    return whole.select(F.explode(rows).alias("_p")).select("_p.*")
