"""Slowly changing dimensions of type 1 and 2 on plain tables.

A dimension row carries ``valid_from``, ``valid_to`` (NULL while current), ``is_current`` and
``_hash_diff`` over its tracked attributes. For one incoming batch:

  incoming  current  hash       result
  yes       no       -          new current row
  yes       yes      equal      row kept, overwrite attributes replaced
  yes       yes      different  row closed as it is, new current row opened
  no        yes      -          untouched; a missing key is not closed
  any       closed   -          untouched

Attributes that are neither tracked nor overwritten keep the value their version began with.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from layerhouse.functions.hashing import hash_diff
from layerhouse.operators.as_of import VALID_FROM, VALID_TO, with_version
from layerhouse.operators.keys import number_missing, strided_keys
from layerhouse.operators.neighbours import with_next, with_previous

IS_CURRENT, HASH = "is_current", "_hash_diff"
TECHNICAL = (VALID_FROM, VALID_TO, IS_CURRENT, HASH)


@dataclass(frozen=True)
class Scd2Spec:
    """Roles of a dimension's columns. ``key`` may name several columns."""

    key: tuple[str, ...]
    tracked: tuple[str, ...]
    overwrite: tuple[str, ...] = ()
    carried: tuple[str, ...] = ()
    surrogate: str | None = None
    null_safe_hash: bool = False

    @property
    def attributes(self) -> tuple[str, ...]:
        return (*self.tracked, *self.overwrite, *self.carried)

    @property
    def columns(self) -> tuple[str, ...]:
        head = (self.surrogate,) if self.surrogate else ()
        return (*head, *self.key, *self.attributes, *TECHNICAL)


def with_hash(df: DataFrame, spec: Scd2Spec) -> DataFrame:
    return df.withColumn(HASH, hash_diff(*spec.tracked, null_safe=spec.null_safe_hash))


def current_versions(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col(IS_CURRENT))


def require_unique(df: DataFrame, key: tuple[str, ...], where: str = "in the incoming batch") -> DataFrame:
    """The same rows; the job fails when a key is NULL or occurs twice.

    The check is an aggregate by key, so it shares the shuffle of a following join on that key.
    """
    rest = [c for c in df.columns if c not in key]
    any_null = F.lit(False)
    for c in key:
        any_null = any_null | F.col(c).isNull()
    problem = F.when(any_null, F.lit(f"NULL business key {where}")).when(
        F.col("_n") > 1,
        F.concat(F.lit(f"duplicate business key {where}: "),
                 F.concat_ws("|", *[F.col(c).cast("string") for c in key])),
    )
    checked = F.when(problem.isNull(), F.col("_row")).otherwise(F.raise_error(problem))
    return (
        df.groupBy(*key)
        .agg(F.first(F.struct(*rest)).alias("_row"), F.count(F.lit(1)).alias("_n"))
        .select(*key, checked.alias("_row"))
        .select(*key, *[F.col("_row")[c].alias(c) for c in rest])
    )


def _incoming(incoming: DataFrame, spec: Scd2Spec) -> DataFrame:
    return require_unique(with_hash(incoming.select(*spec.key, *spec.attributes), spec), spec.key)


def _opened(value, spec: Scd2Spec, batch_ts: Column) -> Column:
    """Struct of a new current version; ``value(c)`` reads an incoming column."""
    fields = [F.lit(None).cast("bigint").alias(spec.surrogate)] if spec.surrogate else []
    fields += [value(c).alias(c) for c in (*spec.key, *spec.attributes)]
    fields += [
        batch_ts.alias(VALID_FROM),
        F.lit(None).cast("timestamp").alias(VALID_TO),
        F.lit(True).alias(IS_CURRENT),
        value(HASH).alias(HASH),
    ]
    return F.struct(*fields)


def scd2_apply(dim: DataFrame, incoming: DataFrame, spec: Scd2Spec, batch_ts: str | Column,
               after: Column | int | None = None, digits: int = 3) -> DataFrame:
    """The dimension after one batch, in one pass and with one clock.

    Closed versions go straight through; only the current slice meets the batch, in one full
    outer join on unique keys. With ``after``, the largest surrogate key ever given out, new versions
    get the keys above it; without, theirs is NULL. The job fails when a version would end
    before it began, which is what a late batch does.
    """
    ts = _timestamp(batch_ts)
    dim = dim.select(*spec.columns)
    closed = dim.filter(~F.coalesce(F.col(IS_CURRENT), F.lit(False)))
    current = current_versions(dim).select(
        *spec.key, F.struct(*[F.col(c) for c in dim.columns]).alias("_cur")
    )
    current = require_unique(current, spec.key, "among the current versions")
    arriving = _incoming(incoming, spec)
    arriving = arriving.select(*spec.key, F.struct(*[F.col(c) for c in arriving.columns]).alias("_new"))
    pairs = current.join(arriving, list(spec.key), "full_outer")

    cur, new = F.col("_cur"), F.col("_new")
    opened = _opened(lambda c: new[c], spec, ts)
    unchanged = _version(cur, spec, {c: new[c] for c in spec.overwrite})
    late = F.concat(F.lit("the batch is not after the version it would close: "),
                    F.concat_ws("|", *[cur[c].cast("string") for c in spec.key]))
    end = F.when(ts > cur[VALID_FROM], ts).otherwise(F.raise_error(late).cast("timestamp"))
    ended = _version(cur, spec, {VALID_TO: end, IS_CURRENT: F.lit(False)})
    versions = (
        F.when(cur.isNull(), F.array(opened))
        .when(new.isNull(), F.array(_version(cur, spec, {})))
        .when(cur[HASH] == new[HASH], F.array(unchanged))
        .when(cur[HASH] != new[HASH], F.array(ended, opened))
        .otherwise(F.array(_version(cur, spec, {})))
    )
    # No array is empty; the outer form spares the filter that would build each of them twice.
    touched = pairs.select(F.explode_outer(versions).alias("_v")).select("_v.*")
    if after is not None:
        touched = number_missing(touched, spec.key, spec.surrogate, after, digits)
    return closed.unionByName(touched.select(*spec.columns))


def _version(cur: Column, spec: Scd2Spec, changes: dict[str, Column]) -> Column:
    return F.struct(*[changes.get(c, cur[c]).alias(c) for c in spec.columns])


def scd2_initial(incoming: DataFrame, spec: Scd2Spec, batch_ts: str | Column, digits: int = 3) -> DataFrame:
    """First load of a dimension: every key opens its first version."""
    rows = _incoming(incoming, spec)
    opened = _opened(F.col, spec, _timestamp(batch_ts))
    first = rows.select(opened.alias("_v")).select("_v.*")
    if spec.surrogate:
        first = strided_keys(first.drop(spec.surrogate), spec.key, spec.surrogate, 0, digits)
    return first.select(*spec.columns)


def scd2_new_versions(dim: DataFrame, incoming: DataFrame, spec: Scd2Spec, batch_ts: str | Column) -> DataFrame:
    """Versions still to open: incoming keys without a current row (after closing, or repair)."""
    have = current_versions(dim).select(*spec.key)
    missing = _incoming(incoming, spec).join(have, list(spec.key), "left_anti")
    return missing.select(_opened(F.col, spec, _timestamp(batch_ts)).alias("_v")).select("_v.*")


def scd1_overwrite(dim: DataFrame, incoming: DataFrame, spec: Scd2Spec) -> DataFrame:
    """Only the type 1 part: current rows with an equal hash take the new overwrite values."""
    dim = dim.select(*spec.columns)
    closed = dim.filter(~F.coalesce(F.col(IS_CURRENT), F.lit(False)))
    new = _incoming(incoming, spec).select(
        *spec.key, F.col(HASH).alias("_new_hash"), F.struct(*spec.overwrite).alias("_new")
    )
    joined = current_versions(dim).join(new, list(spec.key), "left")
    same = F.coalesce(F.col("_new_hash") == F.col(HASH), F.lit(False))
    replaced = {
        c: F.when(same, F.col("_new")[c]).otherwise(F.col(c)).alias(c) for c in spec.overwrite
    }
    return closed.unionByName(joined.select(*[replaced.get(c, F.col(c)) for c in spec.columns]))


def scd2_history(log: DataFrame, spec: Scd2Spec, batch: str | tuple[str, ...],
                 chunk: str | None = None) -> DataFrame:
    """All versions from a log of snapshots, as if ``scd2_apply`` had run batch after batch.

    ``log`` has at most one row per key and ``batch`` (one or more ordering columns; the first
    gives the validity bounds). Absent keys stay open. Without ``chunk`` the rows of a key meet
    in one task, which suits snapshots: a key has at most one row per batch. For a log of single
    changes name a ``chunk`` column rising with ``batch``, so a key may hold most of the log.
    """
    order = (batch,) if isinstance(batch, str) else tuple(batch)
    log = with_hash(log, spec)
    moment = F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(order)])
    seen = with_previous(log, spec.key, chunk, order, [HASH, *spec.overwrite, moment.alias("_moment")], "_prev", "_last")
    # Sorted by batch, two rows of one key and batch are neighbours.
    twice = F.concat(F.lit("two rows of one key and batch: "), F.concat_ws("|", *[F.col(c).cast("string") for c in spec.key]))
    same = F.col("_prev").isNotNull() & F.col("_prev")["_moment"].eqNullSafe(moment)
    starts = F.col("_prev").isNull() | (F.col("_prev")[HASH] != F.col(HASH))
    starts = F.when(same, F.raise_error(twice).cast("boolean")).otherwise(starts)
    # A version ends before the next start, or at the last row of its key: that row holds the
    # final overwrite values, all rows between are not needed any more.
    kept = seen.withColumn("_start", starts).filter(F.col("_start") | F.col("_last"))
    own = F.struct(F.col(HASH), *spec.overwrite).alias("_own")
    before = F.struct(*[F.col("_prev")[c].alias(c) for c in (HASH, *spec.overwrite)]).alias("_prev")
    follower = ["_start", F.col(order[0]).alias("_from"), before, own]
    if chunk is not None:
        # Read by nobody: with the same columns needed on both sides of the chunk summary, Spark
        # shuffles the log once and reuses that exchange.
        follower += [F.struct(*spec.tracked, *spec.carried).alias("_same_columns")]
    versions = with_next(kept, spec.key, chunk, order, follower, "_next").filter(F.col("_start"))
    after = F.col("_next")
    ended = F.coalesce(after["_start"], F.lit(False))
    final = F.when(after.isNull(), F.struct(F.col(HASH), *spec.overwrite)).when(ended, after["_prev"]).otherwise(after["_own"])
    return versions.select(
        *spec.key,
        *spec.tracked,
        *[final[c].alias(c) for c in spec.overwrite],
        *spec.carried,
        F.col(order[0]).alias(VALID_FROM),
        F.when(ended, after["_from"]).alias(VALID_TO),
        (~ended).alias(IS_CURRENT),
        HASH,
    )


def scd2_merge(dim: DataFrame, seen: DataFrame, arrivals: DataFrame, spec: Scd2Spec, moment: str,
               after: Column | int | None = None, chunk: str | None = None, digits: int = 3) -> DataFrame:
    """The dimension after ``arrivals`` that may be late: in any order of deliveries, what ``scd2_history`` makes of all rows.

    ``seen`` holds all rows delivered before (key, attributes, ``moment``), ``arrivals`` the new ones, of any number
    of moments. A key that has been seen at or after an arrival is late: its versions are chained anew
    from its rows, so an arrival between two of them opens a version there, cuts the one it lies in, moves a start forward
    to itself, or only brings newer overwrite values. For all other keys only the current version meets
    the arrivals. Of ``seen`` the rows since the earliest arrival are read, and for late keys all of theirs; store it by
    moment, so that an ordinary batch reads nothing.

    A version keeps its surrogate key as long as it holds the moment at which it once began; new ones are numbered
    above ``after``. The job fails on a NULL key and on two rows of one key and moment, in one delivery or in two.
    """
    key = list(spec.key)
    columns = [*key, *spec.attributes, moment]
    stamped = lambda df: df.select(*columns).withColumn(moment, F.col(moment).cast("timestamp"))
    dim, seen, arrivals = dim.select(*spec.columns), stamped(seen), stamped(arrivals)
    nameless = F.lit("NULL business key or moment in the arrivals")
    whole = F.lit(True)
    for c in (*key, moment):
        whole = whole & F.col(c).isNotNull()
    arrivals = arrivals.filter(F.when(whole, F.lit(True)).otherwise(F.raise_error(nameless).cast("boolean")))

    first = arrivals.groupBy(*key).agg(F.min(moment).alias("_first"))
    recent = seen.filter(F.col(moment) >= arrivals.agg(F.min(moment).alias("m")).scalar()).select(*key, moment)
    late = recent.join(first, key).filter(F.col(moment) >= F.col("_first")).select(*key).distinct()
    marked = first.join(late.withColumn("_late", F.lit(True)), key, "left").select(*key, F.coalesce("_late", F.lit(False)).alias("_late"))

    held = dim.join(marked, key, "left")
    # Keys that do not arrive, and the closed versions of those in time, stay as they are.
    kept = held.filter(F.col("_late").isNull() | (~F.col("_late") & ~F.coalesce(F.col(IS_CURRENT), F.lit(False))))
    replaced = held.filter(F.col("_late") | (~F.col("_late") & F.col(IS_CURRENT)))
    seeds = replaced.filter(~F.col("_late")).withColumn(moment, F.col(VALID_FROM).cast("timestamp")).select(*columns)
    again = seen.join(late, key, "left_semi")
    log = seeds.unionByName(again).unionByName(arrivals)
    if chunk is not None:
        log = log.withColumn("_chunk", F.date_trunc(chunk, moment))
    versions = scd2_history(log, spec, moment, chunk and "_chunk")
    if not spec.surrogate:
        return kept.select(*spec.columns).unionByName(versions.select(*spec.columns))
    # Each old start lies in one new version; of several, the first keeps its surrogate key.
    starts = replaced.select(*key, spec.surrogate, F.col(VALID_FROM).alias("_began"))
    placed = with_version(starts, versions, key, "_began", [VALID_FROM], name="_in")
    owners = placed.groupBy(*key, F.col("_in")[VALID_FROM].alias(VALID_FROM)).agg(
        F.min_by(spec.surrogate, "_began").alias(spec.surrogate))
    versions = versions.join(owners, [*key, VALID_FROM], "left").select(*spec.columns)
    if after is not None:
        versions = number_missing(versions, [*key, VALID_FROM], spec.surrogate, after, digits)
    return kept.select(*spec.columns).unionByName(versions.select(*spec.columns))


def publish_current(dim: DataFrame) -> DataFrame:
    """Copy of a dimension for the star schema: current versions without technical columns."""
    return current_versions(dim).drop(*TECHNICAL)


def _timestamp(value: str | Column) -> Column:
    return (F.lit(value) if isinstance(value, str) else value).cast("timestamp")
