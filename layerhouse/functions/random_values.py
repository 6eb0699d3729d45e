"""Repeatable random columns.

A value depends on (seed, stream, row id) alone, so a lost task re-creates the same rows and
the number of partitions does not matter. One digest holds two independent lanes of 52 bits.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

LANES, DIGITS = 2, 13


def _digest(seed: int, stream: str, row_id: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(stream), row_id.cast("string")))


def _unit(hex_digits: Column) -> Column:
    # Nothing here is NULL, and Spark can see it (a division would count as nullable): so joins on
    # a value made of this add no filter that computes it once more.
    whole = F.coalesce(F.conv(hex_digits, 16, 10).cast("bigint"), F.lit(0))
    return (whole + F.lit(0.5)) * F.lit(2.0 ** (-4 * DIGITS))


def uniform(seed: int, stream: str, row_id: Column, lane: int = 0) -> Column:
    """Uniform in (0, 1) from thirteen hex digits of a digest; lanes 2 and up are digests of their own."""
    part = lane // LANES
    digest = _digest(seed, f"{stream}-{part}" if part else stream, row_id)
    return _unit(F.substring(digest, 1 + 16 * (lane % LANES), DIGITS))


def uniforms(seed: int, stream: str, row_id: Column, k: Column, most: int) -> Column:
    """Array of k independent uniforms (k up to ``most``); number i is lane i % 2 of digest i / 2."""
    digests = [
        F.when(k > LANES * i, _digest(seed, f"{stream}-{i}", row_id)) for i in range(-(-most // LANES))
    ]
    pieces = F.regexp_extract_all(F.concat_ws("", *digests), F.lit("[0-9a-f]{16}"), F.lit(0))
    return F.transform(F.slice(pieces, 1, k.cast("int")), lambda piece: _unit(F.substring(piece, 1, DIGITS)))


def uniform_index(u: Column, n: Column | int) -> Column:
    """Whole number in 0 .. n-1."""
    scaled = F.floor(u * (F.lit(n) if isinstance(n, int) else n)).cast("bigint")
    return F.coalesce(scaled, F.lit(0))


def uniform_date(u: Column, first: str, last: str) -> Column:
    start, stop = F.lit(first).cast("date"), F.lit(last).cast("date")
    return F.date_add(start, F.floor(u * (F.date_diff(stop, start) + 1)).cast("int"))


def bernoulli(u: Column, probability: float, value: Column) -> Column:
    """The value with the given probability, else NULL."""
    return F.when(u < probability, value)


def weighted_choice(u: Column, values: Sequence, weights: Sequence[float]) -> Column:
    """One of a short fixed list, by cumulative weight.

    The position is the number of bounds reached: all bounds test the same uniform, which Spark
    then computes once (in a CASE each branch would compute it again).
    """
    total, running, position = float(sum(weights)), 0.0, F.lit(1)
    for weight in weights[:-1]:
        running += weight
        position = position + (u >= running / total).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in values]), position)


def normal(u1: Column, u2: Column, mean: float, deviation: float) -> Column:
    """Box-Muller transform of two uniforms."""
    radius = F.sqrt(F.lit(-2.0) * F.log(u1))
    return F.lit(float(mean)) + F.lit(float(deviation)) * radius * F.cos(F.lit(2.0 * math.pi) * u2)


def clipped(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(float(low)), F.least(value, F.lit(float(high))))


def redrawn_date(u_first: Column, u_test: Column, u_again: Column, coefficients: dict[int, float],
                 first: str, last: str) -> Column:
    """Uniform day, drawn once more when the month's coefficient is below the test value."""
    day = uniform_date(u_first, first, last)
    share = F.element_at(
        F.create_map(*[F.lit(x) for pair in coefficients.items() for x in (pair[0], float(pair[1]))]),
        F.month(day),
    )
    return F.when(u_test > share, uniform_date(u_again, first, last)).otherwise(day)


def sample_positions(n: Column, k: Column, draws: Column) -> Column:
    """Array of k different positions in 0 .. n-1, every subset equally likely.

    Floyd's method: step i looks at j = n-k+i, picks from 0 .. j and takes j itself when the pick
    is already in the set. ``draws`` is an array of k uniforms, ``k`` at most ``n``; no shuffle.
    """

    def step(taken: Column, u: Column) -> Column:
        j = (n - k + F.size(taken)).cast("bigint")
        pick = uniform_index(u, j + 1)
        return F.concat(taken, F.array(F.when(F.array_contains(taken, pick), j).otherwise(pick)))

    return F.aggregate(draws, F.array().cast("array<bigint>"), step)
