"""Change-detection hashes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SEPARATOR = "||"


def hash_diff(*columns: str | Column, null_safe: bool = False) -> Column:
    """SHA-256 over the tracked attributes, joined with two bars.

    NULLs are skipped by default, so (a, NULL, b) and (a, b, NULL) share a hash. With
    ``null_safe`` each value carries its length and NULL has a sign of its own, so two
    different rows never build the same text.
    """
    texts = [_text(c) for c in columns]
    if null_safe:
        texts = [
            F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts
        ]
    return F.sha2(F.concat_ws(SEPARATOR, *texts), 256)


def _text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")
