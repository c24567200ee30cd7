"""Joins of a large table with a dimension or an aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What a broadcast table may take, and what a cell of each kind takes about: text more than numbers.
BROADCAST_BYTES = 64 << 20
_WIDE = {"string": 32, "binary": 32}


def row_bytes(df: DataFrame) -> int:
    """Size of a row by its schema; nested columns count as a hundred bytes."""
    flat = [t for _, t in df.dtypes]
    return 16 + sum(100 if "<" in t else _WIDE.get(t, 8) for t in flat)


def broadcast_rows(df: DataFrame, budget: int = BROADCAST_BYTES) -> int:
    """How many rows of ``df`` the budget holds."""
    return budget // row_bytes(df)


def small_side(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Hint a broadcast only after counting; a larger table keeps the shuffled, skew-split join."""
    limit = broadcast_rows(df) if max_rows is None else max_rows
    return F.broadcast(df) if df.count() <= limit else df


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    max_rows: int | None = None,
) -> DataFrame:
    """Join ``fact`` to ``dim``, which has one row per key or a bounded number of them.

    Up to ``max_rows`` dimension rows, or what the byte budget holds, are broadcast and the fact rows stay where they are. Beyond
    that both sides shuffle on the keys and AQE splits a hot key's fact rows over many tasks, which
    is exact because each of them reads the same dimension rows.
    """
    return fact.join(small_side(dim, max_rows), list(keys), how)


def attach(fact: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of an aggregate that grows with the data: no hint, sizes decide at run time."""
    return fact.join(table, list(keys), "left")
