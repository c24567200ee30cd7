"""Row statistics over the cells of one row, as plain aggregates.

Two forms. *Clean*: min, max, mean and sample deviation of the n non-null cells. *Cumulative*: the
mean is taken over the cells plus their min and max, the deviation over the cells plus min, max and
that mean. The cumulative form needs no array of cells: with m the cumulative mean,

    m   = (n * avg + min + max) / (n + 2)
    std = sqrt((n * var_pop + n * (avg - m)^2 + (min - m)^2 + (max - m)^2) / (n + 2))

because the appended mean adds nothing to the squares. So both forms come from five aggregates that
combine before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STATS = ("min", "max", "mean", "std")


def moments(value: Column, prefix: str) -> list[Column]:
    """The five aggregates both forms are computed from."""
    return [
        F.count(value).alias(f"{prefix}_n"),
        F.min(value).alias(f"{prefix}_min"),
        F.max(value).alias(f"{prefix}_max"),
        F.avg(value).alias(f"{prefix}_avg"),
        F.var_pop(value).alias(f"{prefix}_var"),
    ]


def clean(prefix: str) -> dict[str, Column]:
    n, var = F.col(f"{prefix}_n"), F.col(f"{prefix}_var")
    return {
        "min": F.col(f"{prefix}_min"),
        "max": F.col(f"{prefix}_max"),
        "mean": F.col(f"{prefix}_avg"),
        "std": F.when(n > 1, F.sqrt(var * n / (n - 1))),
    }


def cumulative(prefix: str) -> dict[str, Column]:
    n, avg, var = (F.col(f"{prefix}_{x}") for x in ("n", "avg", "var"))
    low, high = F.col(f"{prefix}_min"), F.col(f"{prefix}_max")
    mean = (n * avg + low + high) / (n + 2)
    squares = n * var + n * (avg - mean) ** 2 + (low - mean) ** 2 + (high - mean) ** 2
    return {"min": low, "max": high, "mean": mean, "std": F.sqrt(squares / (n + 2))}


FORMS = {"clean": clean, "cumulative": cumulative}
