"""Quartile arithmetic on ranks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quartile_of_rank(rank: Column, n: Column | int) -> Column:
    """Quartile 1..4 of 1-based ``rank`` among ``n`` rows (n >= 2).

    The edges are the interpolated quartiles of the ranks themselves, hence
    ``ceil(4 (rank - 1) / (n - 1))`` and not ``ntile(4)``: the two differ
    whenever n leaves remainder 2 or 3 on division by 4.
    """
    n = n if isinstance(n, Column) else F.lit(n)
    steps = (4 * (rank - 1) + n - 2).cast("bigint")
    return F.greatest(F.lit(1), F.floor(steps / (n - 1))).cast("int")


def last_ranks_of_quartiles(n: int) -> list[int]:
    """The highest rank in quartiles 1, 2 and 3, so that three cut points
    decide the quartile of every row."""
    return [q * (n - 1) // 4 + 1 for q in (1, 2, 3)]
