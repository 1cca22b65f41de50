"""Segment names from the three quartile scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import check_k

# Per number of segments, the conditions on (R, F, M) in the
# order they are tried, with the level each gives; the last has no condition.
LEVEL_RULES: dict[int, list[tuple[str | None, str]]] = {
    2: [
        ("R + F + M >= 9", "Active Customers"),
        (None, "Lost Customers"),
    ],
    3: [
        ("R + F + M = 12", "VIP Customers"),
        ("R >= 3", "Active Customers"),
        (None, "Lost Customers"),
    ],
    4: [
        ("R + F + M = 12", "VIP Customers"),
        ("R >= 2 AND F = 4", "Potential Loyalists"),
        ("R <= 2 AND F <= 2 AND M <= 2", "Lost"),
        (None, "Regular"),
    ],
    5: [
        ("R + F + M = 12", "Group 1"),
        ("R = 4", "Group 2"),
        ("M = 4", "Group 3"),
        ("F = 4", "Group 4"),
        (None, "Group 5"),
    ],
    6: [
        ("R + F + M = 12", "Group 1"),
        ("R = 1 AND F = 1 AND M = 1", "Group 2"),
        ("M = 4", "Group 3"),
        ("R >= 3 AND M >= 3", "Group 4"),
        ("R >= 3 AND F >= 3", "Group 5"),
        (None, "Group 6"),
    ],
    7: [
        ("R + F + M = 12", "Group 1"),
        ("R = 4", "Group 2"),
        ("F <= 2 AND M <= 2", "Group 3"),
        ("M = 4", "Group 4"),
        ("R >= 3 AND F <= 2", "Group 5"),
        ("R >= 2 AND F >= 3", "Group 6"),
        (None, "Group 7"),
    ],
}


def rfm_level(k: int) -> Column:
    """Level name for columns ``R``, ``F`` and ``M`` when ``k`` segments are wanted."""
    *conditions, (_, otherwise) = LEVEL_RULES[check_k(k)]
    (first, name), *rest = conditions
    level = F.when(F.expr(first), name)
    for condition, name in rest:
        level = level.when(F.expr(condition), name)
    return level.otherwise(otherwise)


def rfm_code() -> Column:
    """The three scores side by side, such as ``'413'``."""
    return F.concat(*(F.col(c).cast("string") for c in ("R", "F", "M")))


def rfm_score() -> Column:
    """Sum of the three scores, 3 to 12."""
    return F.col("R") + F.col("F") + F.col("M")
