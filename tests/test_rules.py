from itertools import product

import pytest
from patronage.functions.rules import rfm_level
from patronage.operators.segments import levels, scores
from patronage.schema import check_k


def expected(k, r, f, m):
    """The rule tables, typed independently of the library."""
    total = r + f + m
    if k == 2:
        return "Active Customers" if total >= 9 else "Lost Customers"
    best = {3: "VIP Customers", 4: "VIP Customers"}.get(k, "Group 1")
    if total == 12:
        return best
    if k == 3:
        return "Active Customers" if r >= 3 else "Lost Customers"
    if k == 4:
        if f == 4 and r >= 2:
            return "Potential Loyalists"
        return "Lost" if max(r, f, m) <= 2 else "Regular"
    if k == 5:
        for name, score in (("Group 2", r), ("Group 3", m), ("Group 4", f)):
            if score == 4:
                return name
        return "Group 5"
    if k == 6:
        if total == 3:
            return "Group 2"
        if m == 4:
            return "Group 3"
        if r >= 3:
            if m >= 3:
                return "Group 4"
            if f >= 3:
                return "Group 5"
        return "Group 6"
    if r == 4:
        return "Group 2"
    if max(f, m) <= 2:
        return "Group 3"
    if m == 4:
        return "Group 4"
    if r >= 3 and f <= 2:
        return "Group 5"
    if f >= 3 and r >= 2:
        return "Group 6"
    return "Group 7"


def test_every_score_triple_has_its_level_for_every_k(spark):
    triples = list(product(range(1, 5), repeat=3))
    df = spark.createDataFrame(triples, "R int, F int, M int")
    rows = df.select("*", *(rfm_level(k).alias(f"k{k}") for k in range(2, 8))).collect()
    assert len(rows) == 64
    for row in rows:
        for k in range(2, 8):
            assert row[f"k{k}"] == expected(k, row["R"], row["F"], row["M"]), (k, row)


def test_code_and_score(spark):
    df = spark.createDataFrame([(4, 1, 3)], "R int, F int, M int")
    row = levels(scores(df), 2).head()
    assert (row["RFM_Segment"], row["RFM_score"], row["RFM_level"]) == ("413", 8, "Lost Customers")


@pytest.mark.parametrize("k", [1, 8, 0, -3, 2.0, "3", True, None])
def test_unsupported_numbers_of_clusters_are_rejected(k):
    with pytest.raises(ValueError):
        check_k(k)
    with pytest.raises(ValueError):
        rfm_level(k)
