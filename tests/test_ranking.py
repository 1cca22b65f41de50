import math
import random

import pytest
from patronage.operators import ranking
from patronage.session import stage
from pyspark.sql import functions as F


def bucket(rank, n):
    return max(1, math.ceil(4 * (rank - 1) / (n - 1)))


def brute(rows):
    """R, F, M per customer by sorting in Python."""
    n = len(rows)
    scored = {}
    for place, name in ((1, "R"), (2, "F"), (3, "M")):
        for rank, row in enumerate(sorted(rows, key=lambda r: (r[place], r[0])), 1):
            q = bucket(rank, n)
            scored.setdefault(row[0], {})[name] = 5 - q if name == "R" else q
    return scored


def random_rows(n, seed, ties):
    rng = random.Random(seed)
    ids = rng.sample(range(10 * n + 1), n)
    return [
        (i, rng.randrange(ties), rng.randrange(1, ties + 1), rng.randrange(100, 100 * ties) / 100)
        for i in ids
    ]


@pytest.mark.parametrize(
    "n, expected", [(2, [1, 4]), (6, [1, 1, 2, 3, 4, 4]), (5, [1, 1, 2, 3, 4])]
)
def test_quartile_sizes_of_small_tables(make_rfm, n, expected):
    rfm = make_rfm([(i, 10 - i, i, float(i)) for i in range(n)])
    rows = sorted(ranking.quartiles(rfm).collect(), key=lambda r: r["customer_id"])
    assert [r["F"] for r in rows] == expected
    assert [r["M"] for r in rows] == expected
    # Recency falls with the id here and its scores are reversed.
    assert [r["R"] for r in rows] == [5 - q for q in reversed(expected)]


def test_too_few_customers(make_rfm):
    for rows in ([], [(1, 1, 1, 1.0)]):
        with pytest.raises(ValueError):
            ranking.quartiles(make_rfm(rows))


def test_ties_are_ordered_by_customer(make_rfm):
    rfm = make_rfm([(i, 5, 1, 9.99) for i in (8, 3, 7, 1)])
    rows = sorted(ranking.quartiles(rfm).collect(), key=lambda r: r["customer_id"])
    assert [(r["R"], r["F"], r["M"]) for r in rows] == [(4, 1, 1), (3, 2, 2), (2, 3, 3), (1, 4, 4)]


@pytest.mark.parametrize("ties", [2, 7, 100000])
def test_narrowing_ranks_and_brute_force_agree(make_rfm, ties):
    rows = random_rows(1500, ties, ties)
    rfm = stage(make_rfm(rows).repartition(5))
    expected = brute(rows)

    def scores_of(df):
        return {r["customer_id"]: {c: r[c] for c in "RFM"} for r in df.collect()}

    assert scores_of(ranking.quartiles(rfm)) == expected
    # Brackets far smaller than the table force many narrowing passes.
    assert scores_of(ranking.quartiles(rfm, sortable_rows=20)) == expected
    ranked = ranking.first_ranks(rfm)
    assert scores_of(ranking.quartiles_from_ranks(ranked)) == expected
    for metric, place in (("Recency", 1), ("Frequency", 2), ("Monetary", 3)):
        order = sorted(rows, key=lambda r: (r[place], r[0]))
        found = {r["customer_id"]: r[f"{metric}_rank"] for r in ranked.collect()}
        assert found == {row[0]: rank for rank, row in enumerate(order, 1)}


def test_text_ids(spark, make_rfm):
    rows = random_rows(60, 3, 4)
    rfm = make_rfm(rows).withColumn("customer_id", F.lpad(F.col("customer_id").cast("string"), 6, "0"))
    found = {int(r["customer_id"]): (r["R"], r["F"], r["M"]) for r in
             ranking.quartiles(rfm, sortable_rows=7).collect()}
    assert found == {i: (s["R"], s["F"], s["M"]) for i, s in brute(rows).items()}


@pytest.mark.parametrize("sortable_rows, pivot_sample", [(1, 3), (2, 10), (50, 200), (10**6, 10)])
def test_weighted_keys_at_ranks(spark, sortable_rows, pivot_sample):
    rng = random.Random(sortable_rows)
    # One value carries a third of all the weight.
    weights = {("a", float(v)): rng.randrange(1, 9) for v in range(300)}
    weights[("a", 17.0)] = 600
    weights.update({("b", float(v)): 1 for v in range(5)})
    values = stage(
        spark.createDataFrame([(g, v, w) for (g, v), w in weights.items()],
                              "g string, v double, w bigint")
    )
    expanded = {}
    for (g, v), w in sorted(weights.items()):
        expanded.setdefault(g, []).extend([v] * w)

    def wanted(group, n):
        assert n == len(expanded[group])
        return [1, n // 3, n // 2, n // 2 + 1, n]

    found = ranking.keys_at_ranks(values, "g", ["v"], wanted, weight="w",
                                  sortable_rows=sortable_rows, pivot_sample=pivot_sample)
    assert found == {
        (g, rank): (order[rank - 1],) for g, order in expanded.items()
        for rank in wanted(g, len(order))
    }


def test_no_exchange_into_a_single_partition(make_rfm, spark):
    """Scoring is a projection over the table, with no sort or shuffle of it."""
    rfm = stage(make_rfm(random_rows(50, 1, 5)))
    plan = ranking.quartiles(rfm)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and "Sort" not in plan


def test_sums_beyond_eighteen_digits(spark):
    n = 40
    rfm = stage(
        spark.range(n).selectExpr(
            "id customer_id", "int(id) Recency", "id + 1 Frequency",
            "cast('100000000000000000000.01' as decimal(28,2)) + (id * 7 % 40) as Monetary",
        ).selectExpr("customer_id", "Recency", "Frequency",
                     "cast(Monetary as decimal(28,2)) as Monetary")
    )
    place = {i: rank for rank, i in enumerate(sorted(range(n), key=lambda i: i * 7 % 40), 1)}
    for rows in (ranking.quartiles(rfm, sortable_rows=5),
                 ranking.quartiles_from_ranks(ranking.first_ranks(rfm))):
        assert {r["customer_id"]: r["M"] for r in rows.collect()} == {
            i: bucket(rank, n) for i, rank in place.items()
        }
