import datetime

import pytest
from patronage.operators import daily, describe
from patronage.schema import TRANSACTION_SCHEMA
from patronage.session import scratch_path


@pytest.fixture(scope="module")
def rows(spark):
    # A third of all rows on one day; ties, missing values and rows without a day.
    return spark.range(30_000).selectExpr(
        "if(id % 17 = 0, null, concat('c', id * 7919 % 5000)) customer_id",
        "if(id % 101 = 0, null, if(id % 3 = 0, date '1997-02-01', "
        "date_add(date '1997-01-01', int(id % 60)))) transaction_date",
        "if(id % 13 = 0, null, int(pow(id % 5, 2))) num_cds_purchased",
        "cast(id * 37 % 10007 + 1e6 as decimal(18,2)) transaction_value",
        "id % 4 part",
    ).cache()


def exact(rows, column):
    return sorted(float(r[0]) for r in rows.select(column).collect() if r[0] is not None)


def test_merged_days_give_the_profile_of_all_rows(spark, rows):
    out = scratch_path(spark, "days")
    for number in range(4):
        part = rows.where(f"part = {number}")
        daily.add_days(part, out, number)
        if number == 1:
            daily.add_days(part, out, number)  # a repeated batch counts once
            daily.compact_days(spark, out)
    for compacted in (False, True):
        if compacted:
            daily.compact_days(spark, out)
        ours = {r["column"]: r for r in daily.profile(spark, out).collect()}
        for r in describe.describe(rows).collect():
            mine = ours[r["column"]]
            assert mine["count"] == r["count"]
            assert mine["Missing_Values"] == 30_000 - r["count"]
            assert (mine["min"], mine["max"]) == (r["min"], r["max"])
            assert mine["mean"] == pytest.approx(r["mean"], rel=1e-12)
            assert mine["std"] == pytest.approx(r["std"], rel=1e-9)
            values = exact(rows, r["column"])
            for percent in (25, 50, 75):
                answer = mine[f"p{percent}"]
                below = sum(v < answer for v in values) / len(values)
                upto = sum(v <= answer for v in values) / len(values)
                error = 3 * daily.rank_error()
                assert below - error <= percent / 100 <= upto + error and answer in values
        ids = daily.customer_stats(spark, out).first()
        true = describe.id_stats(rows).first()
        assert ids["missing_ids"] == true["missing_ids"]
        assert abs(ids["unique_ids"] - true["unique_ids"]) <= daily.distinct_error() * 5000
    days = rows.select("transaction_date").distinct().count()
    assert spark.read.parquet(f"{out}/values_snapshots/until=3").count() == 2 * days


def test_a_range_of_days(spark, rows):
    out = scratch_path(spark, "days")
    daily.add_days(rows, out, 0)
    some = rows.where("transaction_date between '1997-01-10' and '1997-02-01'")
    ours = {r["column"]: r for r in daily.profile(spark, out, "1997-01-10", "1997-02-01").collect()}
    for r in describe.describe(some).collect():
        assert ours[r["column"]]["count"] == r["count"] > 10_000
        assert ours[r["column"]]["mean"] == pytest.approx(r["mean"], rel=1e-12)


def test_days_without_values(spark):
    out = scratch_path(spark, "days")
    with pytest.raises(ValueError):
        daily.profile(spark, out)
    daily.add_days(spark.createDataFrame([], TRANSACTION_SCHEMA), out, 0)
    assert daily.profile(spark, out).count() == 0
    assert tuple(daily.customer_stats(spark, out).first()) == (0, 0)
    day = datetime.date(1997, 1, 1)
    nothing = spark.createDataFrame([(None, day, None, None)] * 2, TRANSACTION_SCHEMA)
    daily.add_days(nothing, out, 1)
    daily.compact_days(spark, out)
    for r in daily.profile(spark, out).collect():
        assert tuple(r)[1:] == (0, None, None, None, None, None, None, None, 2)
    assert tuple(daily.customer_stats(spark, out).first()) == (2, 1)


def test_tasks_send_partial_sketches(rows):
    values, customers = daily.day_rows(rows)
    for frame in (values, customers):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "partial_" in plan and "Python" not in plan and plan.count("Exchange") == 1
