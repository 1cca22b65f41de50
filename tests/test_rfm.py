from datetime import date
from decimal import Decimal

import pytest
from patronage.operators import clean, describe, density, rfm, segments
from patronage.schema import TRANSACTION_SCHEMA
from pyspark.sql import functions as F

D = Decimal


def table(spark, *rows):
    return spark.createDataFrame(rows, TRANSACTION_SCHEMA)


@pytest.fixture(scope="module")
def purchases(spark):
    return table(
        spark,
        ("a", date(1997, 1, 1), 1, D("10.00")),
        ("a", date(1997, 3, 1), 2, D("5.50")),
        ("b", date(1997, 2, 1), None, D("7.00")),  # no quantity: dropped
        ("b", date(1997, 1, 15), 1, D("2.00")),
        ("c", date(1997, 12, 31), 1, D("0.00")),  # not positive: dropped
        ("c", date(1997, 1, 2), 1, D("-4.00")),
        ("d", None, 1, D("3.00")),
        (None, date(1997, 5, 5), 1, D("3.00")),
        ("e", date(1997, 2, 2), 3, None),
    )


def test_cleaning(purchases):
    kept = clean.clean_transactions(purchases).collect()
    assert sorted((r[0], r[3]) for r in kept) == [("a", D("5.50")), ("a", D("10.00")), ("b", D("2.00"))]


def test_rfm_of_clean_rows(purchases):
    rows = {r["customer_id"]: tuple(r)[1:] for r in rfm.rfm_table(purchases).collect()}
    assert rows == {"a": (0, 2, D("15.50")), "b": (45, 1, D("2.00"))}
    types = dict(rfm.rfm_table(purchases).dtypes)
    assert types == {"customer_id": "string", "Recency": "int", "Frequency": "bigint",
                     "Monetary": "decimal(28,2)"}


def test_rfm_at_a_fixed_day_keeps_all_customers(purchases):
    rows = {r["customer_id"]: tuple(r)[1:] for r in
            rfm.rfm_table(purchases, as_of="1997-12-01", clean=False).collect()}
    assert rows["c"] == (-30, 2, D("-4.00"))
    assert rows["e"][1:] == (0, D("0.00"))  # counts values, and the sum of none is 0
    assert set(rows) == {"a", "b", "c", "d", "e"}


def test_one_scan_serves_both_the_totals_and_the_latest_day(spark, tmp_path):
    path = str(tmp_path / "t")
    table(spark, *[("c%d" % (i % 7), date(1997, 1, 1 + i % 28), 1, D(i + 1)) for i in range(100)]
          ).write.parquet(path)
    result = rfm.rfm_table(spark.read.parquet(path))
    result._jdf.collectToPython()
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan


def test_validation_order(spark):
    df = table(
        spark,
        ("a", date(1996, 12, 31), 0, D("-1")),
        ("b", date(1997, 1, 1), 0, D("-1")),
        ("c", date(1998, 6, 30), 1, D("0")),
        ("d", date(1998, 7, 1), 1, D("5")),
        ("e", date(1998, 1, 1), 1, D("0.01")),
        ("f", None, 1, D("5")),
        ("g", date(1998, 1, 1), None, D("5")),
        ("h", date(1998, 1, 1), 1, None),
    )
    checked = clean.validate_transactions(df)
    reasons = {r["customer_id"]: r["reject_reason"] for r in checked.collect()}
    day = "Transaction date must be between 1997-01-01 and 1998-06-30."
    quantity = "Number of CDs should be greater than 0"
    value = "Transaction value should be greater than 0"
    assert reasons == {"a": day, "b": quantity, "c": value, "d": day, "e": None, "f": day,
                       "g": quantity, "h": value}
    assert [r[0] for r in clean.accepted(checked).collect()] == ["e"]
    assert clean.rejected(checked).count() == 7


def test_exploring(spark):
    df = table(
        spark,
        ("1", date(1997, 1, 1), 1, D("1.00")),
        ("1", date(1997, 1, 5), 2, D("2.00")),
        (None, date(1997, 1, 3), 4, None),
        ("2", date(1997, 1, 2), 9, D("10.00")),
    )
    assert tuple(describe.id_stats(df).head()) == (1, 3)
    assert describe.id_stats(df, approximate=True).head()["unique_ids"] == 3
    assert tuple(describe.date_range(df).head()) == (date(1997, 1, 1), date(1997, 1, 5))
    nulls = {r[0]: r[1] for r in describe.null_counts(df).collect()}
    assert nulls == {"customer_id": 1, "transaction_date": 0, "num_cds_purchased": 0,
                     "transaction_value": 1}
    assert describe.sample_rows(df, df.columns[:1], 3).count() == 3
    assert [r[0] for r in describe.head_rows(df, ["transaction_date"], 2).collect()] == ["1", "2"]


def test_describe_matches_pandas(spark):
    rows = [("c", date(1997, 1, 1), (i * i) % 13, D(i % 97) + D("0.25")) for i in range(211)]
    rows.append(("c", date(1997, 1, 1), None, D("5.00")))
    df = table(spark, *rows)
    expected = df.toPandas()[["num_cds_purchased", "transaction_value"]].astype(float).describe()
    for sortable_rows in (10**6, 3):
        for row in describe.describe(df, sortable_rows=sortable_rows).collect():
            column = expected[row["column"]]
            assert row["count"] == column["count"]
            for ours, theirs in (("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"),
                                 ("p50", "50%"), ("p75", "75%"), ("max", "max")):
                assert row[ours] == pytest.approx(column[theirs], rel=1e-12), (row, ours)


def test_describe_of_one_value_and_of_none(spark):
    rows = describe.describe(table(spark, ("c", date(1997, 1, 1), None, D("5.00")))).collect()
    by_column = {r["column"]: r for r in rows}
    assert by_column["transaction_value"]["std"] is None
    assert by_column["transaction_value"]["p50"] == 5.0
    assert by_column["num_cds_purchased"]["count"] == 0
    assert by_column["num_cds_purchased"]["mean"] is None


def test_profile_rounding_and_shares(spark):
    df = spark.createDataFrame(
        [("x", 0, 1, "1.00"), ("x", 1, 2, "2.00"), ("y", 1, 3, "4.00"), ("y", 4, 2, "5.00"),
         ("z", 3, 1, "1.00")],
        "g string, Recency int, Frequency bigint, Monetary string",
    ).withColumn("Monetary", F.col("Monetary").cast("decimal(28,2)"))
    rows = {r["g"]: r for r in segments.segment_profile(df, "g", 3).collect()}
    # 0.5, 1.5 and 2.5 go to the even neighbour.
    assert tuple(rows["x"])[1:4] == (0.0, 2.0, 2.0)
    assert tuple(rows["y"])[1:4] == (2.0, 2.0, 4.0)
    assert (rows["x"]["Count"], rows["x"]["Percent"]) == (2, 40.0)
    assert sum(r["Percent"] for r in rows.values()) == pytest.approx(100, abs=0.03)
    two = {r["g"]: r for r in segments.segment_profile(df, "g", 3, digits=2).collect()}
    assert two["x"]["RecencyMean"] == 0.5


def test_labels(spark):
    profile = spark.createDataFrame(
        [("Lost", 506.0, 1.0, 20.0, 8600, 36.59), ("VIP", 2.5, 3.5, 4.0, 1, 10.2)],
        "RFM_level string, RecencyMean double, FrequencyMean double, MonetaryMean double,"
        " Count bigint, Percent double",
    )
    labels = {r[0]: r[1] for r in segments.segment_labels(profile, "RFM_level").collect()}
    assert labels["Lost"] == "Lost \n506 days \n1 orders \n20 $ \n8600 customers (36.59%)"
    assert labels["VIP"] == "VIP \n2 days \n4 orders \n4 $ \n1 customers (10.2%)"


def test_histogram_counts_every_customer(make_rfm):
    import numpy as np

    rows = [(i, i * 7 % 50, 1, float(i * i % 89)) for i in range(120)]
    bins = density.histogram(make_rfm(rows)).collect()
    for metric, place in (("Recency", 1), ("Monetary", 3)):
        ours = [r["count"] for r in sorted(bins, key=lambda r: r["bin"]) if r["metric"] == metric]
        theirs, _ = np.histogram([float(r[place]) for r in rows], bins=30)
        assert sum(ours) == 120 and ours == theirs.tolist()
    flat = sorted((r["bin"], r["count"], r["bin_start"], r["bin_end"]) for r in bins
                  if r["metric"] == "Frequency")
    assert len(flat) == 30 and sum(r[1] for r in flat) == 120
    assert flat[15][1] == 120 and flat[0][2] == 0.5 and flat[29][3] == 1.5


def test_density_curve(make_rfm):
    import numpy as np

    rows = [(i, i * 7 % 50, 1, float(i * i % 89)) for i in range(80)]
    curve = density.density_curve(make_rfm(rows), grid=40).collect()
    assert {r["metric"] for r in curve} == {"Recency", "Monetary"}  # no spread, no curve
    values = np.array([float(r[3]) for r in rows])
    h = values.std(ddof=1) * len(values) ** -0.2
    grid = np.linspace(values.min(), values.max(), 40)
    expected = np.exp(-((grid[:, None] - values) ** 2) / (2 * h * h)).sum(axis=1)
    expected /= len(values) * h * np.sqrt(2 * np.pi)
    ours = [r for r in sorted(curve, key=lambda r: r["point"]) if r["metric"] == "Monetary"]
    assert [r["density"] for r in ours] == pytest.approx(expected.tolist())
    scale = len(values) * (values.max() - values.min()) / 30
    assert [r["curve"] for r in ours] == pytest.approx((expected * scale).tolist())


def test_a_customer_with_a_third_of_all_rows(spark):
    rows = spark.range(3000).selectExpr(
        "if(id % 3 = 0, 'hot', concat('c', id)) customer_id",
        "date_add(date '1997-01-01', int(id % 100)) transaction_date",
        "1 num_cds_purchased", "cast(1 + id % 7 as decimal(18,2)) transaction_value",
    )
    result = rfm.rfm_table(rows)
    # Aggregated before the shuffle, so the hot customer is a row per task in it.
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum(transaction_value" in plan and "partial_max(" in plan
    hot = result.where("customer_id = 'hot'").head()
    assert (hot["Frequency"], hot["Monetary"]) == (1000, sum(1 + i % 7 for i in range(0, 3000, 3)))
    assert result.count() == 2001


@pytest.mark.parametrize("tolerance", [1e-3, 1e-8, 1e-14])
def test_density_of_boxes_is_within_its_bound(make_rfm, tolerance):
    import numpy as np

    # A third of all values is the same, one lies far away from all others.
    rows = [(i, 7 if i % 3 == 0 else i * 31 % 400, 1, float(i * i % 97)) for i in range(300)]
    rows.append((300, 5000, 1, 1e6))
    curve = density.density_curve(make_rfm(rows), tolerance=tolerance).collect()
    assert len(curve) == 400
    for metric, place in (("Recency", 1), ("Monetary", 3)):
        values = np.array([float(r[place]) for r in rows])
        h = values.std(ddof=1) * len(values) ** -0.2
        grid = np.linspace(values.min(), values.max(), 200)
        scale = h * np.sqrt(2 * np.pi)
        exact = np.exp(-((grid[:, None] - values) ** 2) / (2 * h * h)).mean(axis=1) / scale
        ours = [r["density"] for r in sorted(curve, key=lambda r: r["point"]) if r["metric"] == metric]
        bound = (2 * tolerance + 1e-13) / scale
        assert np.abs(np.array(ours) - exact).max() <= bound


def test_density_tasks_shuffle_boxes(make_rfm):
    from patronage.operators.ranking import metric_values

    rows = [(i, i % 50, i % 3, float(i % 70)) for i in range(2000)]
    values = metric_values(make_rfm(rows)).selectExpr("metric", "double(value) value")
    stats = values.groupBy("metric").agg({"value": "min"}).toDF("metric", "low").selectExpr("*", "5d bandwidth")
    boxes = density.box_moments(values, stats, 4)
    plan = boxes._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "Python" not in plan
    assert boxes.groupBy("metric").count().collect() and boxes.count() == 10 + 1 + 14
    assert boxes.selectExpr("sum(moments[0])").first()[0] == 6000
    assert density.terms_for(1e-14) == 19 and density.terms_for(1) < 3
    with pytest.raises(ValueError):
        density.terms_for(0)
