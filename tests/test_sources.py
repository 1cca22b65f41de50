from datetime import date
from decimal import Decimal

import pytest
from patronage import session
from patronage.session import scratch_path, stage
from patronage.sources import comparison, results, transactions
from pyspark.errors import PySparkException


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


GOOD = [
    " 00001 19970101  1   11.77",
    "00004    1 19970118  2   29.33\t",
    "\t00002 19970112   5 77.00",
]


def test_four_and_five_fields(spark):
    good, rejects = transactions.parse_transactions(
        lines(spark, *GOOD, "1 2 3", "", "   ", "a b c d e f")
    )
    assert sorted(map(tuple, good.collect())) == [
        ("00001", date(1997, 1, 1), 1, Decimal("11.77")),
        ("00002", date(1997, 1, 12), 5, Decimal("77.00")),
        ("00004", date(1997, 1, 18), 2, Decimal("29.33")),
    ]
    assert rejects.count() == 0


def test_whole_numbers(spark):
    good, rejects = transactions.parse_transactions(
        lines(spark, "1 19970101 2.0 5", "2 19970101 2.5 5", "3 19970101 99999999999 5")
    )
    assert [(r[0], r[2]) for r in good.collect()] == [("1", 2)]
    assert rejects.count() == 2


def test_surplus_decimals_are_rejects(spark):
    rows = lines(spark, "1 19970101 1 11.777", "2 19970101 1 11.770", "3 19970101 1 5")
    good, rejects = transactions.parse_transactions(rows, id_width=5)
    assert sorted(tuple(r)[::3] for r in good.collect()) == [
        ("00002", Decimal("11.77")), ("00003", Decimal("5.00"))
    ]
    assert [r["value"] for r in rejects.collect()] == ["1 19970101 1 11.777"]
    with pytest.raises(PySparkException):
        transactions.parse_transactions(rows, mode="failfast")[0].count()


def test_one_pass_writes_both_outcomes(spark):
    path = scratch_path(spark, "parsed")
    transactions.write_parsed(lines(spark, *GOOD, *BAD), path)
    good, rejects = transactions.read_parsed(spark, path)
    both = transactions.parse_transactions(lines(spark, *GOOD, *BAD))
    assert sorted(good.collect()) == sorted(both[0].collect())
    assert sorted(rejects.collect()) == sorted(both[1].collect())


def test_layouts(spark):
    good, _ = transactions.parse_transactions(lines(spark, *GOOD), layouts=(4,))
    assert {r["customer_id"] for r in good.collect()} == {"00001", "00002"}
    for layouts in ((), (3,), (4, 6)):
        with pytest.raises(ValueError):
            transactions.parse_transactions(lines(spark, *GOOD), layouts=layouts)


BAD = [
    "00001 19970231 1 5.00",
    "00001 1997010 1 5.00",
    "00001 1997-1-1 1 5.00",
    "00001 19970101 x 5.00",
    "00001 19970101 1 five",
    "00001 7 19970101 1.5 5.00",
]


def test_permissive_rejects(spark):
    good, rejects = transactions.parse_transactions(lines(spark, *GOOD, *BAD))
    assert good.count() == 3
    assert sorted(r["value"] for r in rejects.collect()) == sorted(BAD)


@pytest.mark.parametrize("bad", BAD)
def test_failfast(spark, bad):
    good, rejects = transactions.parse_transactions(lines(spark, *GOOD, bad), mode="failfast")
    assert rejects.count() == 0
    with pytest.raises(PySparkException):
        good.count()
    good, _ = transactions.parse_transactions(lines(spark, *GOOD), mode="failfast")
    assert good.count() == 3
    with pytest.raises(ValueError):
        transactions.parse_transactions(lines(spark, bad), mode="lenient")


def test_fixed_layout_file(spark):
    path = scratch_path(spark, "fixed")
    lines(spark, GOOD[0], "", GOOD[2], "7 19970203 1").coalesce(1).write.text(path)
    rows = sorted(map(tuple, transactions.load_transactions(spark, path).collect()))
    assert rows[0] == ("00001", date(1997, 1, 1), 1, Decimal("11.77"))
    assert rows[2] == ("7", date(1997, 2, 3), 1, None)
    padded = transactions.load_transactions(spark, path, id_width=5)
    assert {r[0] for r in padded.collect()} == {"00001", "00002", "00007"}
    path = scratch_path(spark, "fixed")
    lines(spark, *GOOD).write.text(path)
    with pytest.raises(PySparkException):
        transactions.load_transactions(spark, path).collect()


def test_tsv(spark):
    good, _ = transactions.parse_transactions(lines(spark, *GOOD))
    path = scratch_path(spark, "tsv")
    transactions.write_tsv(good, path)
    assert sorted(transactions.read_tsv(spark, path).collect()) == sorted(good.collect())
    header = spark.read.text(path).where("value like 'customer_id%'").head()["value"]
    assert header == "customer_id\ttransaction_date\tnum_cds_purchased\ttransaction_value"


def profile(spark, k, name="Lost", count=3):
    return spark.createDataFrame(
        [(name, 1.0, 2.0, 3.0, count, 100.0, k)],
        "RFM_level string, RecencyMean double, FrequencyMean double, MonetaryMean double,"
        " Count bigint, Percent double, `Number of Clusters` int",
    )


def test_results_of_several_k_live_together(spark):
    path = scratch_path(spark, "results")
    results.save_results(profile(spark, 2), path)
    results.save_results(profile(spark, 3, "VIP Customers"), path)
    results.save_results(profile(spark, 2, "Active Customers", 9), path)
    rows = {(r["Number of Clusters"], r["RFM_level"], r["Count"])
            for r in results.read_results(spark, path, "RFM_level").collect()}
    assert rows == {(2, "Active Customers", 9), (3, "VIP Customers", 3)}
    one = results.read_results(spark, path, "RFM_level").where("`Number of Clusters` = 3")
    assert "PartitionFilters: [isnotnull(Number of Clusters" in (
        one._jdf.queryExecution().executedPlan().toString()
    )


def row(spark, *values):
    return spark.createDataFrame([values], comparison.COMPARISON_SCHEMA)


def test_upsert(spark):
    path = scratch_path(spark, "comparison")
    assert comparison.read_comparison(spark, path).count() == 0
    comparison.upsert_comparison(spark, path, row(spark, 2, "RFM Analysis", 0.5, 0.0))
    first = row(spark, 3, "RFM Analysis", 0.7, 0.0)
    comparison.upsert_comparison(spark, path, first)
    again = comparison.upsert_comparison(spark, path, first)
    assert sorted(map(tuple, again.collect())) == [
        (2, "RFM Analysis", 0.5, 0.0), (3, "RFM Analysis", 0.7, 0.0)
    ]
    changed = comparison.upsert_comparison(spark, path, row(spark, 2, "RFM Analysis", 0.1, 0.3))
    assert (2, "RFM Analysis", 0.1, 0.3) in set(map(tuple, changed.collect()))
    assert changed.count() == 2


def test_release_deletes_what_was_staged(spark):
    other = spark.newSession()
    path = scratch_path(other, "gone")
    profile(spark, 4).write.parquet(path)
    folder = session._session_folder(other)
    assert path.startswith(folder)
    kept = session._session_folder
    session._session_folder = lambda _: path
    try:
        session.release(other)
    finally:
        session._session_folder = kept
    with pytest.raises(PySparkException):
        spark.read.parquet(path)


def test_scratch_needs_no_setting(spark):
    class Unset:
        conf = {"spark.sql.warehouse.dir": "file:/warehouse/"}

    assert session.scratch_root(Unset) == "file:/warehouse/_scratch"


def test_stage_keeps_rows_and_types(spark):
    df = profile(spark, 4)
    staged = stage(df)
    assert staged.dtypes == df.dtypes and staged.collect() == df.collect()
