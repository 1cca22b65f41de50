import datetime
import random
from pathlib import Path

import pytest
from patronage.operators import rfm
from patronage.plans import queries
from patronage.schema import TRANSACTION_SCHEMA
from patronage.session import scratch_path
from patronage.streaming import corrections

START = datetime.date(1997, 1, 1)


def purchase(number):
    day = START + datetime.timedelta(days=number * 37 % 400)
    # A third of the purchases are of one customer; cleaning drops some rows.
    customer = "hot" if number % 3 == 0 else (f"c{number % 7}" if number % 11 else None)
    return (customer, day, number % 4 or None, f"{number % 13 - 1}.50")


def frame(spark, rows):
    text = [(c, d, q, v) for c, d, q, v in rows]
    df = spark.createDataFrame(
        text, "customer_id string, transaction_date date, num_cds_purchased int, v string"
    )
    return df.selectExpr("* except (v)", "cast(v as decimal(18,2)) transaction_value")


def expected(spark, rows, as_of=None):
    return sorted(rfm.rfm_table(frame(spark, rows), as_of=as_of).collect())


@pytest.mark.parametrize("seed", range(3))
def test_any_order_of_changes_gives_the_corrected_table(spark, seed):
    rng = random.Random(seed)
    rows = {n: purchase(n) for n in range(120)}
    changes = [(row, 1) for row in rows.values()]
    for n in rng.sample(sorted(rows), 50):
        changes.append((rows[n], -1))
        if n % 2:
            rows[n] = purchase(n + 1000)
            changes.append((rows[n], 1))
        else:
            del rows[n]
    rng.shuffle(changes)
    out = scratch_path(spark, "corrections")
    for number in range(3):
        part = changes[number::3]
        both = corrections.added(frame(spark, [r for r, sign in part if sign == 1])).unionByName(
            corrections.withdrawn(frame(spark, [r for r, sign in part if sign == -1]))
        )
        corrections.apply_changes(both, out, number)
        if seed == 1 and number == 1:
            corrections.compact_corrections(spark, out)
        if seed == 2 and number == 1:  # a batch that is run twice counts once
            corrections.apply_changes(both, out, number)
    assert sorted(corrections.corrected_rfm(spark, out).collect()) == expected(spark, rows.values())
    assert corrections.open_withdrawals(spark, out).count() == 0
    as_of = sorted(corrections.corrected_rfm(spark, out, "1998-06-30").collect())
    assert as_of == expected(spark, rows.values(), "1998-06-30")


def test_the_last_purchase_is_taken_back(spark):
    out = scratch_path(spark, "corrections")
    days = [START, START + datetime.timedelta(days=10), START + datetime.timedelta(days=300)]
    rows = [("a", day, 1, "2.00") for day in days] + [("b", START, 1, "1.00")]
    corrections.apply_changes(corrections.added(frame(spark, rows)), out, 0)
    for number, (row, last) in enumerate([(rows[2], days[1]), (rows[1], days[0])], 1):
        corrections.apply_changes(corrections.withdrawn(frame(spark, [row])), out, number)
        totals = {r[0]: r[1:] for r in corrections.corrected_totals(spark, out).collect()}
        assert totals["a"][:2] == (last, 3 - number) and totals["b"][0] == START
    corrections.apply_changes(corrections.withdrawn(frame(spark, [rows[0]])), out, 3)
    corrections.compact_corrections(spark, out)
    assert [r[0] for r in corrections.corrected_totals(spark, out).collect()] == ["b"]


def test_a_batch_folds_only_the_spans_it_touches(spark):
    out = scratch_path(spark, "corrections")
    rows = [(f"c{n}", START + datetime.timedelta(days=n), 1, "1.00") for n in range(400)]
    corrections.apply_changes(corrections.added(frame(spark, rows)), out, 0)
    corrections.apply_changes(corrections.withdrawn(frame(spark, rows[:1])), out, 1)
    written = spark.read.parquet(f"{out}/spans/batch=1").collect()
    assert [(r["customer_id"], r["last_date"], r["Frequency"]) for r in written] == [("c0", None, 0)]


def test_withdrawals_of_what_never_came(spark):
    out = scratch_path(spark, "corrections")
    row = ("a", START, 1, "5.00")
    other = ("b", START, 1, "5.00")
    wrong = ("b", START, 1, "4.00")
    corrections.apply_changes(corrections.withdrawn(frame(spark, [row, wrong])), out, 0)
    assert corrections.corrected_totals(spark, out).count() == 0
    corrections.apply_changes(corrections.added(frame(spark, [other])), out, 1)
    found = {r[0]: tuple(r[2:]) for r in corrections.open_withdrawals(spark, out).collect()}
    assert set(found) == {"a", "b"} and found["a"][0] == -1 and found["b"][0] == 0
    corrections.apply_changes(corrections.added(frame(spark, [row])), out, 2)
    assert [r[0] for r in corrections.open_withdrawals(spark, out).collect()] == ["b"]


def test_empty_batches_and_no_batch(spark):
    out = scratch_path(spark, "corrections")
    with pytest.raises(ValueError):
        corrections.corrected_totals(spark, out)
    empty = spark.createDataFrame([], TRANSACTION_SCHEMA)
    corrections.apply_changes(corrections.added(empty), out, 0)
    assert corrections.corrected_rfm(spark, out).count() == 0


def test_changes_are_read_by_as_many_tasks_as_they_are_written(spark, monkeypatch):
    """A micro-batch of one file would be one task, however large the table."""
    made = {}

    def noted(session, name):
        made[name] = scratch_path(session, name)
        return made[name]

    monkeypatch.setattr(queries, "scratch_path", noted)
    queries.rfm_corrected(spark, "/root/testdata/sf0.001")
    files = list(Path(made["changes-in"]).glob("part-*.parquet"))
    assert len(files) >= 4 * spark.sparkContext.defaultParallelism
