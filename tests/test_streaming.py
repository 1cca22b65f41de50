import pytest
from patronage.operators import kmeans, ranking, rfm, segments
from patronage.operators.clean import accepted, rejected, validate_transactions
from patronage.session import scratch_path, stage
from patronage.streaming import purchases, quartiles


@pytest.fixture(scope="module")
def rows(spark):
    return stage(
        spark.range(300).selectExpr(
            "concat('c', id % 11) customer_id",
            "date_add(date '1996-12-20', int(id * 37 % 600)) transaction_date",
            "int(id % 5) num_cds_purchased",
            "cast(id % 17 - 1 as decimal(18,2)) transaction_value",
        )
    )


def stream_of(spark, rows, order):
    """The rows as a stream of files arriving in the given order."""
    path = scratch_path(spark, "arrivals")
    for part in order:
        rows.where(f"pmod(hash(transaction_date, transaction_value), 4) = {part}").coalesce(
            1
        ).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


def paths(spark):
    return scratch_path(spark, "out"), scratch_path(spark, "checkpoint")


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (3, 1, 0, 2)])
def test_running_totals_equal_the_batch_result(spark, rows, order):
    out, checkpoint = paths(spark)
    purchases.start_totals(stream_of(spark, rows, order), out, checkpoint).awaitTermination()
    live = purchases.totals_as_of(purchases.current_totals(spark, out), "1998-06-30")
    batch = rfm.rfm_table(accepted(validate_transactions(rows)), as_of="1998-06-30", clean=False)
    assert sorted(live.collect()) == sorted(batch.collect())
    assert spark.read.parquet(out).select("batch").distinct().count() == 4


def test_restart_continues_from_the_checkpoint(spark, rows):
    out, checkpoint = paths(spark)
    source = scratch_path(spark, "arrivals")
    rows.where("num_cds_purchased < 3").write.parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source)
    purchases.start_totals(stream, out, checkpoint).awaitTermination()
    rows.where("num_cds_purchased >= 3").write.mode("append").parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source)
    purchases.start_totals(stream, out, checkpoint).awaitTermination()
    batch = rfm.customer_totals(accepted(validate_transactions(rows)))
    assert sorted(purchases.current_totals(spark, out).collect()) == sorted(batch.collect())


def test_snapshots_bound_what_is_read(spark, rows):
    out, checkpoint = paths(spark)
    source = scratch_path(spark, "arrivals")
    for part in range(6):
        rows.where(f"num_cds_purchased % 6 = {part} OR {part} = 5").write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        purchases.start_totals(stream, out, checkpoint).awaitTermination()
        if part % 2:
            before = sorted(purchases.current_totals(spark, out).collect())
            purchases.compact_totals(spark, out)
            purchases.compact_totals(spark, out)
            assert sorted(purchases.current_totals(spark, out).collect()) == before
    batch = rfm.customer_totals(accepted(validate_transactions(spark.read.parquet(source))))
    assert sorted(purchases.current_totals(spark, out).collect()) == sorted(batch.collect())
    read = purchases.current_totals(spark, out).inputFiles()
    assert all("until=" in file for file in read) and len({f.rsplit("/", 1)[0] for f in read}) == 1


def test_scores_follow_the_newest_totals(spark, rows):
    out, checkpoint = paths(spark)
    customers = stage(
        rfm.rfm_table(accepted(validate_transactions(rows)), as_of="1998-06-30", clean=False)
    )
    model = kmeans.fit_kmeans(customers, 2)
    stream = stream_of(spark, rows, (2, 0, 3, 1))
    purchases.start_scoring(stream, model, out, checkpoint).awaitTermination()
    expected = sorted(kmeans.assign(model, customers).collect())
    assert sorted(purchases.current_scores(spark, out).collect()) == expected
    purchases.compact_scores(spark, out)
    assert sorted(purchases.current_scores(spark, out).collect()) == expected


def test_quarantine(spark, rows):
    out, checkpoint = paths(spark)
    stream = stream_of(spark, rows, (0, 1, 2, 3))
    purchases.start_rejects(stream, out, checkpoint).awaitTermination()
    expected = rejected(validate_transactions(rows))
    assert sorted(map(str, spark.read.parquet(out).collect())) == sorted(
        map(str, expected.collect())
    )


def test_state_store_setting_is_restored(spark, rows):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    out, checkpoint = paths(spark)
    purchases.start_totals(stream_of(spark, rows, (0,)), out, checkpoint).awaitTermination()
    assert spark.conf.get(key) == before


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (3, 1, 0, 2)])
def test_live_levels_equal_the_batch_result_after_every_batch(spark, rows, order):
    out, checkpoint = paths(spark)
    source = scratch_path(spark, "arrivals")
    arrived = None
    for turn, part in enumerate(order):
        some = rows.where(f"pmod(hash(transaction_date, transaction_value), 4) = {part}")
        some.coalesce(1).write.mode("append").parquet(source)
        arrived = some if arrived is None else arrived.unionAll(some)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        quartiles.start_levels(stream, 4, out, checkpoint, "1998-06-30").awaitTermination()
        table = stage(
            rfm.rfm_table(accepted(validate_transactions(arrived)), as_of="1998-06-30", clean=False)
        )
        scored = segments.scores(ranking.quartiles(table))
        batch = segments.levels(scored, 4)
        live = quartiles.live_levels(spark, out, 4, "1998-06-30")
        assert sorted(live.select(batch.columns).collect()) == sorted(batch.collect())
        profile = spark.read.parquet(f"{out}/profiles/batch={turn}")
        assert sorted(profile.collect()) == sorted(segments.rfm_profile(scored, 4).collect())
        counted = quartiles._live(spark, f"{out}/tree").where("level = 7").groupBy("metric").sum("n")
        assert {row[1] for row in counted.collect()} == {table.count()}
        if turn == 1:
            quartiles.compact_levels(spark, out)


def test_live_quartiles_need_two_customers(spark, rows):
    out, checkpoint = paths(spark)
    source = scratch_path(spark, "arrivals")
    rows.where("customer_id = 'c3'").write.parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source)
    quartiles.start_levels(stream, 4, out, checkpoint, "1998-06-30").awaitTermination()
    with pytest.raises(ValueError):
        quartiles.live_scores(spark, out, "1998-06-30")
