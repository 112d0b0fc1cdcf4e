"""Streaming first-seen ingest over several micro-batches, replay and epoch retry."""

from pyspark.sql import functions as F

from pulse.domain import FEED_AS_OF
from pulse.plans import incremental as I
from pulse.session import shared_dir
from pulse.sources import bindings
from pulse.streaming import first_seen as S

SF = "/root/testdata/sf0.01"


def _land_in_three_files(spark, path):
    ev = bindings.table(spark, SF, "events")
    part = (F.when(F.dayofmonth("ts") <= 10, 0).when(F.dayofmonth("ts") <= 20, 1).otherwise(2))
    ev.withColumn("_p", part).repartition(1, "_p").write.partitionBy("_p").parquet(path)


def test_multi_batch_ledger_equals_batch_answer(spark):
    base = shared_dir(spark, "test-stream")
    landing = f"{base}/landing"
    _land_in_three_files(spark, landing)
    schema = bindings.table(spark, SF, "events").schema
    store = S.LedgerStore(spark, f"{base}/lb", f"{base}/ll")
    bindings.ledger(spark, SF).write.parquet(store.base_path)
    details = bindings.details(spark, SF)

    def stream():
        src = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
               .option("recursiveFileLookup", True).parquet(landing))
        return bindings.feed_rows(src)

    q = S.run_first_seen(spark, stream(), store, details, f"{base}/rc", f"{base}/cp1", "r1", FEED_AS_OF)
    batches = [p for p in q.recentProgress if p["numInputRows"] > 0]
    first = store.current()
    ids = [r.entity_id for r in first.select("entity_id").collect()]
    assert len(ids) == len(set(ids)), "a company entered the ledger twice"

    batch = I.from_testdata(spark, SF).ledger
    assert set(ids) == {r.entity_id for r in batch.select("entity_id").collect()}

    # replay the whole feed from a fresh checkpoint: nothing new is written
    S.run_first_seen(spark, stream(), store, details, f"{base}/rc", f"{base}/cp2", "r2", FEED_AS_OF)
    assert store.log().filter(F.col("run") == "r2").count() == 0
    assert store.current().count() == len(ids)

    assert len(batches) == 3, "expected one micro-batch per landed file"


def test_retried_epoch_overwrites_its_partition(spark):
    base = shared_dir(spark, "test-retry")
    store = S.LedgerStore(spark, f"{base}/lb", f"{base}/ll")
    spark.createDataFrame([], S.LEDGER_SCHEMA).write.parquet(store.base_path)   # nothing seen yet
    feed, details = bindings.feed(spark, SF), bindings.details(spark, SF)
    S.first_seen_batch(feed, 7, store, details, f"{base}/rc", "r1", FEED_AS_OF)
    once = store.log().count()
    assert once > 0
    S.first_seen_batch(feed, 7, store, details, f"{base}/rc", "r1", FEED_AS_OF)   # retry of epoch 7
    assert store.log().count() == once
    ids = [r.entity_id for r in store.current().select("entity_id").collect()]
    assert len(ids) == len(set(ids))


def test_daily_counts_keep_late_events_within_the_delay(spark):
    """Two micro-batches; the second arrives after the watermark moved to 2024-01-09.

    The event inside the one-day delay must be counted in its own day.  Spark
    does not promise to drop events behind the watermark (the watermark bounds
    state, it is not a filter), so the old event is only checked to be counted
    at most once."""
    import datetime as dt
    import time
    base = shared_dir(spark, "test-late")
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    first = [(1, dt.datetime(2024, 1, 10, 8), 1, "click", 1.0, "{}"),
             (2, dt.datetime(2024, 1, 10, 9), 2, "click", 1.0, "{}")]
    late = [(3, dt.datetime(2024, 1, 9, 12), 3, "click", 1.0, "{}"),     # within the 1-day delay
            (4, dt.datetime(2024, 1, 5, 12), 4, "click", 1.0, "{}")]     # behind the watermark
    spark.createDataFrame(first, schema).coalesce(1).write.parquet(f"{base}/in/a")
    time.sleep(1.5)                       # the file source orders files by modification time
    spark.createDataFrame(late, schema).coalesce(1).write.parquet(f"{base}/in/b")
    src = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
           .option("recursiveFileLookup", True).parquet(f"{base}/in"))
    S.daily_counts_stream(src, f"{base}/out", f"{base}/cp")
    got = {(r.day.date(), r.event_type): r.n for r in S.read_daily_counts(spark, f"{base}/out").collect()}
    assert got[(dt.date(2024, 1, 10), "click")] == 2
    assert got[(dt.date(2024, 1, 9), "click")] == 1
    assert got.get((dt.date(2024, 1, 5), "click"), 0) <= 1


def test_streams_read_a_table_of_many_files_whole(spark, tmp_path):
    from pulse.plans import catalog
    whole = "/root/testdata/sf0.001"
    folder = tmp_path / "sf"
    folder.mkdir()
    for name in ("nation", "region", "customer", "supplier", "orders", "lineitem", "part"):
        (folder / f"{name}.parquet").symlink_to(f"{whole}/{name}.parquet")
    bindings.table(spark, whole, "events").repartition(5).write.parquet(str(folder / "events.parquet"))
    for key in ("stream_daily_counts", "stream_first_seen"):
        one, many = (sorted(map(str, catalog.STREAM_QUERIES[key](spark, d).collect())) for d in (whole, str(folder)))
        assert one == many and one


def test_register_has_one_row_per_company_after_a_crash_between_the_writes(spark):
    base = shared_dir(spark, "test-crash")
    feed, details = bindings.feed(spark, SF), bindings.details(spark, SF)
    store = S.LedgerStore(spark, f"{base}/lb", f"{base}/ll")
    spark.createDataFrame([], S.LEDGER_SCHEMA).write.parquet(store.base_path)
    S.first_seen_batch(feed, 0, store, details, f"{base}/rc", "r1", FEED_AS_OF)
    lost = S.LedgerStore(spark, f"{base}/lb", f"{base}/ll2")  # the changes of r1 stay, its ledger rows are lost
    S.first_seen_batch(feed, 0, lost, details, f"{base}/rc", "r2", FEED_AS_OF)
    reg = bindings.register(spark, SF)
    now = S.current_register(reg.limit(0), spark, f"{base}/rc", reg.schema, FEED_AS_OF)
    assert now.count() == now.select("entity_id").distinct().count() > 0
