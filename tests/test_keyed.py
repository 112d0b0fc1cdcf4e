"""Keyed tables, keyed stream state, log compaction and streamed feed files."""

import collections
import glob
import json
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

from pulse.domain import FEED_AS_OF
from pulse.plans import incremental as I
from pulse.session import shared_dir
from pulse.sources import bindings, feed, keyed, payloads
from pulse.sources.keyed import KeyedTable
from pulse.streaming import state as ST

SF = "/root/testdata/sf0.001"
SCHEMA = "id string, v int, w string"


def rows(spark, ids, v=1):
    return spark.createDataFrame([(str(i), v, f"w{i}") for i in ids], SCHEMA)


def content(df):
    return sorted(tuple(r) for r in df.collect())


def test_layout_is_recorded_and_checked(spark):
    path = shared_dir(spark, "keyed")
    KeyedTable.create(rows(spark, range(100)), path, ["id"], buckets=7)
    assert KeyedTable.open(spark, path).manifest.buckets == 7
    KeyedTable.open(spark, path, ["id"], 7)
    with pytest.raises(ValueError, match="7 buckets"):
        KeyedTable.open(spark, path, ["id"], 8)
    with pytest.raises(ValueError, match="keyed by"):
        KeyedTable.open(spark, path, ["v"])
    with pytest.raises(ValueError, match="already"):
        KeyedTable.create(rows(spark, [1]), path, ["id"], buckets=7)
    with pytest.raises(ValueError, match="no keyed table"):
        KeyedTable.open(spark, path + "-none")


def test_growing_table_keeps_one_row_per_key(spark, monkeypatch):
    path = shared_dir(spark, "keyed")
    table = KeyedTable.create(rows(spark, range(50)), path, ["id"], buckets=4)
    for step in range(1, 4):
        KeyedTable.open(spark, path).upsert(rows(spark, range(25 * step, 25 * step + 50), v=step + 1), stamp_col=None)
    monkeypatch.setattr(keyed, "bucket_layout", lambda n: (9, 1))  # the table asks for more buckets now
    table = KeyedTable.open(spark, path)
    assert table.fit_layout() and not table.fit_layout()
    table = KeyedTable.open(spark, path)
    assert table.manifest.buckets == 9
    table.upsert(rows(spark, [3, 500], v=9), stamp_col=None)
    want = {i: 1 for i in range(50)} | {i: 1 + max(s for s in range(1, 4) if 25 * s <= i < 25 * s + 50) for i in range(25, 125)}
    want |= {3: 9, 500: 9}
    assert content(table.read()) == sorted((str(i), v, f"w{i}") for i, v in want.items())


def test_touched_buckets_only_are_rewritten_and_vacuum_keeps_the_rest(spark):
    path = shared_dir(spark, "keyed")
    table = KeyedTable.create(rows(spark, range(200)), path, ["id"], buckets=16)
    touched = table.upsert(rows(spark, [5], v=2), stamp_col=None)
    assert len(touched) == 1 and [g for g in table.manifest.holder if g == 1] == [1]
    assert {p.rsplit("_bucket=", 1)[1].split("/")[0] for p in table.read().inputFiles() if "gen=1/" in p} == {str(touched[0])}
    table.upsert(rows(spark, [5], v=3), stamp_col=None)
    before = content(table.read())
    table.vacuum()
    table.vacuum()
    assert content(KeyedTable.open(spark, path).read()) == before
    assert len(glob.glob(path.removeprefix("file:") + "/data/gen=*")) == 2


def test_a_write_that_stops_half_way_is_not_seen(spark, monkeypatch):
    path = shared_dir(spark, "keyed")
    table = KeyedTable.create(rows(spark, range(30)), path, ["id"], buckets=4)
    create = spark.createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, *a, **k: (_ for _ in ()).throw(RuntimeError("killed"))
                        if a[1:] == (keyed.MANIFEST,) else create(*a, **k))
    updates = spark.range(5).select(F.col("id").cast("string").alias("id"), F.lit(7).alias("v"), F.lit("x").alias("w"))
    with pytest.raises(RuntimeError, match="killed"):
        table.upsert(updates, stamp_col=None)
    monkeypatch.undo()
    assert content(KeyedTable.open(spark, path).read()) == sorted((str(i), 1, f"w{i}") for i in range(30))
    KeyedTable.open(spark, path).upsert(updates, stamp_col=None)
    assert [r for r in content(KeyedTable.open(spark, path).read()) if r[1] == 7] == [(str(i), 7, "x") for i in range(5)]


def test_empty_updates_and_empty_tables(spark):
    path = shared_dir(spark, "keyed")
    table = KeyedTable.create(spark.createDataFrame([], SCHEMA), path, ["id"], buckets=3)
    assert table.read().count() == 0 and table.read([]).count() == 0
    assert table.upsert(spark.createDataFrame([], SCHEMA), stamp_col=None) == []
    assert table.manifest.gen == 0
    table.insert_if_absent(rows(spark, [1, 2]))
    table.insert_if_absent(rows(spark, [2, 3], v=5))
    assert [(r[0], r[1]) for r in content(table.read())] == [("1", 1), ("2", 1), ("3", 5)]


def new_state(spark, sf=SF):
    base = shared_dir(spark, "feed-state")
    return base, ST.FeedState.create(base, bindings.register(spark, sf), bindings.ledger(spark, sf),
                                     bindings.details(spark, sf), buckets=8)


def ids(df):
    found = [r[0] for r in df.select("entity_id").collect()]
    assert len(found) == len(set(found))
    return set(found)


def snapshot(state):
    return content(state.companies()), content(state.seen_companies())


def test_compaction_changes_no_reader_wherever_it_stops(spark, monkeypatch):
    base, state = new_state(spark)
    entries = bindings.feed(spark, SF)
    ST.ingest(entries.filter("page < '2024-01-06'"), 0, state, "r1", FEED_AS_OF)
    ST.ingest(entries.filter("page >= '2024-01-06'"), 1, state, "r1", FEED_AS_OF)
    want = snapshot(state)
    batch = I.from_testdata(spark, SF)
    assert ids(state.seen_companies()) == ids(batch.ledger)
    assert content(state.companies()) == content(batch.register.select(state.companies().columns))

    def stop(*_, **__):
        raise RuntimeError("killed")

    # after the register was folded, before the ledger was; then before the log was deleted
    for target, name in ((KeyedTable, "insert_if_absent"), (ST, "forget")):
        with monkeypatch.context() as m:
            m.setattr(target, name, stop)
            with pytest.raises(RuntimeError, match="killed"):
                ST.compact(ST.FeedState.open(spark, base))
        assert snapshot(ST.FeedState.open(spark, base)) == want
    state = ST.FeedState.open(spark, base)
    assert ST.compact(state)["r1"] >= 0
    generation = state.register.manifest.gen
    assert state.log("seen").count() == 0 and state.log("changes").count() == 0
    ST.compact(ST.FeedState.open(spark, base))
    state = ST.FeedState.open(spark, base)
    assert state.register.manifest.gen == generation and snapshot(state) == want
    # an epoch that was folded and is retried adds nothing
    ST.ingest(entries.filter("page >= '2024-01-06'"), 1, state, "r1", FEED_AS_OF)
    assert snapshot(ST.FeedState.open(spark, base)) == want


def test_retried_epoch_replaces_its_rows(spark):
    _, state = new_state(spark)
    entries = bindings.feed(spark, SF)
    ST.ingest(entries, 3, state, "r1", FEED_AS_OF)
    once = snapshot(state)
    ST.ingest(entries, 3, state, "r1", FEED_AS_OF)
    assert snapshot(state) == once


def test_companies_without_details_are_tried_again(spark):
    base = shared_dir(spark, "feed-state")
    details = bindings.details(spark, SF)
    state = ST.FeedState.create(base, bindings.register(spark, SF), bindings.ledger(spark, SF).limit(0),
                                details.limit(0), buckets=8)
    entries = bindings.feed(spark, SF)
    ST.ingest(entries, 0, state, "r1", FEED_AS_OF)
    assert state.seen_companies().count() == 0
    state.details.insert_if_absent(details)
    ST.ingest(entries, 1, state, "r1", FEED_AS_OF)
    found = ids(state.seen_companies())
    assert found == ids(I.discovered(entries, "signup").join(details.select("entity_id"), "entity_id", "left_semi"))


def test_feed_files_are_read_once_and_in_portions(spark):
    base, state = new_state(spark)
    pages = payloads.feed_page_records(spark, SF)
    landing = f"{base}/landing"
    payloads.land_feed_pages(pages.filter("page < 10"), f"{landing}/a")
    source = lambda: feed.stream_feed_lists(spark, f"{landing}/*")
    first = ST.run_ingest(source(), state, f"{base}/cp", "r1", FEED_AS_OF, entries=feed.list_entries)
    assert sum(p["numInputRows"] for p in first.recentProgress) == pages.filter("page < 10").count()
    payloads.land_feed_pages(pages.filter("page >= 10"), f"{landing}/b")
    second = ST.run_ingest(source(), state, f"{base}/cp", "r1", FEED_AS_OF, entries=feed.list_entries)
    assert sum(p["numInputRows"] for p in second.recentProgress) == pages.filter("page >= 10").count()
    third = ST.run_ingest(source(), state, f"{base}/cp", "r1", FEED_AS_OF, entries=feed.list_entries)
    assert sum(p["numInputRows"] for p in third.recentProgress) == 0
    assert ids(state.seen_companies()) == ids(I.from_testdata(spark, SF).ledger)


BYTES = """
    import datetime as dt, sys
    from pyspark.sql import functions as F
    from pulse.session import build_session
    from pulse.streaming import state as ST
    spark = build_session("local[2]", 2, extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://" + sys.argv[1],
        "spark.checkpoint.dir": "file://" + sys.argv[1] + "/cp", "spark.driver.host": "127.0.0.1",
        "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    ts = dt.datetime(2024, 1, 1)
    reg = ("entity_id string, legal_form string, founded_on date, county string, status string, activity_code string, "
           "activity_name string, activity_version string, loaded_at timestamp_ntz")
    empty = spark.createDataFrame([], reg)
    for size in (5_000, 50_000):
        ledger = spark.range(size).select(F.col("id").cast("string").alias("entity_id"), *[F.lit(ts).cast("timestamp_ntz").alias(c)
            for c in ("first_seen_at", "source_entry_at")], F.sha2(F.col("id").cast("string"), 256).alias("source_ruling_no"))
        details = ledger.select("entity_id", *[F.lit("x").alias(c) for c in ("legal_form",)], F.lit(None).cast("date").alias("founded_on"),
            *[F.lit("y").alias(c) for c in ("county", "status", "activity_code", "activity_name", "activity_version")])
        spark.sparkContext.setJobDescription("setup")
        state = ST.FeedState.create(f"file://{sys.argv[1]}/state-{size}", empty, ledger, details, buckets=64)
        for companies in (2, 2000):
            batch = spark.range(companies).select((F.col("id") * 7 + 1).cast("string").alias("entity_id"), F.lit("signup").alias("entry_type"),
                F.lit(ts).cast("timestamp_ntz").alias("entry_at"), F.lit("1").alias("ruling_no"), F.lit(1).alias("page"), F.col("id").alias("position"))
            spark.sparkContext.setJobDescription(f"{size}-{companies}")
            ST.ingest(batch, companies, state, "r1", ts)
    spark.stop()
"""


def test_bytes_read_follow_the_batch(tmp_path):
    """Read off the event log: two companies open two of 64 buckets, whatever the ledger holds."""
    run = subprocess.run([sys.executable, "-c", textwrap.dedent(BYTES), str(tmp_path)], capture_output=True, text=True,
                         timeout=300, cwd="/".join(__file__.split("/")[:-2]))
    assert run.returncode == 0, run.stderr[-2000:]
    job_of, read = {}, collections.Counter()
    for log in glob.glob(f"{tmp_path}/local-*"):
        for line in open(log):
            event = json.loads(line)
            if event["Event"] == "SparkListenerJobStart":
                for stage in event["Stage IDs"]:
                    job_of[stage] = event["Properties"].get("spark.job.description")
            elif event["Event"] == "SparkListenerTaskEnd":
                read[job_of.get(event["Stage ID"])] += event["Task Metrics"]["Input Metrics"]["Bytes Read"]
    for size in ("5000", "50000"):
        assert 0 < read[f"{size}-2"] < read[f"{size}-2000"] / 10, read
