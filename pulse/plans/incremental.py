"""Daily incremental load as a batch plan.

feed entries -> first entries (C6) -> first occurrence per company (C5)
-> not yet in the seen-ledger (C4) -> enrich with landed details (C8)
-> upsert, preserving activity fields (C2) -> ledger gets loaded keys only
(C9, C3) -> run counters (C10).

Every step is a join or an aggregation on the company key; nothing is
collected to the driver.  Keys whose details are missing stay out of the
ledger, so the next run retries them.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.domain import BOUND, FEED_AS_OF, Domain
from pulse.functions import calendar as cal
from pulse.operators import upsert as U
from pulse.operators.normalise import normalise_register_fields
from pulse.session import ensure_checkpoint_dir
from pulse.sources import bindings
from pulse.sources.tables import observed_write

ACTIVITY_COLUMNS = ("activity_code", "activity_name", "activity_version")


def first_entries(feed: DataFrame, entry_type: str) -> DataFrame:
    """Feed entries of the first-registration type."""
    return feed.filter(F.col("entry_type") == entry_type)


def discovered(feed: DataFrame, entry_type: str) -> DataFrame:
    """First occurrence of each company across pages (page, position order)."""
    rows = first_entries(feed, entry_type).select("entity_id", "entry_at", "ruling_no",
                                                 "page", "position")
    return U.first_by_key(rows, "entity_id", ["page", "position"])


def daily_slice(feed: DataFrame, as_of, ts_col: str = "entry_at") -> DataFrame:
    """Entries from yesterday 00:00 (inclusive) to today 00:00 (exclusive)."""
    return feed.filter(cal.half_open_day(ts_col, as_of))


def ledger_rows(rows: DataFrame, run_ts) -> DataFrame:
    """Discovered rows in ledger shape."""
    return rows.select("entity_id", cal.ntz_lit(run_ts).alias("first_seen_at"),
                       F.col("entry_at").alias("source_entry_at"),
                       F.col("ruling_no").alias("source_ruling_no"))


@dataclass
class IncrementalRun:
    """All intermediate results of one run; discovered, unseen and loaded_details are stored, the rest is lazy."""

    discovered: DataFrame
    unseen: DataFrame
    loaded_details: DataFrame
    failed: DataFrame
    seen_rows: DataFrame
    register: DataFrame
    ledger: DataFrame

    def metrics(self) -> DataFrame:
        """One row of counters, from one aggregation over tagged rows (no cross join)."""
        parts = [("discovered", self.discovered), ("unseen", self.unseen),
                 ("upserted", self.loaded_details), ("seen_inserted", self.seen_rows),
                 ("failed", self.failed)]
        tagged = None
        for name, df in parts:
            t = df.select(F.lit(name).alias("_k"))
            tagged = t if tagged is None else tagged.unionByName(t)
        return tagged.agg(*[F.count(F.when(F.col("_k") == n, 1)).cast("long").alias(n)
                            for n, _ in parts])


def run(register: DataFrame, ledger: DataFrame, feed: DataFrame, details: DataFrame,
        run_ts, domain: Domain = BOUND, window_as_of=None) -> IncrementalRun:
    """Plan one incremental run; ``window_as_of`` limits the feed to the previous day."""
    f = daily_slice(feed, window_as_of) if window_as_of is not None else feed
    # three steps are stored once in the shared checkpoint folder; register,
    # ledger and counters all read them instead of repeating the feed scans
    ensure_checkpoint_dir(feed.sparkSession)
    disc = discovered(f, domain.first_entry_type).checkpoint()
    new = U.unseen(disc, ledger).checkpoint()
    det = normalise_register_fields(details, domain, trim=False)
    loaded = det.join(new.select("entity_id"), "entity_id", "left_semi").checkpoint()
    failed = new.join(loaded.select("entity_id"), "entity_id", "left_anti")
    reg2 = U.upsert(register, loaded, "entity_id", preserve=ACTIVITY_COLUMNS,
                    stamp_col="loaded_at", run_ts=run_ts)
    seen = ledger_rows(U.only_loaded(new, loaded), run_ts)
    ledger2 = U.insert_if_absent(ledger, seen)
    return IncrementalRun(disc, new, loaded, failed, seen, reg2, ledger2)


def run_observed(register: DataFrame, ledger: DataFrame, feed: DataFrame, details: DataFrame, out_dir: str,
                 run_ts, domain: Domain = BOUND, window_as_of=None) -> tuple[dict[str, str], dict[str, int]]:
    """:func:`run` as a chain of written tables whose counters are taken while they
    are written: no table is read again to be counted.  Returns paths and counters."""
    spark, base = feed.sparkSession, out_dir.rstrip("/")
    paths: dict[str, str] = {}
    counters: dict[str, int] = {}

    def put(name: str, df: DataFrame, counter: str | None = None) -> DataFrame:
        paths[name] = f"{base}/{name}"
        counters.update(observed_write(df, paths[name], {counter: F.count(F.lit(1))} if counter else {}))
        return spark.read.schema(df.schema).parquet(paths[name])

    f = daily_slice(feed, window_as_of) if window_as_of is not None else feed
    disc = put("discovered", discovered(f, domain.first_entry_type), "discovered")
    new = put("unseen", U.unseen(disc, ledger), "unseen")
    found = details.join(new.select("entity_id"), "entity_id", "left_semi")
    loaded = put("loaded", normalise_register_fields(found, domain, trim=False), "upserted")
    put("retry", new.join(loaded.select("entity_id"), "entity_id", "left_anti"), "failed")
    seen = put("seen", ledger_rows(U.only_loaded(new, loaded), run_ts), "seen_inserted")
    put("register", U.upsert_stored(register, loaded, preserve=ACTIVITY_COLUMNS, run_ts=run_ts))
    put("ledger", U.insert_if_absent(ledger, seen))
    return paths, counters


def counters_frame(spark: SparkSession, counters: dict[str, int]) -> DataFrame:
    """Counters as one row of longs."""
    return spark.createDataFrame([tuple(counters.values())], ", ".join(f"{n} long" for n in counters))


def from_testdata(spark: SparkSession, sf_dir: str, run_ts: dt.datetime = FEED_AS_OF,
                  window_as_of=None) -> IncrementalRun:
    return run(bindings.register(spark, sf_dir), bindings.ledger(spark, sf_dir),
               bindings.feed(spark, sf_dir), bindings.details(spark, sf_dir), run_ts,
               window_as_of=window_as_of)
