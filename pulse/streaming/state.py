"""First-seen ingest with keyed state and a log that is folded away.

Register, seen-ledger and landed details are keyed tables
(:mod:`pulse.sources.keyed`), all dealt by company.  A micro-batch finds the
buckets of its companies and opens only those of the ledger, the log and the
details, so what it reads follows the batch and not the history.  What a batch
adds goes to its own folder of the log (``run``, ``epoch``), which a retried
epoch replaces whole: first the register changes, then the ledger rows, which
complete the epoch.

``compact`` folds completed epochs into the keyed tables and then deletes
their part of the log.  Each table's manifest records up to which epoch of
each run it holds the log; readers add the log beyond that.  A compaction that
stops anywhere leaves every reader with the same rows, and repeating it is
safe: a table that has the epochs already is not changed.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.domain import BOUND, Domain
from pulse.functions import calendar as cal
from pulse.operators import upsert as U
from pulse.operators.joins import broadcast_if_small
from pulse.operators.normalise import normalise_register_fields
from pulse.plans import incremental as I
from pulse.sources.keyed import KeyedTable, delete
from pulse.sources.tables import BUCKET_COL
from pulse.streaming.first_seen import LEDGER_SCHEMA, LOG_PARTITIONS, ensure_dataset

KEY = ["entity_id"]
LOG_KINDS = ("changes", "seen")


@dataclass
class FeedState:
    spark: SparkSession
    register: KeyedTable
    ledger: KeyedTable
    details: KeyedTable
    log_path: str

    @classmethod
    def create(cls, path: str, register: DataFrame, ledger: DataFrame, details: DataFrame,
               buckets: int | None = None, size_hint: int = 0) -> FeedState:
        """Store the three tables below ``path`` with an empty log."""
        make = lambda df, name: KeyedTable.create(df, f"{path}/{name}", KEY, buckets, size_hint=size_hint)
        state = cls(register.sparkSession, make(register, "register"), make(ledger, "ledger"),
                    make(details, "details"), f"{path}/log")
        for kind in LOG_KINDS:
            ensure_dataset(state.spark, f"{state.log_path}/{kind}", state._schema(kind))
        return state

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> FeedState:
        return cls(spark, *[KeyedTable.open(spark, f"{path}/{n}", KEY) for n in ("register", "ledger", "details")],
                   f"{path}/log")

    def _table(self, kind: str) -> KeyedTable:
        return self.register if kind == "changes" else self.ledger

    def _schema(self, kind: str) -> str:
        return self.register.manifest.schema if kind == "changes" else LEDGER_SCHEMA

    def log(self, kind: str) -> DataFrame:
        """Logged rows of a kind with run, epoch and bucket; partitions that a filter on these excludes are not read."""
        return self.spark.read.schema(f"{self._schema(kind)}, run string, epoch bigint, {BUCKET_COL} int").parquet(
            f"{self.log_path}/{kind}")

    def pending(self, kind: str) -> DataFrame:
        """Logged rows that their table does not hold yet."""
        rows = self.log(kind)
        for run, epoch in self._table(kind).manifest.folded.items():
            rows = rows.filter(~((F.col("run") == run) & (F.col("epoch") <= epoch)))
        return rows

    def write_epoch(self, rows: DataFrame, kind: str, run: str, epoch: int) -> None:
        """Replace what the log holds of an epoch."""
        (rows.withColumn(BUCKET_COL, self._table(kind).bucket()).hint("rebalance", BUCKET_COL)
         .write.mode("overwrite").partitionBy(BUCKET_COL).parquet(f"{self.log_path}/{kind}/run={run}/epoch={epoch}"))

    def seen_companies(self, buckets: list[int] | None = None, exclude: tuple[str, int] | None = None) -> DataFrame:
        """The ledger as of now; ``exclude`` names an epoch whose own rows do not count."""
        log = self.pending("seen")
        if exclude:
            log = log.filter(~((F.col("run") == exclude[0]) & (F.col("epoch") == exclude[1])))
        if buckets is not None:
            log = log.filter(F.col(BUCKET_COL).isin(buckets))
        return self.ledger.read(buckets).unionByName(log.drop(*LOG_PARTITIONS, BUCKET_COL))

    def latest_changes(self, until: dict[str, int] | None = None) -> DataFrame:
        """The last logged change of every company that the register does not hold yet."""
        rows = self.pending("changes")
        if until is not None:
            rows = rows.filter(_up_to(until))
        fields = [f.name for f in self.register.read([]).schema.fields]
        last = F.max_by(F.struct(*fields), F.struct(*LOG_PARTITIONS))
        return rows.groupBy(F.col("entity_id").alias("_key")).agg(last.alias("_row")).select("_row.*")

    def companies(self) -> DataFrame:
        """The register as of now."""
        return U.upsert(self.register.read(), self.latest_changes(), KEY, preserve=I.ACTIVITY_COLUMNS, stamp_col=None)


def _up_to(until: dict[str, int]) -> Column:
    inside = F.lit(False)
    for run, epoch in until.items():
        inside = inside | ((F.col("run") == run) & (F.col("epoch") <= epoch))
    return inside


def ingest(batch: DataFrame, epoch: int, state: FeedState, run: str, run_ts: dt.datetime,
           domain: Domain = BOUND) -> None:
    """One micro-batch of feed entries (also usable on a plain DataFrame)."""
    disc = I.discovered(batch, domain.first_entry_type).persist(StorageLevel.MEMORY_AND_DISK)
    held = [disc]
    try:
        buckets = state.ledger.touched(disc)
        keys = broadcast_if_small(disc.select("entity_id"), disc)
        known = state.seen_companies(buckets, (run, epoch)).join(keys, "entity_id", "left_semi")
        new = disc.join(known.select("entity_id"), "entity_id", "left_anti").persist(StorageLevel.MEMORY_AND_DISK)
        held.append(new)
        wanted = broadcast_if_small(new.select("entity_id"), new)
        found = state.details.read(buckets).join(wanted, "entity_id", "left_semi")
        loaded = (normalise_register_fields(found, domain, trim=False).withColumn("loaded_at", cal.ntz_lit(run_ts))
                  .persist(StorageLevel.MEMORY_AND_DISK))
        held.append(loaded)
        state.write_epoch(loaded.select(state.register.read([]).columns), "changes", run, epoch)
        state.write_epoch(I.ledger_rows(U.only_loaded(new, loaded), run_ts), "seen", run, epoch)
    finally:
        for df in held:
            df.unpersist()


def run_ingest(source: DataFrame, state: FeedState, checkpoint: str, run: str, run_ts: dt.datetime,
               domain: Domain = BOUND, entries=lambda batch: batch):
    """Stream what is available and wait for it.  ``entries`` turns a micro-batch of
    ``source`` into feed entries, for sources whose rows are not entries yet."""
    query = (source.writeStream
             .foreachBatch(lambda batch, epoch: ingest(entries(batch), epoch, state, run, run_ts, domain))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def completed(state: FeedState) -> dict[str, int]:
    """Last epoch of every run whose ledger rows are in the log (one row per run)."""
    done = state.log("seen").groupBy("run").agg(F.max("epoch").alias("e"))
    return {r["run"]: r["e"] for r in done.collect()}


def compact(state: FeedState) -> dict[str, int]:
    """Fold the completed epochs into register and ledger, then drop them from the log."""
    until = completed(state)
    behind = lambda t: any(t.manifest.folded.get(r, -1) < e for r, e in until.items())
    if behind(state.register):
        state.register.upsert(state.latest_changes(until), folded=until, preserve=I.ACTIVITY_COLUMNS, stamp_col=None)
    if behind(state.ledger):
        rows = state.pending("seen").filter(_up_to(until)).drop(*LOG_PARTITIONS, BUCKET_COL)
        state.ledger.insert_if_absent(U.first_by_key(rows, KEY, ["first_seen_at", "source_entry_at"]), folded=until)
    forget(state)
    return until


def forget(state: FeedState) -> None:
    """Delete the part of the log that its tables hold, and generations nobody needs."""
    for kind in LOG_KINDS:
        done = state._table(kind).manifest.folded
        old = state.log(kind).select(*LOG_PARTITIONS).distinct().filter(_up_to(done)) if done else None
        for r in old.collect() if old is not None else []:  # a row per folded epoch
            delete(state.spark, f"{state.log_path}/{kind}/run={r['run']}/epoch={r['epoch']}")
        state._table(kind).vacuum()
