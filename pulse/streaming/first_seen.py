"""Incremental ingest as Structured Streaming jobs.

N1  first-seen ingest: feed entries -> first entries -> first occurrence per
    company in the micro-batch -> not in the seen-ledger -> enrich with the
    landed details -> ledger rows + register changes.
N2  daily entry counts per type: event-time tumbling windows with a watermark.
N3  replay: re-running N1 over the same feed (fresh checkpoint) changes nothing.

State lives in tables, not in the stream: the ledger is a base snapshot plus
an append-only log partitioned by (run, epoch).  Every micro-batch writes its
own partition with dynamic partition overwrite, so a retried epoch replaces
its earlier attempt and a replay sees every key it already wrote.  Changes are
written before the ledger: after a crash between the two a new run logs the
same companies again, and readers take the last logged change of each.  The ledger lookup is a broadcast semi join of the (small) batch keys
against the ledger scan, so the ledger is never shuffled per batch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.domain import BOUND
from pulse.functions import calendar as cal
from pulse.operators import upsert as U
from pulse.operators.joins import checked_broadcast
from pulse.operators.normalise import normalise_register_fields
from pulse.plans import incremental as I

LEDGER_SCHEMA = ("entity_id string, first_seen_at timestamp_ntz, source_entry_at timestamp_ntz, "
                 "source_ruling_no string")
LOG_PARTITIONS = ("run", "epoch")


def ensure_dataset(spark: SparkSession, path: str, schema: str) -> None:
    """Create an empty dataset at ``path`` unless one exists (readers then see zero rows)."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)


@dataclass
class LedgerStore:
    """Seen-ledger = base snapshot + append-only log of later runs."""

    spark: SparkSession
    base_path: str
    log_path: str

    def __post_init__(self):
        ensure_dataset(self.spark, self.log_path, f"{LEDGER_SCHEMA}, run string, epoch long")

    def log(self, schema: str = LEDGER_SCHEMA) -> DataFrame:
        return (self.spark.read.schema(f"{schema}, run string, epoch long")
                .parquet(self.log_path))

    def current(self, exclude: tuple[str, int] | None = None) -> DataFrame:
        log = self.log()
        if exclude is not None:  # never read the partition this batch is about to (re)write
            run, epoch = exclude
            log = log.filter(~((F.col("run") == run) & (F.col("epoch") == epoch)))
        base = self.spark.read.schema(LEDGER_SCHEMA).parquet(self.base_path)
        return base.unionByName(log.drop(*LOG_PARTITIONS))


def _write_partition(df: DataFrame, path: str, run: str, epoch: int) -> None:
    (df.withColumn("run", F.lit(run)).withColumn("epoch", F.lit(epoch).cast("long"))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*LOG_PARTITIONS).parquet(path))


def first_seen_batch(batch: DataFrame, epoch: int, store: LedgerStore, details: DataFrame,
                     changes_path: str, run: str, run_ts, domain=BOUND,
                     key_bound: int = U.BROADCAST_KEY_BOUND) -> None:
    """foreachBatch body of N1 (also usable on a plain batch DataFrame).

    The batch's discovered and unseen rows are persisted for the duration of
    the body (probe, lookup and two writes share them) and released at the end.
    """
    disc = I.discovered(batch, domain.first_entry_type).persist(StorageLevel.MEMORY_AND_DISK)
    keys = checked_broadcast(disc.select("entity_id"), key_bound)
    known = store.current(exclude=(run, epoch)).join(keys, "entity_id", "left_semi")
    new = (disc.join(known.select("entity_id"), "entity_id", "left_anti")
           .persist(StorageLevel.MEMORY_AND_DISK))
    try:
        # the details of the batch's companies only are normalised
        found = details.join(new.select("entity_id"), "entity_id", "left_semi")
        loaded = normalise_register_fields(found, domain, trim=False)
        seen = I.ledger_rows(U.only_loaded(new, loaded), run_ts)
        _write_partition(loaded, changes_path, run, epoch)
        _write_partition(seen, store.log_path, run, epoch)
    finally:
        new.unpersist()
        disc.unpersist()


def run_first_seen(spark: SparkSession, source: DataFrame, store: LedgerStore, details: DataFrame,
                   changes_path: str, checkpoint: str, run: str, run_ts, domain=BOUND):
    """Start N1 over a streaming feed DataFrame and wait for the available data."""
    cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in details.schema.fields)
    ensure_dataset(spark, changes_path, f"{cols}, run string, epoch long")

    def body(batch, epoch_id):
        first_seen_batch(batch, epoch_id, store, details, changes_path, run, run_ts, domain)
    q = (source.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def current_register(base: DataFrame, spark: SparkSession, changes_path: str, register_schema,
                     run_ts, preserve=I.ACTIVITY_COLUMNS) -> DataFrame:
    """Register as of now = base snapshot upserted with the logged changes (merge on read)."""
    cols = [f"{f.name} {f.dataType.simpleString()}" for f in register_schema.fields
            if f.name != "loaded_at"]
    changes = (spark.read.schema(", ".join(cols) + ", run string, epoch long").parquet(changes_path))
    # a run that stopped between its two writes left changes that the next run logs again: the
    # last logged change of a company counts, once
    last = F.max_by(F.struct(*[F.col(f.name) for f in register_schema.fields if f.name != "loaded_at"]),
                    F.struct("run", "epoch"))
    latest = changes.groupBy(F.col("entity_id").alias("_key")).agg(last.alias("_row")).select("_row.*")
    return U.upsert(base, latest, "entity_id", preserve=preserve,
                    stamp_col="loaded_at", run_ts=run_ts, order=None)


def daily_counts_stream(source: DataFrame, out_path: str, checkpoint: str,
                        ts_col: str = "ts", type_col: str = "event_type",
                        delay: str = "1 day") -> None:
    """Count entries per day and type with a watermark; every micro-batch
    appends its updated counts (update mode) to ``out_path``."""
    # watermarks need a zoned timestamp; map the wall clock to an instant
    # arithmetically so windows are the same in any session time zone
    ts = cal.ntz_to_instant(ts_col)
    counts = (source.withColumn("_ts", ts).withWatermark("_ts", delay)
              .groupBy(F.window("_ts", "1 day").alias("w"), F.col(type_col).alias("event_type"))
              .agg(F.count(F.lit(1)).alias("n")))

    def body(batch, epoch_id):
        (batch.select(cal.instant_day_ntz(F.col("w.start")).alias("day"), "event_type",
                      F.col("n").cast("long").alias("n"), F.lit(epoch_id).cast("long").alias("epoch"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("epoch").parquet(out_path))

    ensure_dataset(source.sparkSession, out_path,
                   "day timestamp_ntz, event_type string, n long, epoch long")
    q = (counts.writeStream.outputMode("update").foreachBatch(body)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def read_daily_counts(spark: SparkSession, out_path: str) -> DataFrame:
    """Final count per (day, type): the latest update is the largest running count."""
    log = spark.read.schema("day timestamp_ntz, event_type string, n long, epoch long").parquet(out_path)
    return log.groupBy("day", "event_type").agg(F.max("n").alias("n"))
