"""Keyed change capture: upserts, insert-if-absent, anti/semi filters, dedup.

Without a transactional table format the upsert is a pure DataFrame
transformation (new snapshot = f(old snapshot, updates)); see
:mod:`pulse.sources.tables` for writing it back bucket by bucket.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.operators import bloom
from pulse.operators.joins import fits
from pulse.session import shared_dir, stored_bytes

# An increment below this many keys is broadcast; beyond it the merge is a
# shuffle join on the key.
BROADCAST_KEY_BOUND = 2_000_000
# Bounds of upsert_stored: Parquet bytes of an increment that is broadcast
# (several times that in memory), and bytes of a Bloom filter.
BROADCAST_FILE_BYTES = 64 << 20
FILTER_BYTES = 512 << 20


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def first_by_key(df: DataFrame, key, order: Sequence[str], last: bool = False) -> DataFrame:
    """One row per key: the first (or last) by ``order``.

    ``min_by``/``max_by`` over a struct is a hash aggregate with map-side
    partial results, so a key holding a third of all rows is reduced in
    every task before the shuffle instead of being sorted in one task.
    """
    keys = _keys(key)
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if last else F.min_by
    ordering = F.struct(*[F.col(c) for c in order])
    agg = df.groupBy(*keys).agg(pick(F.struct(*[F.col(c) for c in rest]), ordering).alias("_r"))
    return agg.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def unseen(rows: DataFrame, ledger: DataFrame, key="entity_id") -> DataFrame:
    """Rows whose key is not in the ledger (left anti join)."""
    keys = _keys(key)
    return rows.join(ledger.select(*keys), keys, "left_anti")


def only_loaded(rows: DataFrame, loaded: DataFrame, key="entity_id") -> DataFrame:
    """Rows whose key was successfully loaded (left semi join)."""
    keys = _keys(key)
    return rows.join(loaded.select(*keys), keys, "left_semi")


def insert_if_absent(ledger: DataFrame, rows: DataFrame, key="entity_id",
                     order: Sequence[str] | None = None) -> DataFrame:
    """ledger + rows whose key is not yet present (conflict -> keep the ledger row)."""
    keys = _keys(key)
    new = unseen(rows, ledger, keys)
    if order:
        new = first_by_key(new, keys, order)
    return ledger.unionByName(new.select(*ledger.columns))


def _merged(c: str, keys: list[str], preserve, stamp_col, stamp: Column, present: Column) -> Column:
    """Value of column ``c`` after the merge; ``n__c`` / ``o__c`` are the new / old values."""
    nc, oc = F.col(f"n__{c}"), F.col(f"o__{c}")
    if c in keys:
        return F.coalesce(nc, oc).alias(c)
    if c == stamp_col:
        return F.when(present, stamp).otherwise(oc).alias(c)
    if c in preserve:
        return F.when(present, F.coalesce(nc, oc)).otherwise(oc).alias(c)
    return F.when(present, nc).otherwise(oc).alias(c)


def upsert(target: DataFrame, updates: DataFrame, key="entity_id", *,
           preserve: Sequence[str] = (), stamp_col: str | None = "loaded_at", run_ts=None,
           order: Sequence[str] | None = None, key_bound: int = BROADCAST_KEY_BOUND,
           cached: list | None = None) -> DataFrame:
    """New snapshot of ``target`` after applying ``updates`` keyed on ``key``.

    * every non-key column is replaced by the update's value, except the
      ``preserve`` columns which keep the old value where the new one is NULL;
    * ``stamp_col`` is set to ``run_ts`` on insert and on update;
    * duplicate keys inside ``updates`` collapse first, the last by ``order``
      winning (a later batch overwrites an earlier one);
    * nothing is deleted.

    Plan: when the increment has at most ``key_bound`` rows it is broadcast
    and left-joined to the target, which is read once at full width and never
    shuffled (a second scan reads its key only, to find what to insert); above
    the bound (of rows, and of bytes in memory) the merge is one full-outer
    shuffle join on the key.  The persisted increment is appended to ``cached``
    (when given), so the caller can release it once the result is written.
    """
    keys = _keys(key)
    plan = _Merge(target, updates, keys, preserve, stamp_col, run_ts, order)
    # the increment is computed once: the size probe and the merge share it
    plan.new = plan.new.persist(StorageLevel.MEMORY_AND_DISK)
    if cached is not None:
        cached.append(plan.new)
    return plan.broadcast() if fits(plan.new, key_bound) else plan.shuffle(target)


class _Merge:
    """Both plans of an upsert over the same increment (columns ``n__*`` and ``_present``)."""

    def __init__(self, target, updates, keys, preserve, stamp_col, run_ts, order):
        self.target, self.keys, self.cols = target, keys, target.columns
        upd = first_by_key(updates, keys, order, last=True) if order else updates
        types = {f.name: f.dataType for f in target.schema.fields}
        # stamp literal from ISO text in the target column's own type: no time-zone shift
        stamp = F.lit(run_ts.isoformat(sep=" ") if isinstance(run_ts, dt.datetime) else run_ts)
        if stamp_col in types:
            stamp = stamp.cast(types[stamp_col])
        self.stamp, self.stamp_col = stamp, stamp_col
        self.new = upd.select(*[(F.col(c) if c in upd.columns else F.lit(None)).cast(types[c]).alias(f"n__{c}")
                                for c in self.cols], F.lit(True).alias("_present"))
        self.cond = [F.col(f"n__{k}") == F.col(f"o__{k}") for k in keys]
        present = F.coalesce(F.col("_present"), F.lit(False))
        self.merged = [_merged(c, keys, preserve, stamp_col, stamp, present) for c in self.cols]

    def _old(self, rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(c).alias(f"o__{c}") for c in self.cols])

    def broadcast(self) -> DataFrame:
        """Proven small increment: one pass over the big target, which is never
        shuffled; the rows to insert are the updates whose key a key-only
        scan of the target (filtered to the updates' keys) does not meet."""
        kept = self._old(self.target).join(F.broadcast(self.new), self.cond, "left").select(*self.merged)
        wanted = self.new.select(*[F.col(f"n__{k}").alias(k) for k in self.keys])
        met = self.target.select(*self.keys).join(F.broadcast(wanted), self.keys, "left_semi").select(
            *[F.col(k).alias(f"m__{k}") for k in self.keys])
        inserted = self.new.join(met, [F.col(f"n__{k}") == F.col(f"m__{k}") for k in self.keys], "left_anti")
        return kept.unionByName(inserted.select(*[
            (self.stamp if c == self.stamp_col else F.col(f"n__{c}")).alias(c) for c in self.cols]))

    def shuffle(self, rows: DataFrame) -> DataFrame:
        """One full-outer shuffle join of the increment with ``rows``, which hold every target row it can match."""
        return self._old(rows).join(self.new, self.cond, "full_outer").select(*self.merged)


def upsert_stored(target: DataFrame, updates: DataFrame, key="entity_id", *,
                  preserve: Sequence[str] = (), stamp_col: str | None = "loaded_at", run_ts=None,
                  order: Sequence[str] | None = None, broadcast_bytes: int = BROADCAST_FILE_BYTES,
                  filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """:func:`upsert` for increments of any size, same rows.

    The increment is written once to the shared folder and its bytes are read
    off the files.  Up to ``broadcast_bytes`` it is broadcast.  Beyond that, a
    Bloom filter of its keys goes to the executors (two to three bytes a key;
    at most ``filter_bytes``) and splits the target: rows that cannot match are
    passed on as they are, the others and the increment meet in a full-outer
    shuffle join.  So the shuffle follows the touched rows and not the target.
    Above ``filter_bytes`` the whole target is joined."""
    spark, keys = target.sparkSession, _keys(key)
    plan = _Merge(target, updates, keys, preserve, stamp_col, run_ts, order)
    path = shared_dir(spark, "increment")
    plan.new.write.parquet(path)
    plan.new = spark.read.schema(plan.new.schema).parquet(path)
    if stored_bytes(spark, path) <= broadcast_bytes:
        return plan.broadcast()
    n = plan.new.count()
    if bloom.filter_bytes(n) > filter_bytes:
        return plan.shuffle(target)
    known = bloom.key_filter(plan.new.select(*[F.col(f"n__{k}").alias(k) for k in keys]), keys, n)
    may = bloom.may_hold(known, keys)
    untouched = target.join(F.broadcast(known.rows), may, "left_anti")
    return untouched.unionByName(plan.shuffle(target.join(F.broadcast(known.rows), may, "left_semi")))
