"""Keyed tables with a recorded layout, changed one generation at a time.

A table is Parquet files under ``data/gen=<g>/_bucket=<b>``, where the bucket
is the key's hash, and one row per generation under ``manifest/gen=<g>``: the
key, the number of buckets, the table's schema, which generation holds each
bucket, and how far each log has been folded in.  The manifest's row commits
a generation, so

* a change reads and writes only the buckets it touches,
* readers see the last committed generation; a write that stopped half-way
  left files that no manifest names, and the next attempt replaces them,
* nobody has to remember the bucket count: it is read, never passed along.
  Opening a table with another key or count is an error, and a table that has
  outgrown its layout is dealt anew once, by ``rebucket``.

One writer at a time; any number of readers.  The driver handles one number
per bucket (``MOST_BUCKETS`` at most).
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.operators import upsert as U
from pulse.sources.tables import BUCKET_COL, MOST_BUCKETS, bucket_layout, bucket_of, stored_bytes

MANIFEST = ("keys array<string>, buckets int, schema string, holder array<bigint>, "
            "folded map<string,bigint>")


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store its path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@dataclass(frozen=True)
class Manifest:
    gen: int
    keys: list[str]
    buckets: int
    schema: str
    holder: list[int]
    folded: dict[str, int] = field(default_factory=dict)


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, manifest: Manifest):
        self.spark, self.path, self.manifest = spark, path.rstrip("/"), manifest

    # -- making and opening ------------------------------------------------

    @classmethod
    def create(cls, df: DataFrame, path: str, keys: list[str], buckets: int | None = None,
               size_hint: int = 0) -> KeyedTable:
        """Store ``df`` as generation 0; without ``buckets`` the layout follows ``size_hint`` bytes."""
        spark = df.sparkSession
        if cls._last(spark, path):
            raise ValueError(f"{path} already holds a table")
        if buckets is None:
            buckets, _ = bucket_layout(size_hint)
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        table = cls(spark, path, Manifest(-1, list(keys), buckets, schema, [-1] * buckets))
        table._commit(df, range(buckets))
        return table

    @classmethod
    def open(cls, spark: SparkSession, path: str, keys: list[str] | None = None,
             buckets: int | None = None) -> KeyedTable:
        """The table at ``path``; ``keys`` and ``buckets``, where given, must be the recorded ones."""
        found = cls._last(spark, path)
        if found is None:
            raise ValueError(f"no keyed table at {path}")
        if keys is not None and list(keys) != found.keys:
            raise ValueError(f"{path} is keyed by {found.keys}, not {list(keys)}")
        if buckets is not None and buckets != found.buckets:
            raise ValueError(f"{path} has {found.buckets} buckets, not {buckets}")
        return cls(spark, path, found)

    @staticmethod
    def _last(spark: SparkSession, path: str) -> Manifest | None:
        """The last committed manifest.  Its one file appears by a rename, so a row that can be read is complete."""
        try:
            rows = spark.read.schema(f"{MANIFEST}, gen bigint").parquet(f"{path}/manifest")
        except AnalysisException as missing:
            if missing.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        row = rows.agg(F.max_by(F.struct(*rows.columns), "gen").alias("m")).first()["m"]
        return Manifest(**{**row.asDict(), "folded": dict(row["folded"] or {})}) if row else None

    # -- reading -----------------------------------------------------------

    def bucket(self) -> Column:
        """The bucket of a row by its key columns."""
        return bucket_of(self.manifest.keys, self.manifest.buckets)

    def touched(self, rows: DataFrame) -> list[int]:
        """Buckets that rows with the table's key columns fall into (at most one number per bucket)."""
        return sorted(r[0] for r in rows.select(self.bucket().alias("b")).distinct().collect())

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """The table, or its rows in the given buckets; other buckets' files are not opened."""
        m = self.manifest
        by_gen = defaultdict(list)
        for b in range(m.buckets) if buckets is None else buckets:
            by_gen[m.holder[b]].append(b)
        if not by_gen:
            return self.spark.createDataFrame([], m.schema)
        wanted = F.lit(False)
        for gen, held in by_gen.items():
            wanted = wanted | ((F.col("gen") == gen) & F.col(BUCKET_COL).isin(held))
        data = f"{self.path}/data"
        return (self.spark.read.schema(f"{m.schema}, gen bigint, {BUCKET_COL} int").option("basePath", data)
                .parquet(*[f"{data}/gen={gen}" for gen in by_gen]).filter(wanted).drop("gen", BUCKET_COL))

    # -- changing ----------------------------------------------------------

    def _commit(self, rows: DataFrame, buckets, folded: dict[str, int] | None = None,
                layout: Manifest | None = None) -> None:
        """Make ``rows`` the content of ``buckets`` in a new generation."""
        m = layout or self.manifest
        gen = m.gen + 1
        # small buckets share a task, a large one is split into several files
        (rows.withColumn(BUCKET_COL, bucket_of(m.keys, m.buckets)).hint("rebalance", BUCKET_COL)
         .write.mode("overwrite").partitionBy(BUCKET_COL).parquet(f"{self.path}/data/gen={gen}"))
        new = set(buckets)
        done = replace(m, gen=gen, holder=[gen if b in new else h for b, h in enumerate(m.holder)],
                       folded={**m.folded, **(folded or {})})
        (self.spark.createDataFrame([(done.keys, done.buckets, done.schema, done.holder, done.folded)], MANIFEST)
         .coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/gen={gen}"))
        self.manifest = done

    def upsert(self, updates: DataFrame, folded: dict[str, int] | None = None, **upsert_kw) -> list[int]:
        """Apply updates (see :func:`pulse.operators.upsert.upsert`); returns the buckets that were rewritten."""
        buckets = self.touched(updates)
        if buckets or folded:
            held: list[DataFrame] = []
            self._commit(U.upsert(self.read(buckets), updates, self.manifest.keys, cached=held, **upsert_kw), buckets, folded)
            for df in held:
                df.unpersist()
        return buckets

    def insert_if_absent(self, rows: DataFrame, folded: dict[str, int] | None = None) -> list[int]:
        """Add the rows whose key the table does not have; returns the buckets that were rewritten."""
        buckets = self.touched(rows)
        if buckets or folded:
            self._commit(U.insert_if_absent(self.read(buckets), rows, self.manifest.keys), buckets, folded)
        return buckets

    def rebucket(self, buckets: int) -> None:
        """Deal the whole table anew."""
        if not 0 < buckets <= MOST_BUCKETS:
            raise ValueError(f"1 to {MOST_BUCKETS} buckets")
        layout = replace(self.manifest, buckets=buckets, holder=[-1] * buckets)
        self._commit(self.read(), range(buckets), layout=layout)

    def fit_layout(self) -> bool:
        """Deal the table anew if its bytes ask for more than twice its buckets; says whether it was."""
        used = sorted(set(self.manifest.holder))
        wanted, _ = bucket_layout(stored_bytes(self.spark, *[f"{self.path}/data/gen={g}" for g in used]))
        if wanted <= 2 * self.manifest.buckets:
            return False
        self.rebucket(wanted)
        return True

    def vacuum(self) -> None:
        """Delete generations and manifests that the last one does not need; no reader may still use them."""
        m = self.manifest
        for gen in range(m.gen):
            if gen not in m.holder:
                delete(self.spark, f"{self.path}/data/gen={gen}")
            delete(self.spark, f"{self.path}/manifest/gen={gen}")
