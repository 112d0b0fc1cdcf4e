"""Materialisation helpers: tables as Parquet datasets in shared storage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulse.operators.upsert import upsert
from pulse.session import stored_bytes  # noqa: F401  (used as tables.stored_bytes)


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when a completely written dataset exists at ``path``: its success
    marker is there (a load that stopped half-way leaves none and is repeated)
    and it can be read.  Errors other than a missing path are raised."""
    try:
        spark.read.format("binaryFile").load(f"{path}/_SUCCES[S]").select("path").schema
        spark.read.parquet(path).schema
        return True
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_clustered(df: DataFrame, path: str, partition_by: list[str], cluster_by: list[str]) -> None:
    """Store ``df`` in a folder per value of ``partition_by``, sorted by ``cluster_by``
    within each file: filters on the former skip folders, on the latter row groups.
    Small partitions share a write task, a large one is split over several."""
    (df.hint("rebalance", *partition_by).sortWithinPartitions(*partition_by, *cluster_by)
     .write.mode("overwrite").partitionBy(*partition_by).parquet(path))


def observed_write(df: DataFrame, path: str, counters: dict[str, Column],
                   partition_by: list[str] | None = None) -> dict[str, int]:
    """Store ``df`` and return the counters (aggregates), taken from the rows as they are
    written.  They belong to the job's last stage, so a task that is run again counts once."""
    if not counters:
        write_table(df, path, partition_by)
        return {}
    seen = Observation()
    write_table(df.observe(seen, *[c.alias(n) for n, c in counters.items()]), path, partition_by)
    return seen.get


def read_evolved(spark: SparkSession, path: str, schema: T.StructType, defaults: dict | None = None,
                 private: tuple[str, ...] = ()) -> DataFrame:
    """A table whose files were written under several schemas, as ``schema``.

    A column that a file does not have is null there, or its value of
    ``defaults``; a narrower number is widened; columns outside ``schema`` are
    not read from any file.  ``private`` names columns that must never be read."""
    found = set(private) & set(schema.fieldNames())
    if found:
        raise ValueError(f"private columns in the schema: {sorted(found)}")
    rows = spark.read.schema(schema).parquet(path)
    fill = defaults or {}
    return rows.select(*[(F.coalesce(F.col(f.name), F.lit(fill[f.name]).cast(f.dataType)).alias(f.name)
                          if f.name in fill else F.col(f.name)) for f in schema.fields])


def stored_schemas(spark: SparkSession, path: str) -> T.StructType:
    """The union of the schemas of a table's files."""
    return spark.read.option("mergeSchema", "true").parquet(path).schema


def require_key(df: DataFrame, key_cols: list[str]) -> DataFrame:
    """``df`` itself, or ValueError where a key is null or occurs twice."""
    missing = F.lit(False)
    for c in key_cols:
        missing = missing | F.col(c).isNull()
    n = df.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("_n"))
    if not n.filter((F.col("_n") > 1) | missing).isEmpty():
        raise ValueError(f"null or repeated key {key_cols}")
    return df


def load_if_missing(spark: SparkSession, path: str, loader: Callable[[], DataFrame],
                    key_cols: list[str] | None = None) -> tuple[DataFrame, bool]:
    """Run ``loader`` and store its result only when no table exists at ``path``;
    with ``key_cols`` only if they are a key of it.

    Returns (table, loaded_now).
    """
    if table_exists(spark, path):
        return spark.read.parquet(path), False
    df = loader()
    write_table(require_key(df, key_cols) if key_cols else df, path)
    return spark.read.parquet(path), True


def full_refresh(spark: SparkSession, path: str, df: DataFrame, key_cols: list[str] | None = None,
                 dependents: tuple[str, ...] = ()) -> DataFrame:
    """Replace the table at ``path`` with ``df`` (which must not read ``path``
    itself); with ``key_cols`` only if they are a key of it.  The session views
    named in ``dependents`` were planned over the old files and are dropped."""
    write_table(require_key(df, key_cols) if key_cols else df, path, mode="overwrite")
    for view in dependents:
        spark.catalog.dropTempView(view)
    return spark.read.parquet(path)


BUCKET_COL = "_bucket"
LEAST_BUCKETS, MOST_BUCKETS = 64, 10_000
BUCKET_BYTES, FILE_BYTES = 4 << 30, 256 << 20


def bucket_layout(n_bytes: int) -> tuple[int, int]:
    """(buckets, files per bucket) for a table of about ``n_bytes``: buckets of a few GB as long as their
    number stays listable, and as many files in each as keep a write task small."""
    buckets = min(max(-(-n_bytes // BUCKET_BYTES), LEAST_BUCKETS), MOST_BUCKETS)
    return buckets, max(-(-n_bytes // (buckets * FILE_BYTES)), 1)


def bucket_of(key_cols: list[str], buckets: int):
    """Stable hash bucket of the key (same value on every executor and run)."""
    return F.pmod(F.xxhash64(*[F.col(c) for c in key_cols]), F.lit(buckets)).cast("int")


def _by_bucket(df: DataFrame, key_cols: list[str], buckets: int, files_per_bucket: int) -> DataFrame:
    """Cluster rows by (bucket, sub-bucket) before a partitioned write, so each
    bucket directory gets ``files_per_bucket`` files from as many tasks instead
    of one small file from every task."""
    sub = F.pmod(F.hash(*[F.col(c) for c in key_cols]), F.lit(files_per_bucket))
    return df.repartition(buckets * files_per_bucket, F.col(BUCKET_COL), sub)


def write_bucketed(df: DataFrame, path: str, key_cols: list[str], buckets: int,
                   files_per_bucket: int = 1) -> None:
    """Store a keyed table partitioned by hash bucket of its key.  Size
    ``buckets`` so one bucket is a few GB; raise ``files_per_bucket`` when a
    bucket should be written by several tasks."""
    out = df.withColumn(BUCKET_COL, bucket_of(key_cols, buckets))
    write_table(_by_bucket(out, key_cols, buckets, files_per_bucket), path, [BUCKET_COL])


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BUCKET_COL)


def upsert_bucketed(spark: SparkSession, path: str, updates: DataFrame, key_cols: list[str],
                    buckets: int, staging: str, files_per_bucket: int = 1, **upsert_kw) -> list[int]:
    """Apply ``updates`` to the bucketed table at ``path`` touching only the
    buckets that contain an updated key.

    1. the touched bucket ids (at most ``buckets`` integers) are listed;
    2. only those partitions are read (partition pruning) and merged with
       :func:`pulse.operators.upsert.upsert`;
    3. the merged buckets are written to ``staging`` first, because a job must
       not read and overwrite the same files;
    4. they replace the old buckets by dynamic partition overwrite; the other
       buckets are not rewritten.

    Re-running after a failure is safe: an upsert applied twice gives the same
    rows.  Returns the touched bucket ids.
    """
    touched = sorted(r[0] for r in updates.select(bucket_of(key_cols, buckets).alias("b"))
                     .distinct().collect())
    if not touched:
        return []
    old = spark.read.parquet(path).filter(F.col(BUCKET_COL).isin(touched)).drop(BUCKET_COL)
    held: list[DataFrame] = []
    merged = upsert(old, updates, key_cols, cached=held, **upsert_kw)
    staged = merged.withColumn(BUCKET_COL, bucket_of(key_cols, buckets))
    write_table(_by_bucket(staged, key_cols, buckets, files_per_bucket), staging, [BUCKET_COL])
    (spark.read.parquet(staging).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(BUCKET_COL).parquet(path))
    for df in held:
        df.unpersist()
    return touched
