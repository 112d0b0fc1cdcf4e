"""Prefix-based code crosswalk (old classification version -> new)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def prefix_score(old: Column, new: Column, max_len: int = 5) -> Column:
    """Largest k in max_len..1 with left(new, k) = left(old, k), else 0.

    Codes that agree on k characters agree on fewer, so the largest k is the
    number of lengths on which they agree.
    """
    agree = F.filter(F.sequence(F.lit(1), F.lit(max_len)),
                     lambda k: F.substring(new, F.lit(1), k) == F.substring(old, F.lit(1), k))
    return F.size(agree)


def resolve(crosswalk: DataFrame, old: str = "old_code", new: str = "new_code",
            max_len: int = 5) -> DataFrame:
    """One new code per distinct old code: best prefix score, then smallest code, NULL last.

    A hash aggregate of ``min(struct(-score, is_null, code))``: partial
    aggregation runs map-side, so an old code with millions of candidates
    never needs all of them in one task (no per-key sort, no window).
    Returns (old_code, new_code).
    """
    o, n = F.col(old), F.col(new)
    key = F.struct((-prefix_score(o, n, max_len)).alias("s"), n.isNull().alias("z"), n.alias("c"))
    return (crosswalk.select(o.alias("old_code"), key.alias("_key")).groupBy("old_code")
            .agg(F.min("_key").alias("_best"))
            .select("old_code", F.col("_best.c").alias("new_code")))


def translate(df: DataFrame, resolved: DataFrame, code: str, version: str, old_version: str,
              out: str = "activity_code_std") -> DataFrame:
    """Add ``out``: the resolved new code for rows of the old version, else the code itself.

    Rows of the old version whose code has no candidate get NULL.  The join
    is a left equi-join on the code; AQE turns it into a broadcast at runtime
    when the resolved table is small, and splits a hot code otherwise.
    """
    r = resolved.select(F.col("old_code").alias("_old"), F.col("new_code").alias("_new"))
    joined = df.join(r, (F.col(code) == r._old) & (F.col(version) == F.lit(old_version)), "left")
    return (joined.withColumn(out, F.when(F.col(version) == F.lit(old_version), F.col("_new"))
                              .otherwise(F.col(code)))
            .drop("_old", "_new"))
