"""Shared pieces of the training-data operators."""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.operators import bloom
from pulse.session import shared_dir

#: A word is a run of characters other than space, tab, \n, \v, \f and \r.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def ship(module: str) -> None:
    """Send the named module's functions to the workers by value: executors
    need not have this package on their path."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often body uses it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Words of a text in order; null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACE_RUN, -1))


def positions(n: Column) -> Column:
    """0 .. n-1, empty for n <= 0."""
    return F.when(n > 0, F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(
        F.array().cast("array<int>"))


def save(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage ends there,
    and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = shared_dir(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of a filter that names the rows which must be moved.
FILTER_BYTES = 256 << 20


def whole_rows(df: DataFrame, **named: Column) -> DataFrame:
    """The rows as one struct ``row`` beside the named columns, whatever the input's columns are called."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[c.alias(n) for n, c in named.items()])


def split_listed(rows: DataFrame, listed: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows that may have a key of ``listed``, rows that have none).

    A Bloom filter of the listed keys (stored; ten bits a key, ``FILTER_BYTES``
    at most) decides without moving any row, so an exact join that follows
    shuffles the first part only."""
    known = bloom.key_filter(listed.select(*keys), keys, listed.count(), FILTER_BYTES)
    found = bloom.may_hold(known, keys)
    return rows.join(F.broadcast(known.rows), found, "left_semi"), rows.join(F.broadcast(known.rows), found, "left_anti")


def spread_join(rows: DataFrame, groups: DataFrame, on: Column, how: str = "inner", salts: int = 32) -> DataFrame:
    """Join rows (alias r) to one row per group (alias g) on ``on`` so that a
    group that holds a third of the rows is still met in ``salts`` tasks if the
    groups are too many for a broadcast.  The result has ``r.*`` and ``g.*``."""
    dealt = rows.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    copies = groups.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.alias("r").join(copies.alias("g"), on & (F.col("r._salt") == F.col("g._copy")), how)
