"""Delimited files (classification, crosswalk): ``;`` separated, ``"`` quoted, header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulse.functions.calendar import ntz_lit
from pulse.operators.ids import dense_surrogate_id


def normalise_header(name: str) -> str:
    """lower-case, spaces -> '_', question marks dropped."""
    return name.lower().replace(" ", "_").replace("?", "")


def read_delimited(spark: SparkSession, path: str, columns: list[str], sep: str = ";",
                   quote: str = '"') -> DataFrame:
    """Read with an explicit all-string schema (codes keep leading zeros), then
    normalise the header names."""
    df = _scan(spark, path, columns, sep, quote)
    return df.toDF(*[normalise_header(c) for c in df.columns])


def read_numbered(spark: SparkSession, path: str, columns: list[str], sep: str = ";", quote: str = '"',
                  out: str = "id") -> DataFrame:
    """:func:`read_delimited` with ids 1..n in file order: by file path, place
    of the read block in the file, and row within the block (each block is
    read from start to end by one task)."""
    df = _scan(spark, path, columns, sep, quote)
    named = df.select(*[F.col(f"`{c}`").alias(normalise_header(c)) for c in columns],
                      F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                      F.monotonically_increasing_id().alias("_row"))
    return dense_surrogate_id(named, ["_file", "_block", "_row"], out=out).drop("_file", "_block", "_row")


def _scan(spark: SparkSession, path: str, columns: list[str], sep: str, quote: str) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return (spark.read.option("sep", sep).option("quote", quote).option("header", True)
            .option("enforceSchema", True).schema(schema).csv(path))


def write_delimited(df: DataFrame, path: str, header_names: list[str] | None = None,
                    sep: str = ";") -> None:
    out = df.toDF(*header_names) if header_names else df
    (out.write.mode("overwrite").option("sep", sep).option("quote", '"').option("quoteAll", True)
        .option("header", True).csv(path))


def with_load_stamp(df: DataFrame, ts) -> DataFrame:
    return df.withColumn("created_at", ntz_lit(ts))
