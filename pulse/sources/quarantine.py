"""Landed payloads that cannot be read are kept, with the reason, for a retry.

``land`` parses a text column once and stores every payload: readable ones as
their record, the others whole, with why.  Both lie in one table, in a folder
per outcome, so readers of good records never open the quarantine.  The
counters (landed, good, quarantined) are taken while the table is written, so
good + quarantined = landed holds for what is really there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulse.functions import text as txt
from pulse.sources.tables import observed_write

CORRUPT = "_corrupt_record"
MALFORMED, KEYLESS = "malformed", "without key"


def parsed(payloads: DataFrame, col: str, schema: T.StructType, key: str | None = None) -> DataFrame:
    """The payloads' columns with ``record`` (null if unreadable) and ``reason``
    (null if readable).  ``key`` is the path of a value that a readable record has."""
    marked = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"ignoreNamespace": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    # a generator, so that the parser is not copied into what uses its result
    rows = payloads.select("*", F.explode(F.array(F.from_xml(F.col(col), marked, options))).alias("_parsed"))
    return _judged(rows, F.col("_parsed"), F.col(f"_parsed.{CORRUPT}").isNotNull() | F.col("_parsed").isNull(),
                   schema, key).drop("_parsed")


def read_records(spark: SparkSession, path: str, row_tag: str, schema: T.StructType, key: str | None = None) -> DataFrame:
    """Records of XML files as (payload, record, reason); payload is the text of an unreadable record."""
    marked = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    raw = (spark.read.format("xml").option("rowTag", row_tag).option("ignoreNamespace", "true")
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).schema(marked).load(path))
    whole = raw.select(F.col(CORRUPT).alias("payload"), F.struct(*raw.columns).alias("_parsed"))
    return _judged(whole, F.col("_parsed"), F.col("payload").isNotNull(), schema, key).drop("_parsed")


def _judged(rows: DataFrame, record: Column, broken: Column, schema: T.StructType, key: str | None) -> DataFrame:
    reason = F.when(broken, F.lit(MALFORMED))
    if key:
        value = record
        for part in key.split("."):
            value = value[part]
        reason = reason.when(txt.blank_to_null(value.cast("string")).isNull(), F.lit(KEYLESS))
    kept = F.struct(*[record[f.name].alias(f.name) for f in schema.fields])
    return rows.withColumn("reason", reason).withColumn("record", F.when(F.col("reason").isNull(), kept))


def land(judged: DataFrame, path: str, payload: str) -> dict[str, int]:
    """Store judged payloads below ``path``; returns landed, good and quarantined.
    The text of readable payloads is not kept."""
    bad = F.col("reason").isNotNull()
    rows = (judged.withColumn("outcome", F.when(bad, "quarantined").otherwise("good"))
            .withColumn(payload, F.when(bad, F.col(payload))))
    return observed_write(rows, path, {"landed": F.count(F.lit(1)), "good": F.count_if(~bad),
                                       "quarantined": F.count_if(bad)}, partition_by=["outcome"])


def good_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The readable records at ``path``, one column per field."""
    whole = T.StructType([T.StructField("record", schema), T.StructField("outcome", T.StringType())])
    return spark.read.schema(whole).parquet(path).filter("outcome = 'good'").select("record.*")


def quarantined(spark: SparkSession, path: str, payload: str, also: str = "") -> DataFrame:
    """(payload, reason, columns of the DDL ``also``) of what could not be read."""
    return (spark.read.schema(f"`{payload}` string, reason string, {also + ', ' if also else ''}outcome string")
            .parquet(path).filter("outcome = 'quarantined'").drop("outcome"))
