"""Lenient text -> date / timestamp parsing and the main-activity fold."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulse.functions.text import blank_to_null, truthy

# Fixed formats of the register payloads: day.month.year or ISO, one- or two-digit fields.
DATE_FORMATS = ("d.M.yyyy", "yyyy-M-d")
TIMESTAMP_FORMATS = ("d.M.yyyy H:m:s", "d.M.yyyy", "yyyy-M-d'T'H:m:s", "yyyy-M-d")


def _clean(x, strip_z: bool) -> Column:
    s = F.trim(F.col(x) if isinstance(x, str) else x)
    return F.replace(s, F.lit("Z"), F.lit("")) if strip_z else s


def multi_format_date(x, formats=DATE_FORMATS, strip_z: bool = True) -> Column:
    """First format that parses wins; unparsable text gives NULL (never an error)."""
    s = _clean(x, strip_z)
    return F.coalesce(*[F.try_to_date(s, f) for f in formats])


def multi_format_timestamp(x, formats=TIMESTAMP_FORMATS, strip_z: bool = True) -> Column:
    """Timestamp variant (wall-clock, no zone); NULL when nothing parses."""
    s = _clean(x, strip_z)
    return F.coalesce(*[F.try_to_timestamp(s, F.lit(f)) for f in formats]).cast("timestamp_ntz")


ACTIVITY_TYPE = T.StructType([
    T.StructField("code", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("version", T.StringType()), T.StructField("main", T.BooleanType())])


def activity_items(items: Column, code="code", name="name", version_text="version_text",
                   version="version", is_main="is_main", tokens=("true", "jah", "1")) -> Column:
    """Normalise raw activity items: blank -> NULL, version text preferred, truthy main flag."""
    return F.transform(items, lambda x: F.struct(
        blank_to_null(x[code]).alias("code"), blank_to_null(x[name]).alias("name"),
        F.coalesce(blank_to_null(x[version_text]), blank_to_null(x[version])).alias("version"),
        truthy(x[is_main], tokens).alias("main")))


def main_activity(items: Column) -> Column:
    """Fold over items in document order: an item replaces the pick when it is flagged
    main, or when no pick with a code exists yet.

    Net effect: the last flagged item (a flagged item without a code is still
    replaced by the next one), else the first item with a code, else the last
    item.  Evaluated per row inside whole-stage codegen (no Python).
    """
    init = F.lit(None).cast(ACTIVITY_TYPE)
    return F.aggregate(items, init, lambda acc, x: F.when(
        x["main"] | acc.isNull() | acc["code"].isNull(), x).otherwise(acc))
