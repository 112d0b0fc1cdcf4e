"""Schema evolution: align frames to a target schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def align_to(df: DataFrame, target: T.StructType, drop: tuple[str, ...] = ()) -> DataFrame:
    """Project ``df`` onto ``target``: add missing columns as typed NULLs, cast the
    rest, and drop everything else (``drop`` names columns that must never be
    kept, e.g. personal names, and is checked to be absent from ``target``)."""
    assert not set(drop) & set(target.fieldNames()), "privacy column in target schema"
    have = set(df.columns) - set(drop)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in target.fields])
