"""Readers for the live source files, mapped onto the canonical inputs.

The live deployment lands a classification file and an old->new code
crosswalk as ';'-separated CSV, a county seed as ','-separated CSV, and the
population as a statistics cube whose dimensions carry their own ids.  These
readers apply the loader rules (explicit string schema, header normalising,
surrogate ids, load stamp) and rename the native columns to the canonical
ones the marts use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.functions.calendar import ntz_lit
from pulse.sources import cube, delimited

# --- fixed values: native column / dimension names of the live files -------
# classification file: code, parent code, activity text (after header normalising)
CLASSIFICATION_COLUMNS = {"kood": "code", "vanem": "parent", "tegevusala_tekst": "label"}
# crosswalk file: code in the old version, code in the new version
CROSSWALK_COLUMNS = {"kood_emtak_2008": "old_code", "kood_emtak_2025": "new_code"}
# county seed: county name, map code, region, display order
SEED_COLUMNS = {"maakond_nimi": "county_name", "iso_kood": "map_code", "regioon": "region",
                "kuvajarjestus": "display_order"}
# population cube dimensions: year, age band, county, sex, ethnicity
CUBE_DIMENSIONS = {"Aasta": "year", "Vanuserühm": "age_band", "Maakond": "county", "Sugu": "sex",
                   "Rahvus": "ethnicity"}
# --- end of fixed values -----------------------------------------------------


def _mapped(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    missing = [c for c in mapping if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")
    return df.select(*[F.col(src).alias(dst) for src, dst in mapping.items()])


def read_classification(spark: SparkSession, path: str, header: list[str], loaded_at) -> DataFrame:
    """(id, code, parent, label, created_at) from the ';' classification file, ids in file order.
    ``header`` lists the raw header names in file order (read as strings)."""
    raw = delimited.read_numbered(spark, path, header)
    return (_mapped(raw, {"id": "id", **CLASSIFICATION_COLUMNS})
            .withColumn("parent", F.nullif(F.trim("parent"), F.lit("")))
            .withColumn("created_at", ntz_lit(loaded_at)))


def read_crosswalk(spark: SparkSession, path: str, header: list[str], loaded_at=None) -> DataFrame:
    """(old_code, new_code) from the ';' crosswalk file, codes kept as text;
    with ``loaded_at`` also id (in file order) and created_at, as it is staged."""
    if loaded_at is None:
        return _mapped(delimited.read_delimited(spark, path, header), CROSSWALK_COLUMNS)
    return (_mapped(delimited.read_numbered(spark, path, header), {"id": "id", **CROSSWALK_COLUMNS})
            .withColumn("created_at", ntz_lit(loaded_at)))


def read_county_seed(spark: SparkSession, path: str) -> DataFrame:
    """(county_name, map_code, region, display_order) from the ',' seed file."""
    raw = (spark.read.option("header", True)
           .schema("maakond_nimi string, iso_kood string, regioon string, kuvajarjestus int").csv(path))
    return _mapped(raw, SEED_COLUMNS)


def read_population_cubes(spark: SparkSession, path: str, loaded_at, multi_line: bool = True) -> DataFrame:
    """Population rows (year, age_band, county, sex, ethnicity, population, loaded_at) from cube files."""
    flat = cube.flatten_cubes(cube.read_cubes(spark, path, multi_line), list(CUBE_DIMENSIONS),
                              value_name="population", int_dims=("Aasta",))
    return (flat.select(*[F.col(src).alias(dst) for src, dst in CUBE_DIMENSIONS.items()],
                        F.col("population").cast("long").alias("population"))
            .withColumn("loaded_at", ntz_lit(loaded_at)))
