"""Daily mart build: every mart written as a table, shared work computed once.

The original rebuilt the standardised register inside every mart (six
expansions per run).  Here the entity counts are computed once and stored;
trend, portfolio and rate marts read the stored counts, and the map mart
reads the finished rate mart.  Each table goes to ``out_dir/<name>``
(Parquet, overwrite), so a rerun replaces the previous build.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulse.plans import marts as M
from pulse.sources.tables import write_clustered, write_table


#: Marts read with filters: the column they are foldered by, then those they are sorted by.
STORED_BY = {"trend_by_region": ("year", "county", "sector_label"), "rate_per_1000": ("year", "county", "sector_label"),
             "rate_geo": ("year", "county", "sector_label"), "entity_counts": ("rolling_year", "county", "sector_label")}


def read_mart(spark: SparkSession, path: str, schema=None, **wanted) -> DataFrame:
    """A stored mart, limited by column=value or column=[values]: the year picks
    folders, county and sector skip row groups of the files in them."""
    rows = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    return M.mart_filtered(rows, **wanted)


def create_views(reg: M.Registry) -> list[str]:
    """The intermediate layer as session views for SQL users; each is computed
    when it is queried, nothing is stored.  Returns the view names."""
    views = {"register_std": M.register_std(reg), "hierarchy_closure": reg.closure,
             "population_clean": M.population_clean(reg), "entity_counts": M.entity_counts(reg)}
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)


def build_marts(reg: M.Registry, out_dir: str, release: bool = True) -> dict[str, str]:
    spark = reg.register.sparkSession
    base = out_dir.rstrip("/")
    paths: dict[str, str] = {}

    def put(name: str, df: DataFrame) -> DataFrame:
        path = f"{base}/{name}"
        year, *rest = STORED_BY.get(name, (None,))
        if year:
            write_clustered(df, path, [year], rest)
        else:
            write_table(df, path)
        paths[name] = path
        return spark.read.schema(df.schema).parquet(path)

    put("county_dimension", M.county_dimension(reg))
    put("hierarchy_closure", reg.closure)
    put("population_clean", M.population_clean(reg))
    counts = put("entity_counts", M.entity_counts(reg))
    put("trend_by_region", M.trend_by_region(reg, counts))
    put("portfolio_shift", M.portfolio_shift(reg, counts))
    rate = put("rate_per_1000", M.rate_per_1000(reg, counts))
    put("rate_geo", M.rate_geo(reg, rate))
    put("new_by_activity", M.new_by_activity(reg))
    put("recent_30d", M.recent_30d(reg))
    if release:
        reg.release()       # everything is written; the cached setup tables can go
    return paths
