"""The marts: composite queries over the canonical inputs.

Design for scale
----------------
The register is the only input that grows without bound (one row per
company; billions at full scale) and one activity code or county may hold a
third of it.  Every mart that counts companies therefore *aggregates the
register first* (map-side partial aggregation, then one shuffle of small
partial results) down to (bucket, county, raw code, version) and only then
translates codes through the crosswalk and attaches the classification
root.  Those joins see aggregates whose size is bounded by the number of
distinct codes x counties x buckets, not by the number of companies, so a
hot code is a single row rather than a skewed join key.  Counting before
joining is exact because ``count(id)`` over joined rows equals the sum of
per-group counts times matches.

The population fact is also aggregated before it meets anything else; the
county dimension is broadcast behind a row-count check.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulse.domain import AS_OF, BOUND, Domain
from pulse.functions import calendar as cal
from pulse.functions import labels as lab
from pulse.functions import text as txt
from pulse.operators import crosswalk as cw
from pulse.operators.hierarchy import closure_with_labels
from pulse.operators.ids import dense_surrogate_id
from pulse.operators.joins import checked_broadcast
from pulse.sources import bindings

# Dimensions fixed by the domain (counties, regions) stay far below this.
DIMENSION_ROW_BOUND = 100_000
# Code tables (classification closure, resolved crosswalk) are broadcast up to
# this many rows (~tens of MB); beyond it they join by shuffle.
CODE_TABLE_ROW_BOUND = 1_000_000


@dataclass
class Registry:
    """Canonical inputs plus evaluation parameters."""

    register: DataFrame
    classification: DataFrame
    crosswalk: DataFrame
    population: DataFrame
    county_seed: DataFrame
    domain: Domain = BOUND
    as_of: dt.date = AS_OF
    current_year: int | None = None     # defaults to year(as_of)
    aligned_buckets: bool = False       # True: bucket by the published period (see years_ago_of)
    cached: list = field(default_factory=list, repr=False)   # frames this registry persisted

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, **kw) -> "Registry":
        return cls(register=bindings.register(spark, sf_dir),
                   classification=bindings.classification(spark, sf_dir),
                   crosswalk=bindings.crosswalk(spark, sf_dir),
                   population=bindings.population(spark, sf_dir),
                   county_seed=bindings.county_seed(spark, sf_dir), **kw)

    @property
    def year(self) -> int:
        return self.current_year or self.as_of.year

    def release(self) -> None:
        """Unpersist every frame this registry cached.  Call only after all
        results that depend on them have been written or collected."""
        while self.cached:
            self.cached.pop().unpersist()

    def prepare(self, *names: str) -> "Registry":
        """Evaluate the named setup tables (closure, resolved crosswalk, county
        dimension) concurrently: each needs a few small Spark jobs (hierarchy
        levels, size probes) and they do not depend on each other, so their
        jobs overlap instead of queueing.  Already computed ones are skipped."""
        todo = [n for n in names if n not in self.__dict__]
        if len(todo) > 1:
            with ThreadPoolExecutor(len(todo)) as pool:
                list(pool.map(lambda n: getattr(self, n), todo))
        for n in todo:
            getattr(self, n)
        return self

    @cached_property
    def closure(self) -> DataFrame:
        """L2: (code, code_label, root_code, root_label)."""
        return closure_with_labels(self.classification, cached=self.cached)

    @cached_property
    def closure_side(self) -> DataFrame:
        """Closure for joins: broadcast when proven small, else a plain shuffle side."""
        side = self.closure.select("code", "root_code", "root_label").persist(StorageLevel.MEMORY_AND_DISK)
        self.cached.append(side)
        return checked_broadcast(side, CODE_TABLE_ROW_BOUND)

    @cached_property
    def resolved_crosswalk(self) -> DataFrame:
        """One new code per old code; broadcast when proven small.  Without the
        hint AQE could only switch to a broadcast after the (huge) register side
        had already been shuffled."""
        resolved = cw.resolve(self.crosswalk).persist(StorageLevel.MEMORY_AND_DISK)
        self.cached.append(resolved)
        return checked_broadcast(resolved, CODE_TABLE_ROW_BOUND)

    @cached_property
    def county_dim(self) -> DataFrame:
        """County attributes for joins (no surrogate ids needed), broadcast after a size check."""
        seed = self.county_seed.select(F.col("county_name").alias("county"), "map_code", "region")
        return checked_broadcast(seed, DIMENSION_ROW_BOUND)


# ---------------------------------------------------------------------------
# L1 / base
# ---------------------------------------------------------------------------

def years_ago_of(reg: Registry) -> F.Column:
    """Rolling-year bucket of each company.

    Default (the original rule): completed years since founding, so a company
    founded exactly n+1 years before as_of lands in bucket n+1, one day
    outside the period printed for that bucket.  ``aligned_buckets`` buckets
    by the printed period [as_of-(n+1)y, as_of-n*y-1d] instead, which is the
    age of the day after founding.
    """
    d = F.col("founded_on")
    return cal.years_ago(F.date_add(d, 1) if reg.aligned_buckets else d, reg.as_of)


def register_base(reg: Registry) -> DataFrame:
    """Register with every per-row derivation except the crosswalk lookup."""
    d = reg.domain
    r = reg.register
    return (r.select(
        "entity_id", "legal_form", lab.legal_group("legal_form", d).alias("legal_group"),
        "founded_on", years_ago_of(reg).alias("years_ago"),
        txt.strip_affix("county", d.county_strip).alias("county"),
        "status", "activity_code", "activity_version", "loaded_at")
        .withColumn("period_start", cal.period_start("years_ago", reg.as_of))
        .withColumn("period_end", cal.period_end("years_ago", reg.as_of))
        .withColumn("rolling_year", cal.rolling_year("years_ago", reg.as_of))
        .withColumn("in_last_6", cal.in_last("years_ago", 6)))


REGISTER_STD_COLUMNS = ["entity_id", "legal_form", "legal_group", "founded_on", "years_ago",
                        "period_start", "period_end", "rolling_year", "county", "status",
                        "activity_code", "activity_code_std", "in_last_6", "loaded_at"]


def register_std(reg: Registry) -> DataFrame:
    """L1: standardised register, one row per company."""
    reg.prepare("resolved_crosswalk")
    base = register_base(reg)
    out = cw.translate(base, reg.resolved_crosswalk, "activity_code", "activity_version",
                       reg.domain.old_code_version)
    return out.select(*REGISTER_STD_COLUMNS)


def _counted(df: DataFrame, keys: list[str], reg: Registry, translate: bool = True) -> DataFrame:
    """count(entity_id) per keys + raw code (+ version), then crosswalk on the aggregate."""
    extra = ["activity_code", "activity_version"] if translate else ["activity_code"]
    agg = df.groupBy(*keys, *extra).agg(F.count("entity_id").alias("_n"))
    if translate:
        agg = cw.translate(agg, reg.resolved_crosswalk, "activity_code", "activity_version",
                           reg.domain.old_code_version)
    return agg


def _with_root(agg: DataFrame, reg: Registry, code_col: str, how: str) -> DataFrame:
    c = reg.closure_side
    return agg.join(c, agg[code_col] == c.code, how)


def _sector(reg: Registry) -> F.Column:
    d = reg.domain
    return lab.sector_label("root_code", "root_label", d.label_width, d.unassigned_label)


# ---------------------------------------------------------------------------
# Dimensions
# ---------------------------------------------------------------------------

def county_dimension(reg: Registry) -> DataFrame:
    """L3: county_id (by display order), county, map_code, region, display_order."""
    seed = reg.county_seed
    out = dense_surrogate_id(seed, ["display_order"], out="county_id")
    return out.select("county_id", F.col("county_name").alias("county"), "map_code", "region",
                      "display_order")


def population_clean(reg: Registry) -> DataFrame:
    """L4: county rows only, overlapping bands and totals removed, bands grouped."""
    d = reg.domain
    p = reg.population
    keep = (txt.affix_match("county", d.county_filter_affix, d.county_filter_at)
            & ~F.col("age_band").isin(list(d.excluded_bands))
            & (F.col("sex") == d.sex_total) & (F.col("ethnicity") == d.ethnicity_total))
    return p.filter(keep).select(
        F.col("year").cast("int").alias("year"), lab.age_group("age_band", d).alias("age_group"),
        txt.strip_affix("county", d.county_strip).alias("county"),
        F.col("population").cast("long").alias("population"), "loaded_at")


# ---------------------------------------------------------------------------
# Counts and marts
# ---------------------------------------------------------------------------

def entity_counts(reg: Registry, last_years: int | None = None) -> DataFrame:
    """Companies (not in the 'other' legal group) per rolling year, county, sector, flag.

    ``last_years`` reads only companies that can be in the last so many
    rolling years; rows of older years are then incomplete or missing.
    """
    reg.prepare("closure_side", "resolved_crosswalk")
    other = reg.domain.legal_group_labels[2]
    base = register_base(reg).filter(F.col("legal_group") != other)
    if last_years is not None:
        base = base.filter(cal.may_be_in_last("founded_on", reg.as_of, last_years))
    keys = ["rolling_year", "county", "in_last_6"]
    agg = _with_root(_counted(base, keys, reg), reg, "activity_code_std", "left")
    return (agg.groupBy(*keys, "root_code", "root_label").agg(F.sum("_n").alias("entity_count"))
            .select("rolling_year", "county", _sector(reg).alias("sector_label"), "in_last_6",
                    F.col("entity_count").cast("long").alias("entity_count")))


def trend_by_region(reg: Registry, counts: DataFrame | None = None) -> DataFrame:
    """Counts per year, county, region, sector and flag."""
    reg.prepare("county_dim", *(() if counts is not None else ("closure_side", "resolved_crosswalk")))
    ec = counts if counts is not None else entity_counts(reg)
    dim = reg.county_dim.select(F.col("county").alias("_c"), "region")
    j = ec.join(dim, ec.county == dim._c, "left")
    return (j.groupBy(F.col("rolling_year").alias("year"), "county", "region", "sector_label",
                      "in_last_6")
            .agg(F.sum("entity_count").cast("long").alias("entity_count"))
            .select("year", "county", "region", "entity_count", "sector_label", "in_last_6"))


def portfolio_shift(reg: Registry, counts: DataFrame | None = None, full: bool = False) -> DataFrame:
    """Sector shares of the current rolling year vs all earlier years, per county.

    One pass with conditional sums instead of two scans and a join.  By
    default (the original rule) only (county, sector) pairs present in the
    current year are kept and the earlier-share denominator counts only
    those pairs.  ``full`` keeps sectors seen in either period and divides
    by the whole county total of each period.
    """
    y = reg.year
    ec = (counts if counts is not None else entity_counts(reg)).filter(F.col("sector_label").isNotNull())
    agg = (ec.groupBy("county", "sector_label")
           .agg(F.sum(F.when(F.col("rolling_year") == y, F.col("entity_count"))).alias("cur"),
                F.sum(F.when(F.col("rolling_year") < y, F.col("entity_count"))).alias("prev")))
    agg = (agg.filter(F.col("cur").isNotNull() | F.col("prev").isNotNull()) if full
           else agg.filter(F.col("cur").isNotNull()))
    w = Window.partitionBy("county")
    return agg.select(
        "county", "sector_label",
        F.col("cur").cast("long").alias("entity_count_current"),
        F.col("prev").cast("long").alias("entity_count_earlier"),
        lab.half_up_ratio("cur", F.sum("cur").over(w), 100).alias("share_current"),
        lab.half_up_ratio("prev", F.sum("prev").over(w), 100).alias("share_earlier"))


def rate_per_1000(reg: Registry, counts: DataFrame | None = None) -> DataFrame:
    """L8 (flagship): new companies per 1,000 working-age residents by year, county, sector."""
    reg.prepare("county_dim", *(() if counts is not None else ("closure_side", "resolved_crosswalk")))
    working = reg.domain.age_group_labels[1]
    pop = (population_clean(reg)
           .filter((F.col("age_group") == working) & (F.col("year") >= reg.year - 5))
           .groupBy("year", "county").agg(F.sum("population").cast("long").alias("working_age_pop")))
    ents = ((counts if counts is not None else entity_counts(reg, last_years=6)).filter(F.col("in_last_6") == 1)
            .select(F.col("rolling_year").alias("_y"), F.col("county").alias("_c"),
                    "entity_count", "sector_label"))
    dim = reg.county_dim.select(F.col("county").alias("_dc"), "region")
    j = (pop.join(ents, (pop.county == ents._c) & (pop.year == ents._y), "left")
            .join(dim, pop.county == dim._dc))
    n = F.coalesce(F.col("entity_count"), F.lit(0)).cast("long")
    return j.select("year", "county", "working_age_pop", n.alias("entity_count"),
                    lab.half_up_ratio(n, "working_age_pop", 1000).alias("per_1000"),
                    "region", "sector_label")


def rate_geo(reg: Registry, rate: DataFrame | None = None) -> DataFrame:
    """Rate mart plus the county map code."""
    r = rate if rate is not None else rate_per_1000(reg)
    dim = reg.county_dim.select(F.col("county").alias("_dc"), "map_code")
    return (r.join(dim, r.county == dim._dc, "left")
            .select("year", "county", "region", "working_age_pop", "entity_count", "per_1000",
                    "sector_label", "map_code"))


def new_by_activity(reg: Registry, rolling_year: int | None = None) -> DataFrame:
    """Companies of one rolling year by legal group, county and sector (unmatched codes dropped)."""
    reg.prepare("closure_side", "resolved_crosswalk")
    y = rolling_year if rolling_year is not None else reg.year
    base = register_base(reg).filter(cal.may_be_in_rolling_year("founded_on", reg.as_of, y)
                                     & (F.col("rolling_year") == y))
    keys = ["legal_group", "county"]
    agg = _with_root(_counted(base, keys, reg), reg, "activity_code_std", "inner")
    return (agg.groupBy(*keys, "root_code", "root_label").agg(F.sum("_n").alias("entity_count"))
            .select(*keys, "root_code", "root_label", _sector(reg).alias("sector_label"),
                    F.col("entity_count").cast("long").alias("entity_count")))


def _recent(reg: Registry, days: int) -> DataFrame:
    d = reg.domain
    forms = list(d.business_forms) + list(d.sole_trader_forms)
    return register_base(reg).filter(cal.on_or_after_days("founded_on", reg.as_of, days)
                                     & F.col("legal_form").isin(forms))


def recent_30d(reg: Registry, days: int = 30) -> DataFrame:
    """Companies founded in the last ``days`` days (business + sole trader forms)
    by county and sector, joined on the *raw* activity code."""
    agg = _with_root(_counted(_recent(reg, days), ["county"], reg, translate=False), reg, "activity_code", "left")
    return (agg.groupBy("county", "root_code", "root_label").agg(F.sum("_n").alias("entity_count"))
            .select("county", F.col("entity_count").cast("long").alias("entity_count"),
                    _sector(reg).alias("sector_label")))


def top_sectors(reg: Registry, k: int = 10, days: int = 30) -> DataFrame:
    """The k most popular sectors over the last ``days`` days (ties by label)."""
    per = (recent_30d(reg, days).groupBy("sector_label")
           .agg(F.sum("entity_count").cast("long").alias("entity_count")))
    top = per.orderBy(F.desc("entity_count"), F.asc("sector_label")).limit(k)
    w = Window.orderBy(F.desc("entity_count"), F.asc("sector_label"))
    return top.select(F.row_number().over(w).cast("int").alias("rank"), "sector_label",
                      "entity_count")


def kpi_recent_total(reg: Registry, days: int = 30) -> DataFrame:
    """Number of companies founded in the last ``days`` days (one row).

    The sum over recent_30d without its classification join: every code has
    at most one root, so the left join neither adds nor drops companies.
    """
    return _recent(reg, days).agg(F.count("entity_id").cast("long").alias("recent_total"))


def kpi_data_freshness(reg: Registry) -> DataFrame:
    """Latest founding date and latest load stamp present in the register (one row)."""
    return reg.register.agg(F.max("founded_on").alias("latest_founded_on"),
                            F.max("loaded_at").alias("latest_loaded_at"))


def mart_filtered(mart: DataFrame, county=None, sector=None, year=None,
                  county_col="county", sector_col="sector_label", year_col="year") -> DataFrame:
    """User filters on a mart; plain predicates that Catalyst pushes toward the scans."""
    out = mart
    if county is not None:
        out = out.filter(F.col(county_col).isin(list(county)))
    if sector is not None:
        out = out.filter(F.col(sector_col).isin(list(sector)))
    if year is not None:
        out = out.filter(F.col(year_col).isin(list(year)))
    return out
