"""Bindings of the synthetic TPC-H-style tables onto the canonical inputs.

The engine's operators work on a company register, an activity
classification with a code crosswalk, a population fact, a county seed and a
change feed.  The test environment only ships TPC-H-style tables, so each
canonical input is *derived by Spark* from them; every query therefore grows
with the data it reads.  ``pulse.plans.oracle`` holds the same bindings as SQL
CTEs for the DuckDB cross-check.

| canonical          | derived from                                                  |
|--------------------|---------------------------------------------------------------|
| register           | orders + customer->nation (county) + lineitem (min supplier)  |
| classification     | region (roots) <- nation <- supplier, three levels            |
| crosswalk          | supplier a -> candidates a+1, a+3, a+10, a+30, a+100          |
| population         | lineitem x supplier x nation summed per year/line/flag/status |
| county seed        | nation x region                                               |
| feed / details     | events                                                        |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.domain import LEDGER_AS_OF, LOADED_AT
from pulse.functions.calendar import ntz_lit

# Candidate offsets for the code crosswalk: each old code gets a bounded
# number of successors (a linear-size relation, never all pairs of a group).
CROSSWALK_OFFSETS = (1, 3, 10, 30, 100)


# Declared schemas of the input tables: reading with an explicit schema skips
# the footer-inference job Spark otherwise runs for every scan.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                 "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                 "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
    "events": ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
               "props string"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = TABLE_SCHEMAS.get(name)
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def _s(prefix: str, c) -> F.Column:
    return F.concat(F.lit(prefix), c.cast("string"))


def register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company register staging table, one row per order.

    entity_id, legal_form, founded_on, county, status, activity_code,
    activity_name, activity_version, loaded_at
    """
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # main activity of an order = its smallest supplier; partial aggregation
    # collapses lineitem map-side before the shuffle on l_orderkey.
    main_supp = (table(spark, sf_dir, "lineitem")
                 .groupBy("l_orderkey").agg(F.min("l_suppkey").alias("main_supp")))
    county = (customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")
              .select("c_custkey", F.col("n_name").alias("county")))
    return (orders
            .join(county, orders.o_custkey == county.c_custkey, "left")
            .join(main_supp, orders.o_orderkey == main_supp.l_orderkey, "left")
            .select(
                F.col("o_orderkey").cast("string").alias("entity_id"),
                F.col("o_orderpriority").alias("legal_form"),
                F.col("o_orderdate").cast("date").alias("founded_on"),
                F.col("county"),
                F.col("o_orderstatus").alias("status"),
                _s("S", F.col("main_supp")).alias("activity_code"),
                _s("Activity S", F.col("main_supp")).alias("activity_name"),
                F.when(F.col("o_orderkey") % 3 == 0, "V1").otherwise("V2").alias("activity_version"),
                ntz_lit(LOADED_AT).alias("loaded_at"),
            ))


def classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjacency list (code, parent, label): regions are roots, nations and suppliers below."""
    region = table(spark, sf_dir, "region")
    nation = table(spark, sf_dir, "nation")
    supplier = table(spark, sf_dir, "supplier")
    return (region.select(_s("R", F.col("r_regionkey")).alias("code"),
                          F.lit(None).cast("string").alias("parent"),
                          F.col("r_name").alias("label"))
            .unionByName(nation.select(_s("N", F.col("n_nationkey")).alias("code"),
                                       _s("R", F.col("n_regionkey")).alias("parent"),
                                       F.col("n_name").alias("label")))
            .unionByName(supplier.select(_s("S", F.col("s_suppkey")).alias("code"),
                                         _s("N", F.col("s_nationkey")).alias("parent"),
                                         F.col("s_name").alias("label"))))


def crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old -> new code candidates (1:n); a candidate whose target does not exist has NULL new_code."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey")
    offsets = F.array(*[F.lit(o).cast("long") for o in CROSSWALK_OFFSETS])
    cand = (supplier.select(F.col("s_suppkey").alias("a"), F.explode(offsets).alias("off"))
            .select("a", (F.col("a") + F.col("off")).alias("b")))
    target = supplier.select(F.col("s_suppkey").alias("t"))
    return (cand.join(target, cand.b == target.t, "left")
            .select(_s("S", F.col("a")).alias("old_code"), _s("S", F.col("t")).alias("new_code")))


def population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population fact: (year, age_band, county, sex, ethnicity) -> population.

    lineitem is first reduced per (supplier, year, line, flag, status) with
    map-side partial aggregation, so a supplier holding a large share of the
    lines reaches the supplier join as a few hundred rows, not a skewed key.
    """
    per_supp = (table(spark, sf_dir, "lineitem")
                .groupBy("l_suppkey", F.year("l_shipdate").cast("int").alias("year"),
                         F.col("l_linenumber").cast("string").alias("age_band"),
                         F.col("l_returnflag").alias("sex"), F.col("l_linestatus").alias("ethnicity"))
                .agg(F.sum("l_quantity").alias("_q")))
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (per_supp.join(supplier, per_supp.l_suppkey == supplier.s_suppkey)
            .join(nation, F.col("s_nationkey") == nation.n_nationkey)
            .groupBy("year", "age_band", F.col("n_name").alias("county"), "sex", "ethnicity")
            .agg(F.sum("_q").cast("long").alias("population"))
            .withColumn("loaded_at", ntz_lit(LOADED_AT)))


def county_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """County seed (county_name, map_code, region, display_order)."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
            .select(F.replace(F.col("n_name"), F.lit("NATION_"), F.lit("")).alias("county_name"),
                    _s("C", F.col("n_nationkey")).alias("map_code"),
                    F.col("r_name").alias("region"),
                    (F.col("n_nationkey") + 1).cast("int").alias("display_order")))


def feed_rows(ev: DataFrame) -> DataFrame:
    """Project event rows (batch or streaming) onto feed entries."""
    return ev.select(
        F.col("user_id").cast("string").alias("entity_id"),
        F.col("event_type").alias("entry_type"),
        F.col("ts").alias("entry_at"),
        F.col("event_id").cast("string").alias("ruling_no"),
        # page / position of the entry in the pulled feed: one page per day
        F.to_date("ts").alias("page"),
        F.col("event_id").alias("position"),
    )


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change-feed entries: (entity_id, entry_type, entry_at, ruling_no, page, position)."""
    return feed_rows(table(spark, sf_dir, "events"))


def details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail payload per entity = its latest event (ts DESC, event_id DESC),
    absent when that event is an error.

    Reduced with ``max_by`` on a struct, a hash aggregate with map-side
    partial results, so a hot entity never lands whole in one task.
    """
    ev = table(spark, sf_dir, "events")
    latest = (ev.groupBy("user_id")
              .agg(F.max_by(F.struct("event_type", "ts", "event_id", "value"),
                            F.struct("ts", "event_id")).alias("e"))
              .select("user_id", "e.*"))
    has_activity = F.col("event_type").isin("purchase", "click")
    # a fetch whose latest event is an error returns no payload (-> retried next run)
    return latest.filter(F.col("event_type") != "error").select(
        F.col("user_id").cast("string").alias("entity_id"),
        F.col("event_type").alias("legal_form"),
        F.col("ts").cast("date").alias("founded_on"),
        F.lit(None).cast("string").alias("county"),
        F.lit("active").alias("status"),
        F.when(has_activity, _s("S", F.col("event_id") % 100)).alias("activity_code"),
        F.when(has_activity, _s("Activity S", F.col("event_id") % 100)).alias("activity_name"),
        F.when(has_activity, F.lit("V2")).alias("activity_version"),
    )


def ledger(spark: SparkSession, sf_dir: str, as_of=LEDGER_AS_OF) -> DataFrame:
    """Seen-ledger: entities with a first entry strictly before ``as_of`` (an earlier run).

    (entity_id, first_seen_at, source_entry_at, source_ruling_no), one row per entity.
    """
    ev = table(spark, sf_dir, "events").filter(
        (F.col("event_type") == "signup") & (F.col("ts") < ntz_lit(as_of)))
    first = (ev.groupBy("user_id")
             .agg(F.min_by(F.struct("ts", "event_id"), F.struct("ts", "event_id")).alias("e")))
    return first.select(
        F.col("user_id").cast("string").alias("entity_id"),
        F.col("e.ts").alias("first_seen_at"),
        F.col("e.ts").alias("source_entry_at"),
        F.col("e.event_id").cast("string").alias("source_ruling_no"),
    )
