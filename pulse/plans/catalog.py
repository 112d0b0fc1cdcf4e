"""Registered queries: key -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.domain import BOUND, FEED_AS_OF, LOADED_AT
from pulse.functions import parse as P
from pulse.functions.parse import multi_format_date
from pulse.functions.text import address_tail
from pulse.operators import hierarchy as H
from pulse.operators import upsert as U
from pulse.operators.ids import dense_surrogate_id
from pulse.operators.normalise import normalise_register_fields
from pulse.operators.quality import Check, failing_frame, summary
from pulse.operators.schema import align_to
from pulse.plans import incremental as I
from pulse.plans import marts as M
from pulse.plans.build import STORED_BY, build_marts, create_views, read_mart
from pulse.plans.checks import declared_checks, failures_frame, kind_summary, publish_checked, registry_tables
from pulse.plans.daily import run_all
from pulse.plans.incremental import ACTIVITY_COLUMNS
from pulse.session import shared_dir
from pulse.sources import bindings, cube, feed, live, payloads, quarantine, register_xml, tables
from pulse.sources import delimited as DL
from pulse.sources.keyed import KeyedTable
from pulse.streaming import first_seen as S
from pulse.streaming import state as ST

Query = Callable[[SparkSession, str], DataFrame]


def _mart(fn, **kw) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(M.Registry.from_testdata(spark, sf_dir), **kw)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def _closure(spark, sf_dir):
    return M.Registry.from_testdata(spark, sf_dir).closure


def _crosswalk(spark, sf_dir):
    return M.Registry.from_testdata(spark, sf_dir).resolved_crosswalk


def _mart_build(spark, sf_dir):
    """A13 + A14: all marts built in one run (shared counts), written as tables;
    returns the row count of each stored mart."""
    paths = build_marts(M.Registry.from_testdata(spark, sf_dir), shared_dir(spark, "marts"))
    out = None
    for name, path in paths.items():
        part = spark.read.parquet(path).agg(F.count(F.lit(1)).cast("long").alias("row_count")) \
            .select(F.lit(name).alias("mart"), "row_count")
        out = part if out is None else out.unionByName(part)
    return out


def _mart_filtered(spark, sf_dir):
    reg = M.Registry.from_testdata(spark, sf_dir)
    return M.mart_filtered(M.rate_per_1000(reg), county=["1", "7", "13", "24"], year=[1996, 1999])


def _mart_stored_filtered(spark, sf_dir):
    """A16 on a stored mart: foldered by year, sorted by county, read with both filters."""
    mart = M.rate_per_1000(M.Registry.from_testdata(spark, sf_dir))
    path = f"{shared_dir(spark, 'stored-mart')}/rate_per_1000"
    year, *rest = STORED_BY["rate_per_1000"]
    tables.write_clustered(mart, path, [year], rest)
    return read_mart(spark, path, mart.schema, county=["1", "7", "13", "24"], year=[1996, 1999]).select(mart.columns)


#: Columns of the stored marts that mart_build_rows compares.
MART_ROWS = {"trend_by_region": ("year", "county", "region", "sector_label", "entity_count"),
             "rate_per_1000": ("year", "county", "region", "sector_label", "entity_count"),
             "rate_geo": ("year", "county", "map_code", "sector_label", "entity_count"),
             "portfolio_shift": (None, "county", None, "sector_label", "entity_count_current"),
             "new_by_activity": (None, "county", "legal_group", "sector_label", "entity_count"),
             "recent_30d": (None, "county", None, "sector_label", "entity_count")}


def _stored_rows(spark, paths):
    out = None
    for mart, (year, county, extra, sector, n) in MART_ROWS.items():
        part = spark.read.parquet(paths[mart]).select(
            F.lit(mart).alias("mart"), (F.col(year) if year else F.lit(None)).cast("int").alias("year"),
            F.col(county).alias("county"), (F.col(extra) if extra else F.lit(None)).cast("string").alias("extra"),
            F.col(sector).alias("sector_label"), F.col(n).cast("long").alias("entity_count"))
        out = part if out is None else out.unionByName(part)
    return out


def _mart_build_rows(spark, sf_dir):
    """The rows of the stored marts."""
    return _stored_rows(spark, build_marts(M.Registry.from_testdata(spark, sf_dir), shared_dir(spark, "marts")))


def _daily_run(spark, sf_dir):
    """The whole daily run (increment, marts, checks); returns the rows of the marts it stored,
    which are built from the register after the increment."""
    paths = run_all(M.Registry.from_testdata(spark, sf_dir), bindings.ledger(spark, sf_dir), bindings.feed(spark, sf_dir),
                    bindings.details(spark, sf_dir), shared_dir(spark, "daily"), FEED_AS_OF)
    return _stored_rows(spark, paths)


def _hierarchy_doubling(spark, sf_dir):
    """I1 + I2 by pointer doubling."""
    return H.closure_with_labels(bindings.classification(spark, sf_dir), closure=H.doubled_closure)


def _intermediate_views(spark, sf_dir):
    """The intermediate layer as views, queried with SQL."""
    create_views(M.Registry.from_testdata(spark, sf_dir))
    return spark.sql("""
        SELECT s.legal_group, s.in_last_6, c.root_code, count(*) AS companies
        FROM register_std s LEFT JOIN hierarchy_closure c ON c.code = s.activity_code_std
        GROUP BY s.legal_group, s.in_last_6, c.root_code""")


MART_QUERIES: dict[str, Query] = {
    "rate_per_1000": _mart(M.rate_per_1000),
    "register_std": _mart(M.register_std),
    "hierarchy_closure": _closure,
    "crosswalk_resolve": _crosswalk,
    "county_dimension": _mart(M.county_dimension),
    "population_clean": _mart(M.population_clean),
    "entity_counts": _mart(M.entity_counts),
    "trend_by_region": _mart(M.trend_by_region),
    "portfolio_shift": _mart(M.portfolio_shift),
    "rate_geo": _mart(M.rate_geo),
    "new_by_activity": _mart(M.new_by_activity),
    "recent_30d": _mart(M.recent_30d),
    "top_sectors": _mart(M.top_sectors),
    "kpi_recent_total": _mart(M.kpi_recent_total),
    "kpi_data_freshness": _mart(M.kpi_data_freshness),
    "mart_filtered": _mart_filtered,
    "mart_build": _mart_build,
    "intermediate_views": _intermediate_views,
    "mart_stored_filtered": _mart_stored_filtered,
    "mart_build_rows": _mart_build_rows,
    "daily_run": _daily_run,
    "hierarchy_doubling": _hierarchy_doubling,
}


# ---------------------------------------------------------------------------
# Change capture
# ---------------------------------------------------------------------------

def _feed_first_entries(spark, sf_dir):
    """A7 + C6: parse feed pages (XML), one row per first-registration entry."""
    return feed.first_entries_from_pages(payloads.feed_pages(spark, sf_dir),
                                         BOUND.first_entry_type).select(
        "entity_id", "entry_at", "ruling_no")


def _feed_xml_scan(spark, sf_dir):
    """A7 with the XML file source: landed feed pages scanned with rowTag, first entries kept."""
    path = shared_dir(spark, "feed-pages")
    payloads.write_feed_pages(spark, sf_dir, path)
    return (feed.read_feed_pages(spark, path).filter(F.col("entry_type") == BOUND.first_entry_type)
            .select("entity_id", "entry_at", "ruling_no"))


def _first_occurrence_dedup(spark, sf_dir):
    return I.discovered(bindings.feed(spark, sf_dir), BOUND.first_entry_type)


def _unseen_anti_join(spark, sf_dir):
    return _incremental_run(spark, sf_dir).unseen


def _insert_if_absent(spark, sf_dir):
    disc = I.discovered(bindings.feed(spark, sf_dir), BOUND.first_entry_type)
    return U.insert_if_absent(bindings.ledger(spark, sf_dir), I.ledger_rows(disc, FEED_AS_OF))


def _daily_window_slice(spark, sf_dir):
    return I.daily_slice(bindings.feed(spark, sf_dir), FEED_AS_OF)


def _enrich_or_retry(spark, sf_dir):
    r = _incremental_run(spark, sf_dir)
    return (r.loaded_details.select("entity_id", F.lit("loaded").alias("outcome"))
            .unionByName(r.failed.select("entity_id", F.lit("failed").alias("outcome"))))


def _incremental_run_metrics(spark, sf_dir):
    return _incremental_run(spark, sf_dir).metrics()


def _incremental_metrics_observed(spark, sf_dir):
    """The counters of a run whose steps are written tables, taken as they are written."""
    _, counters = I.run_observed(bindings.register(spark, sf_dir), bindings.ledger(spark, sf_dir),
                                 bindings.feed(spark, sf_dir), bindings.details(spark, sf_dir),
                                 shared_dir(spark, "observed-run"), FEED_AS_OF)
    return I.counters_frame(spark, counters)


def _upsert_bloom(spark, sf_dir):
    """C2 beyond the broadcast bound: a Bloom filter of the increment's keys before the shuffle."""
    upd = normalise_register_fields(bindings.details(spark, sf_dir), BOUND, trim=False)
    return U.upsert_stored(bindings.register(spark, sf_dir), upd, "entity_id", preserve=ACTIVITY_COLUMNS,
                           run_ts=FEED_AS_OF, broadcast_bytes=0)


def _incremental_register(spark, sf_dir):
    return _incremental_run(spark, sf_dir).register


def _incremental_ledger(spark, sf_dir):
    return _incremental_run(spark, sf_dir).ledger


def _normalise_fields(spark, sf_dir):
    return normalise_register_fields(bindings.details(spark, sf_dir), BOUND, trim=True)


def _upsert(preserve: bool):
    def q(spark, sf_dir):
        upd = normalise_register_fields(bindings.details(spark, sf_dir), BOUND, trim=not preserve)
        return U.upsert(bindings.register(spark, sf_dir), upd, "entity_id",
                        preserve=ACTIVITY_COLUMNS if preserve else (), stamp_col="loaded_at",
                        run_ts=FEED_AS_OF)
    q.__name__ = "upsert_preserve" if preserve else "upsert_replace"
    return q


def _upsert_bucketed(spark, sf_dir):
    """C2 as a keyed write: register stored in hash buckets; the increment rewrites only the
    buckets it touches."""
    path, staging = shared_dir(spark, "register-bucketed"), shared_dir(spark, "register-staging")
    # the register has a row per order, with columns of its customer
    size = tables.stored_bytes(spark, f"{sf_dir}/orders.parquet", f"{sf_dir}/customer.parquet")
    buckets, files = tables.bucket_layout(size)
    tables.write_bucketed(bindings.register(spark, sf_dir), path, ["entity_id"], buckets, files)
    upd = normalise_register_fields(bindings.details(spark, sf_dir), BOUND, trim=False)
    tables.upsert_bucketed(spark, path, upd, ["entity_id"], buckets, staging, files,
                           preserve=ACTIVITY_COLUMNS, stamp_col="loaded_at", run_ts=FEED_AS_OF)
    return tables.read_bucketed(spark, path)


def _upsert_recorded_layout(spark, sf_dir):
    """C2 as a keyed write whose table remembers its layout: half of the register is stored, the
    other half inserted, the table dealt anew, and the increment applied to the buckets it touches."""
    path = shared_dir(spark, "register-keyed")
    reg = bindings.register(spark, sf_dir)
    half = F.pmod(F.xxhash64("entity_id"), F.lit(2)) == 0
    table = KeyedTable.create(reg.filter(half), path, ["entity_id"],
                              size_hint=tables.stored_bytes(spark, f"{sf_dir}/orders.parquet"))
    table.insert_if_absent(reg.filter(~half))
    table.rebucket(2 * table.manifest.buckets)
    upd = normalise_register_fields(bindings.details(spark, sf_dir), BOUND, trim=False)
    KeyedTable.open(spark, path, ["entity_id"]).upsert(upd, preserve=ACTIVITY_COLUMNS, run_ts=FEED_AS_OF)
    return KeyedTable.open(spark, path).read()


def _incremental_run(spark, sf_dir):
    return I.from_testdata(spark, sf_dir)


CHANGE_QUERIES: dict[str, Query] = {
    "feed_first_entries": _feed_first_entries,
    "feed_xml_scan": _feed_xml_scan,
    "first_occurrence_dedup": _first_occurrence_dedup,
    "unseen_anti_join": _unseen_anti_join,
    "insert_if_absent": _insert_if_absent,
    "daily_window_slice": _daily_window_slice,
    "enrich_or_retry": _enrich_or_retry,
    "incremental_run_metrics": _incremental_run_metrics,
    "incremental_metrics_observed": _incremental_metrics_observed,
    "incremental_register": _incremental_register,
    "incremental_ledger": _incremental_ledger,
    "normalise_fields": _normalise_fields,
    "upsert_replace": _upsert(False),
    "upsert_preserve": _upsert(True),
    "upsert_bloom": _upsert_bloom,
    "upsert_bucketed": _upsert_bucketed,
    "upsert_recorded_layout": _upsert_recorded_layout,
}


# ---------------------------------------------------------------------------
# Raw sources and ingest normalisation
# ---------------------------------------------------------------------------

def _register_xml_parse(spark, sf_dir):
    return register_xml.parse_register_payloads(payloads.register_dump(spark, sf_dir),
                                                 run_ts=LOADED_AT)


def _register_xml_scan(spark, sf_dir):
    """A1 with the XML file source: the dump lands as files, scanned with rowTag + explicit schema."""
    path = shared_dir(spark, "register-dump")
    payloads.write_register_dump(spark, sf_dir, path)
    return register_xml.read_register_xml(spark, path, run_ts=LOADED_AT)


def _order_activities(spark, sf_dir):
    lines = (bindings.table(spark, sf_dir, "lineitem")
             .groupBy("l_orderkey")
             .agg(F.array_sort(F.collect_list(F.struct(
                 "l_linenumber", "l_suppkey", "l_partkey", "l_returnflag"))).alias("lines")))
    items = F.transform("lines", lambda x: F.struct(
        F.concat(F.lit("S"), x["l_suppkey"].cast("string")).alias("code"),
        F.concat(F.lit("Activity S"), x["l_suppkey"].cast("string")).alias("name"),
        F.lit(None).cast("string").alias("version_text"),
        F.concat(F.lit("V"), x["l_linenumber"].cast("string")).alias("version"),
        F.when(x["l_returnflag"] == "R", "jah").otherwise("ei").alias("is_main")))
    return lines.select(F.col("l_orderkey").cast("string").alias("entity_id"),
                        P.main_activity(P.activity_items(items)).alias("a"))


def _main_activity_pick(spark, sf_dir):
    """B1 + B9: main activity per order from its ordered line items."""
    a = _order_activities(spark, sf_dir)
    return a.select("entity_id", F.col("a.code").alias("activity_code"),
                    F.col("a.name").alias("activity_name"),
                    F.col("a.version").alias("activity_version"))


def _address_tail(spark, sf_dir):
    """B2: county = last non-blank comma part of a customer address."""
    c = bindings.table(spark, sf_dir, "customer")
    n = bindings.table(spark, sf_dir, "nation")
    a = c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.concat_ws(", ", F.concat(F.lit("Street "), F.col("c_custkey").cast("string")),
                    F.col("c_mktsegment"),
                    F.when(F.col("c_acctbal") < 0, F.lit(" ")).otherwise(F.col("n_name"))
                    ).alias("address"))
    return a.select("customer_id", "address", address_tail("address").alias("county"))


def _multi_format_date(spark, sf_dir):
    """B3 + T14: dates rendered in several formats (or junk) and parsed back."""
    o = bindings.table(spark, sf_dir, "orders")
    d = F.col("o_orderdate").cast("date")
    raw = (F.when(F.col("o_orderpriority") == "5-LOW", F.lit("n/a"))
           .when(F.col("o_orderstatus") == "F", F.date_format(d, "d.M.yyyy"))
           .when(F.col("o_orderstatus") == "P", F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit("Z")))
           .otherwise(F.date_format(d, "yyyy-M-d")))
    return o.select(F.col("o_orderkey").cast("string").alias("entity_id"),
                    multi_format_date(raw).alias("founded_on"))


def _cube_flatten(spark, sf_dir):
    """A2 + B12: population rendered as one cube per county, flattened back."""
    dims = ["year", "age_band", "county", "sex", "ethnicity"]
    cubes = cube.build_cubes(bindings.population(spark, sf_dir), "county", dims, "population")
    return cube.flatten_cube(cubes, dims, value_name="population", int_dims=("year",))


def _cube_scan(spark, sf_dir):
    """A2 from files: cubes landed as JSON lines, scanned with the cube schema, flattened."""
    dims = ["year", "age_band", "county", "sex", "ethnicity"]
    path = shared_dir(spark, "population-cubes")
    cube.build_cubes(bindings.population(spark, sf_dir), "county", dims, "population") \
        .select("json").write.text(path)
    return cube.flatten_cubes(cube.read_cubes(spark, path), dims, value_name="population",
                              int_dims=("year",))


def _cube_pieces(spark, sf_dir):
    """A2 for large cubes: the value arrays are cut into pieces before cells are made."""
    dims = ["year", "age_band", "county", "sex", "ethnicity"]
    cubes = cube.build_cubes(bindings.population(spark, sf_dir), "county", dims, "population")
    parsed = cubes.select(F.from_json("json", cube.CUBE_SCHEMA).alias("_cube"))
    return cube.flatten_cubes_in_pieces(parsed, dims, "population", int_dims=("year",), piece=25)


def _population_reload(spark, sf_dir):
    """C1 with a 5-column key: a cube release is flattened and upserted into the population table."""
    dims = ["year", "age_band", "county", "sex", "ethnicity"]
    target = bindings.population(spark, sf_dir)
    cubes = cube.build_cubes(target, "county", dims, "population")
    release = cube.flatten_cube(cubes, dims, value_name="population", int_dims=("year",))
    return U.upsert(target, release, dims, stamp_col="loaded_at", run_ts=FEED_AS_OF)


def _detail_extract(spark, sf_dir):
    """A8 + B7 + B8: detail payloads with alternative field names -> register rows."""
    return feed.detail_records(payloads.detail_payloads(spark, sf_dir))


def _delimited_scan(spark, sf_dir):
    """A3 + A4 + A5: classification written as ';' CSV with raw headers (by label from
    the last, so that file order is not code order), read back and numbered in file order."""
    path = shared_dir(spark, "classification-csv")
    raw_header = ["Code", "Parent Code?", "Label Text"]
    DL.write_delimited(bindings.classification(spark, sf_dir).orderBy(F.desc("label"), "code"), path, raw_header)
    return DL.with_load_stamp(DL.read_numbered(spark, path, raw_header), LOADED_AT)


def _dense_surrogate_id(spark, sf_dir):
    """A5 at scale: ids 1..n in (founded_on, entity_id) order without a global window."""
    r = bindings.register(spark, sf_dir).select("entity_id", "founded_on")
    return dense_surrogate_id(r, ["founded_on", "entity_id"], out="id")


def _schema_align(spark, sf_dir):
    """A10: an older register extract (extra personal-name column, no load stamp)
    aligned to the current staging schema."""
    reg = bindings.register(spark, sf_dir)
    cust = bindings.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    orders = bindings.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    names = orders.join(cust, orders.o_custkey == cust.c_custkey, "left").select(
        F.col("o_orderkey").cast("string").alias("entity_id"), F.col("c_name").alias("name"))
    old = reg.drop("loaded_at").join(names, "entity_id", "left")
    return align_to(old, reg.schema, drop=("name",))


def _schema_evolve_stored(spark, sf_dir):
    """A10 on stored files: an old generation (with a personal name, years as int, no load stamp
    and no version) and a new one, read as one table; the name is never read."""
    path = shared_dir(spark, "evolving")
    rows = bindings.register(spark, sf_dir).withColumn("year", F.year("founded_on").cast("long"))
    schema = rows.select("entity_id", "county", "year", "activity_version", "loaded_at").schema
    (rows.filter("cast(entity_id AS bigint) % 2 = 0").select(
        "entity_id", "county", F.col("year").cast("int").alias("year"), F.concat(F.lit("Name "), "entity_id").alias("name"))
     .write.mode("append").parquet(path))
    rows.filter("cast(entity_id AS bigint) % 2 <> 0").select(*schema.fieldNames()).write.mode("append").parquet(path)
    return tables.read_evolved(spark, path, schema, {"activity_version": "V1", "loaded_at": LOADED_AT}, private=("name",))


def _quarantine_payloads(spark, sf_dir):
    """Payloads of which some are cut off or lack a key; what cannot be read is stored with
    its reason.  Returns how many of each source came out how, read back from the stored tables."""
    cut = lambda bad: F.when(bad, F.expr("left(xml, length(xml) - 25)")).otherwise(F.col("xml"))
    companies = payloads.register_dump(spark, sf_dir).withColumn("id", F.regexp_extract("xml", "<entity_id>([0-9]+)<", 1))
    keyless = F.replace(F.col("xml"), F.concat(F.lit("<entity_id>"), F.col("id")), F.lit("<entity_id> "))
    n = F.col("id").cast("long")
    sources = {
        "register": (companies.withColumn("xml", F.when(n % 13 == 5, keyless).otherwise(cut(n % 11 == 4))).drop("id"),
                     register_xml.COMPANY_SCHEMA, "entity_id"),
        "feed": (payloads.feed_pages(spark, sf_dir).withColumn("xml", cut(F.col("page") % 5 == 2)), feed.PAGE_SCHEMA, None)}
    paths = {name: shared_dir(spark, f"landed-{name}") for name in sources}

    def land(name):
        rows, schema, key = sources[name]
        return quarantine.land(quarantine.parsed(rows, "xml", schema, key), paths[name], "xml")

    # together, so that one source's tasks run where the other's leave cores idle
    with ThreadPoolExecutor(len(sources)) as pool:
        list(pool.map(land, sources))
    out = None
    for name, (_, schema, _) in sources.items():
        path = paths[name]
        good = quarantine.good_records(spark, path, schema).select(F.lit("good").alias("outcome"))
        part = good.unionByName(quarantine.quarantined(spark, path, "xml").select(F.col("reason").alias("outcome")))
        part = part.groupBy("outcome").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("source"), "outcome", "n")
        out = part if out is None else out.unionByName(part)
    return out


def _live_files(spark, sf_dir):
    """The live file formats end to end: classification and crosswalk as ';' files, the county seed as
    ',' file and the population as cubes land under their native names; the readers' inputs give the flagship mart."""
    base = shared_dir(spark, "live-files")
    reg = M.Registry.from_testdata(spark, sf_dir)
    class_header, walk_header = ["Kood", "Vanem", "Tegevusala tekst"], ["Kood EMTAK 2008", "Kood EMTAK 2025"]
    DL.write_delimited(reg.classification.select("code", "parent", "label"), f"{base}/classification", class_header)
    DL.write_delimited(reg.crosswalk.select("old_code", "new_code"), f"{base}/crosswalk", walk_header)
    seed = {v: k for k, v in live.SEED_COLUMNS.items()}
    (reg.county_seed.select(*[F.col(c).alias(seed[c]) for c in ("county_name", "map_code", "region", "display_order")])
     .write.option("header", True).csv(f"{base}/seed"))
    native = {v: k for k, v in live.CUBE_DIMENSIONS.items()}
    people = reg.population.select(*[F.col(c).alias(native.get(c, c)) for c in (*native, "population")])
    cube.build_cubes(people, native["county"], list(live.CUBE_DIMENSIONS), "population").select("json").write.text(f"{base}/cubes")
    return M.rate_per_1000(M.Registry(
        register=reg.register, classification=live.read_classification(spark, f"{base}/classification", class_header, LOADED_AT)
        .select("code", "parent", "label"), crosswalk=live.read_crosswalk(spark, f"{base}/crosswalk", walk_header),
        population=live.read_population_cubes(spark, f"{base}/cubes", LOADED_AT, multi_line=False),
        county_seed=live.read_county_seed(spark, f"{base}/seed"), domain=reg.domain, as_of=reg.as_of))


def _full_refresh(spark, sf_dir):
    """Reload the classification twice into the same table; no duplicates remain."""
    path = shared_dir(spark, "classification")
    tables.full_refresh(spark, path, bindings.classification(spark, sf_dir), ["code"])
    return tables.full_refresh(spark, path, bindings.classification(spark, sf_dir), ["code"])


def _load_if_missing(spark, sf_dir):
    """A9 + A12: the first call loads the county seed, the second finds the table and skips."""
    path = shared_dir(spark, "county-seed")
    tables.load_if_missing(spark, path, lambda: bindings.county_seed(spark, sf_dir), ["county_name"])
    df, loaded = tables.load_if_missing(spark, path, lambda: bindings.classification(spark, sf_dir))
    assert not loaded
    return df


SOURCE_QUERIES: dict[str, Query] = {
    "register_xml_parse": _register_xml_parse,
    "register_xml_scan": _register_xml_scan,
    "main_activity_pick": _main_activity_pick,
    "address_tail": _address_tail,
    "multi_format_date": _multi_format_date,
    "cube_flatten": _cube_flatten,
    "cube_scan": _cube_scan,
    "cube_pieces": _cube_pieces,
    "population_reload": _population_reload,
    "detail_extract": _detail_extract,
    "delimited_scan": _delimited_scan,
    "dense_surrogate_id": _dense_surrogate_id,
    "schema_align": _schema_align,
    "schema_evolve_stored": _schema_evolve_stored,
    "quarantine_payloads": _quarantine_payloads,
    "live_files": _live_files,
    "full_refresh": _full_refresh,
    "load_if_missing": _load_if_missing,
}


# ---------------------------------------------------------------------------
# Data quality
# ---------------------------------------------------------------------------

def _quality(*kinds):
    def q(spark, sf_dir):
        return kind_summary(M.Registry.from_testdata(spark, sf_dir), kinds)
    return q


def _quality_summary(spark, sf_dir):
    """M8: all 57 declared checks, one row each with failures and status."""
    reg = M.Registry.from_testdata(spark, sf_dir)
    checks = declared_checks(reg.domain)
    return summary(registry_tables(reg, checks), checks)


def _quality_failures(spark, sf_dir):
    """Failing rows of every check stored (one dataset per check), then counted back."""
    path = shared_dir(spark, "quality-failures")
    (failures_frame(M.Registry.from_testdata(spark, sf_dir))
     .write.mode("overwrite").partitionBy("check_name").parquet(path))
    # explicit schema: when every check passes no partition exists
    return (spark.read.schema("row_json string, check_name string").parquet(path).groupBy("check_name")
            .agg(F.count(F.lit(1)).cast("long").alias("stored_rows")))


#: Checks of every kind that the given tables do not all pass.
RAW_CHECKS = [
    Check("not_null__lines__kept_flag", "lines", "not_null", ("kept_flag",)),
    Check("unique__lines__l_orderkey", "lines", "unique", ("l_orderkey",)),
    Check("accepted__lines__l_returnflag", "lines", "accepted", ("l_returnflag",), ("A", "N")),
    Check("relationship__lines__l_suppkey", "lines", "relationship", ("l_suppkey",),
          ref_table="eastern", ref_column="s_suppkey"),
    Check("unique_combo__lines__part_supplier", "lines", "unique_combo", ("l_partkey", "l_suppkey")),
    Check("expression__lines__l_quantity_le_40", "lines", "expression", ("l_quantity",), expr="l_quantity <= 40"),
    Check("singular__lines__discount_without_tax", "lines", "singular", expr="l_discount > 0.05 AND l_tax = 0"),
]


def _raw_tables(spark, sf_dir):
    return {"lines": bindings.table(spark, sf_dir, "lineitem").withColumn(
                "kept_flag", F.when(F.col("l_returnflag") != "R", F.col("l_returnflag"))),
            "eastern": bindings.table(spark, sf_dir, "supplier").filter(F.col("s_nationkey") < 12)}


def _quality_raw_lines(spark, sf_dir):
    """M1-M8 on rows that fail every kind of check."""
    return summary(_raw_tables(spark, sf_dir), RAW_CHECKS)


def _quality_raw_failures(spark, sf_dir):
    """A15 on rows that fail: stored failing rows per check, counted back."""
    path = shared_dir(spark, "raw-failures")
    (failing_frame(_raw_tables(spark, sf_dir), RAW_CHECKS)
     .write.mode("overwrite").partitionBy("check_name").parquet(path))
    return (spark.read.schema("row_json string, check_name string").parquet(path).groupBy("check_name")
            .agg(F.count(F.lit(1)).cast("long").alias("stored_rows")))


def _quality_failing_rows(spark, sf_dir):
    """A15 row by row: which rows fail which check, read back from the stored failures."""
    path = shared_dir(spark, "failing-rows")
    (failing_frame(_raw_tables(spark, sf_dir), RAW_CHECKS)
     .write.mode("overwrite").partitionBy("check_name").parquet(path))
    stored = spark.read.schema("row_json string, check_name string").parquet(path)
    names = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "n_records"]
    # one pass over a row's text for all its fields
    fields = stored.select("check_name", F.json_tuple("row_json", *names).alias(*names))
    return fields.select("check_name", *[F.col(c).cast("long").alias(c) for c in names])


def _quality_observed(spark, sf_dir):
    """M1, M3, M6-M8: row-level checks counted while the checked tables are written, key checks on what was written."""
    return publish_checked(M.Registry.from_testdata(spark, sf_dir), shared_dir(spark, "published"))[1]


QUALITY_QUERIES: dict[str, Query] = {
    "quality_raw_lines": _quality_raw_lines,
    "quality_raw_failures": _quality_raw_failures,
    "quality_not_null": _quality("not_null"),
    "quality_unique": _quality("unique"),
    "quality_accepted": _quality("accepted"),
    "quality_relationship": _quality("relationship"),
    "quality_unique_combo": _quality("unique_combo"),
    "quality_expression": _quality("expression", "singular"),
    "quality_summary": _quality_summary,
    "quality_failures": _quality_failures,
    "quality_failing_rows": _quality_failing_rows,
    "quality_observed": _quality_observed,
}


# ---------------------------------------------------------------------------
# Structured Streaming
# ---------------------------------------------------------------------------

def _events_stream(spark, sf_dir):
    schema = bindings.table(spark, sf_dir, "events").schema
    # a glob, so that a table that is one file and a table that is a folder of files both stream whole
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/[e]vents.parquet")


def _first_seen_run(spark, sf_dir, runs=("r1",)):
    base = shared_dir(spark, "first-seen")
    store = S.LedgerStore(spark, f"{base}/ledger_base", f"{base}/ledger_log")
    bindings.ledger(spark, sf_dir).write.mode("overwrite").parquet(store.base_path)
    details = bindings.details(spark, sf_dir)
    for run in runs:
        S.run_first_seen(spark, bindings.feed_rows(_events_stream(spark, sf_dir)), store, details,
                         f"{base}/register_changes", f"{base}/checkpoint-{run}", run, FEED_AS_OF)
    return store, base


def _stream_first_seen(spark, sf_dir):
    """Streaming first-seen ingest; returns the seen-ledger afterwards."""
    store, _ = _first_seen_run(spark, sf_dir)
    return store.current()


def _stream_register(spark, sf_dir):
    """The register after the stream (base snapshot merged with the logged changes)."""
    _, base = _first_seen_run(spark, sf_dir)
    reg = bindings.register(spark, sf_dir)
    return S.current_register(reg, spark, f"{base}/register_changes", reg.schema, FEED_AS_OF)


def _stream_replay_idempotent(spark, sf_dir):
    """The same feed streamed twice (second run from a fresh checkpoint); ledger unchanged."""
    store, _ = _first_seen_run(spark, sf_dir, runs=("r1", "r2"))
    return store.current()


def _stream_daily_counts(spark, sf_dir):
    """Entries per day and type from an event-time windowed stream."""
    base = shared_dir(spark, "daily-counts")
    S.daily_counts_stream(_events_stream(spark, sf_dir), f"{base}/out", f"{base}/checkpoint")
    return S.read_daily_counts(spark, f"{base}/out")


def _feed_state(spark, sf_dir, base):
    return ST.FeedState.create(base, bindings.register(spark, sf_dir), bindings.ledger(spark, sf_dir),
                               bindings.details(spark, sf_dir),
                               size_hint=tables.stored_bytes(spark, f"{sf_dir}/orders.parquet"))


def _stream_feed_files(spark, sf_dir):
    """N1 over landed files: XML feed pages land in two portions; each is streamed from the
    same checkpoint, so the second run reads the new files only.  Returns the ledger."""
    base = shared_dir(spark, "feed-files")
    state = _feed_state(spark, sf_dir, base)
    pages = payloads.feed_page_records(spark, sf_dir)
    middle = pages.agg((F.max("page") / 2).alias("m")).first()[0]
    for name, portion in (("first", F.col("page") <= middle), ("second", F.col("page") > middle)):
        payloads.land_feed_pages(pages.filter(portion), f"{base}/landing/portion={name}")
        ST.run_ingest(feed.stream_feed_lists(spark, f"{base}/landing/*"), state, f"{base}/checkpoint", "r1",
                      FEED_AS_OF, entries=feed.list_entries)
    return state.seen_companies()


def _stream_keyed_ledger(spark, sf_dir):
    """N1/N3 with the ledger as keyed state: streamed twice, the second time from a fresh checkpoint."""
    base = shared_dir(spark, "keyed-ledger")
    state = _feed_state(spark, sf_dir, base)
    for run in ("r1", "r2"):
        ST.run_ingest(bindings.feed_rows(_events_stream(spark, sf_dir)), state, f"{base}/checkpoint-{run}", run, FEED_AS_OF)
    return state.seen_companies()


def _stream_compacted(spark, sf_dir):
    """C2 inside the stream: the log is folded into the register after the stream, and once
    more after a replay; returns the register, read from its keyed table alone."""
    base = shared_dir(spark, "compacted")
    state = _feed_state(spark, sf_dir, base)
    for run in ("r1", "r2"):
        ST.run_ingest(bindings.feed_rows(_events_stream(spark, sf_dir)), state, f"{base}/checkpoint-{run}", run, FEED_AS_OF)
        ST.compact(state)
    return ST.FeedState.open(spark, base).register.read()


STREAM_QUERIES: dict[str, Query] = {
    "stream_first_seen": _stream_first_seen,
    "stream_register": _stream_register,
    "stream_replay_idempotent": _stream_replay_idempotent,
    "stream_daily_counts": _stream_daily_counts,
    "stream_feed_files": _stream_feed_files,
    "stream_keyed_ledger": _stream_keyed_ledger,
    "stream_compacted": _stream_compacted,
}


def all_queries() -> dict[str, Query]:
    out = dict(MART_QUERIES)
    out.update(CHANGE_QUERIES)
    out.update(SOURCE_QUERIES)
    out.update(QUALITY_QUERIES)
    out.update(STREAM_QUERIES)
    return out
