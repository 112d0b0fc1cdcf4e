"""Raw payloads derived from the bound test tables.

The test environment ships no raw dumps, so these builders render the bound
tables back into the raw formats (XML dump records, feed pages, detail
payloads, population cubes) with ``to_xml`` / ``to_json``.  Parsing them
with :mod:`pulse.sources` must give back what the tables say, which the
oracle computes straight from the tables.

Every group that is collected into one payload is bounded by the domain,
not by the data volume: the lines of one order (at most seven), one feed page
(at most ``PAGE_EVENTS`` entries), one county's population cube.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.session import stored_bytes
from pulse.sources import bindings
from pulse.sources.bindings import table

PAGE_EVENTS = 50
#: Most records of a landed XML file, which one task reads whole: about 70 MB of companies, as much of feed pages.
COMPANIES_PER_FILE, PAGES_PER_FILE = 50_000, 10_000
#: Stored bytes of ``lineitem`` per task that renders companies, and the most such tasks.
RENDER_BYTES, MOST_RENDERERS = 1 << 20, 10_000


def _s(prefix, c):
    return F.concat(F.lit(prefix), c.cast("string"))


def register_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ``company`` XML record per order (column ``xml``)."""
    rec = register_dump_records(spark, sf_dir)
    return rec.select(F.to_xml(F.struct(*rec.columns), {"rowTag": "company"}).alias("xml"))


def write_register_dump(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Land the dump as gzipped XML files (``<companies><company>...</company>...</companies>``).

    As plain text the elements around each value take many times the disk of
    the tables; no split is lost, since a task reads a plain file whole too."""
    (register_dump_records(spark, sf_dir).write.format("xml").option("rowTag", "company").option("compression", "gzip")
     .option("maxRecordsPerFile", COMPANIES_PER_FILE).option("rootTag", "companies").mode("overwrite").save(path))


def register_dump_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dump records as columns (entity_id, general, activities).

    Orders are dealt to tasks by the stored size of their lines: a shuffled
    byte makes about ten of XML, so tasks of the usual shuffled size would be
    few and long, and the last of them would leave most cores idle."""
    tasks = min(MOST_RENDERERS, 1 + stored_bytes(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet") // RENDER_BYTES)
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    lines = (table(spark, sf_dir, "lineitem")
             .select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_returnflag").repartition(tasks, "l_orderkey")
             .groupBy("l_orderkey")
             .agg(F.sort_array(F.collect_list(F.struct(
                 "l_linenumber", "l_suppkey", "l_partkey", "l_returnflag"))).alias("lines")))
    cust = customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")
    o = (orders.join(cust, orders.o_custkey == cust.c_custkey, "left")
         .join(lines, orders.o_orderkey == lines.l_orderkey, "left"))
    d = F.col("o_orderdate").cast("date")
    first_registered = (F.when(F.col("o_orderstatus") == "F", F.date_format(d, "d.M.yyyy"))
                        .when(F.col("o_orderstatus") == "P",
                              F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit("Z")))
                        .otherwise(F.date_format(d, "yyyy-MM-dd")))
    old = F.col("o_orderkey") % 3 == 0
    items = F.transform(F.col("lines"), lambda x: F.struct(
        _s("S", x["l_suppkey"]).alias("code"),
        _s("Activity S", x["l_suppkey"]).alias("name"),
        F.when(old, F.lit("V1")).alias("version_text"),
        F.lit("V2").alias("version"),
        F.when(x["l_returnflag"] == "R", F.lit("true")).otherwise(F.lit("false")).alias("is_main")))
    addresses = F.array(
        F.struct(F.concat(F.lit("Street "), F.col("o_custkey").cast("string"), F.lit(", Town, "),
                          F.col("n_name")).alias("ehak_name")),
        F.struct(F.lit(" , ").alias("ehak_name")))
    return o.select(
        F.col("o_orderkey").cast("string").alias("entity_id"),
        F.struct(F.col("o_orderstatus").alias("status"),
                 F.array(F.lit("draft"), F.col("o_orderpriority")).alias("legal_form_text"),
                 first_registered.alias("first_registered"),
                 F.struct(addresses.alias("item")).alias("addresses")).alias("general"),
        F.struct(items.alias("item")).alias("activities"))


def feed_page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed pages as records (``page``, ``companies``): consecutive runs of PAGE_EVENTS events."""
    ev = table(spark, sf_dir, "events").withColumn(
        "page", F.floor(F.col("event_id") / PAGE_EVENTS).cast("long"))
    entry = F.struct(F.col("event_id").alias("pos"), F.col("event_type").alias("entry_type"),
                     F.date_format("ts", "dd.MM.yyyy HH:mm:ss").alias("entry_at"),
                     F.col("event_id").cast("string").alias("ruling_no"))
    comp = (ev.groupBy("page", "user_id").agg(F.sort_array(F.collect_list(entry)).alias("e"),
                                               F.min("event_id").alias("first_pos")))
    comp_rec = F.struct(F.col("first_pos"), F.col("user_id").cast("string").alias("entity_id"),
                        F.struct(F.transform("e", lambda x: x.dropFields("pos")).alias("item"))
                        .alias("entries"))
    pages = comp.groupBy("page").agg(F.sort_array(F.collect_list(comp_rec)).alias("c"))
    return pages.select("page", F.struct(F.transform("c", lambda x: x.dropFields("first_pos"))
                                         .alias("item")).alias("companies"))


def feed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed pages (``page``, ``xml``): consecutive runs of PAGE_EVENTS events per page."""
    rec = feed_page_records(spark, sf_dir)
    return rec.select("page", F.to_xml(F.struct("companies"), {"rowTag": "page"}).alias("xml"))


def write_feed_pages(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Land the feed as XML files (``<pages><page><companies>...``)."""
    (feed_page_records(spark, sf_dir).select("companies").write.format("xml")
     .option("maxRecordsPerFile", PAGES_PER_FILE).option("rowTag", "page").option("rootTag", "pages").mode("overwrite").save(path))


def land_feed_pages(pages: DataFrame, path: str) -> None:
    """Land page records as XML files in page order, as a puller that goes through the pages leaves them."""
    (pages.repartitionByRange("page").sortWithinPartitions("page").select("companies").write.format("xml")
     .option("maxRecordsPerFile", PAGES_PER_FILE).option("rowTag", "page").option("rootTag", "pages").mode("overwrite").save(path))


def detail_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One detail XML per company with a payload, as services send them: an envelope, prefixed elements, fields under
    alternative names, activities one level deeper, a later activity that must not win, a second company."""
    det = bindings.details(spark, sf_dir)
    alt = F.col("legal_form").isin("view", "signup")
    has_act = F.col("activity_code").isNotNull()
    none = F.lit(None).cast("string")

    def activity(code, name_text, name, version_text, version):
        return F.struct(F.struct(code.alias("code"), name_text.alias("name_text"), name.alias("name"),
                                 version_text.alias("version_text"), version.alias("version")).alias("declared"))

    acts = F.when(has_act, F.array(
        activity(F.lit(" "), none, none, none, none),
        activity(F.col("activity_code"), none, F.col("activity_name"), none, F.col("activity_version")),
        activity(F.lit("S0"), F.lit("Activity S0"), none, F.lit("V0"), none)))
    rec = F.struct(
        F.col("entity_id"),
        F.when(alt, F.col("legal_form")).alias("legal_form_text"),
        F.when(~alt, F.col("legal_form")).alias("legal_form"),
        F.when(alt, F.concat(F.date_format("founded_on", "yyyy-MM-dd"), F.lit("Z"))).alias("first_entry_time"),
        F.when(~alt, F.date_format("founded_on", "d.M.yyyy")).alias("first_registered"),
        F.col("status").alias("status_text"),
        F.struct(acts.alias("item")).alias("activities"))
    company = F.regexp_replace(F.to_xml(rec, {"rowTag": "item"}), "<(/?)", "<$1r:")
    return det.select(F.concat(
        F.lit('<e:Envelope xmlns:e="urn:envelope" xmlns:r="urn:register"><e:Body><r:body><r:companies>'), company,
        F.lit("<r:item><r:entity_id>other</r:entity_id></r:item></r:companies></r:body></e:Body></e:Envelope>"))
        .alias("xml"))
