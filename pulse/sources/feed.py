"""Change-feed pages and detail payloads (XML text).

A feed page holds companies, each with a list of register entries::

    <page><companies><item><entity_id/><entries><item>
        <entry_type/><entry_at/><ruling_no/></item>...</entries></item>...</companies></page>

A detail payload holds a company somewhere in an envelope; several fields
have alternative names, and address and activity fields may sit at any depth.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulse.domain import BOUND
from pulse.functions import parse as P
from pulse.functions import text as txt
from pulse.operators.normalise import normalise_register_fields

S = T.StringType()
ENTRY = T.StructType([T.StructField("entry_type", S), T.StructField("entry_at", S),
                      T.StructField("ruling_no", S)])
PAGE_SCHEMA = T.StructType([T.StructField("companies", T.StructType([
    T.StructField("item", T.ArrayType(T.StructType([
        T.StructField("entity_id", S),
        T.StructField("entries", T.StructType([T.StructField("item", T.ArrayType(ENTRY))])),
    ])))]))])

def page_entries(pages: DataFrame, col: str = "xml") -> DataFrame:
    """One row per (company, entry) of each page, in page order.

    Returns (entity_id, entry_type, entry_at, ruling_no, page, position);
    companies without a key and entries of keyless companies are skipped.
    """
    p = pages.select(F.col("page"), F.from_xml(F.col(col), PAGE_SCHEMA, {"ignoreNamespace": "true"})["companies"]["item"].alias("_items"))
    comp = p.select("page", F.posexplode(F.col("_items")).alias("_ci", "_c"))
    ent = comp.select("page", "_ci", F.col("_c.entity_id").alias("_id"),
                      F.posexplode(F.col("_c.entries.item")).alias("_ei", "_e"))
    return (ent.filter(txt.blank_to_null("_id").isNotNull())
            .select(txt.blank_to_null("_id").alias("entity_id"),
                    txt.blank_to_null("_e.entry_type").alias("entry_type"),
                    P.multi_format_timestamp(F.col("_e.entry_at")).alias("entry_at"),
                    txt.blank_to_null("_e.ruling_no").alias("ruling_no"),
                    "page", (F.shiftleft(F.col("_ci").cast("long"), 32) + F.col("_ei")).alias("position")))


def first_entries_from_pages(pages: DataFrame, entry_type: str, col: str = "xml") -> DataFrame:
    """A7 + C6: entries of the first-registration type."""
    return page_entries(pages, col).filter(F.col("entry_type") == entry_type)


@dataclass(frozen=True)
class DetailLayout:
    """Element names of a detail payload.  The company is the first ``item``
    of a ``companies_tag`` element, wherever it sits in an envelope.  Fields
    of several names: legal form, founding date and status take the first
    name that has a value; activity name and version the first element of
    any of the names."""

    companies_tag: str = "companies"
    entity_id: str = "entity_id"
    legal_form: tuple[str, ...] = ("legal_form_text", "legal_form")
    founded: tuple[str, ...] = ("first_entry_time", "first_registered", "founded")
    region: str = "region_text"
    address_text: str = "ehak_name"
    status: tuple[str, ...] = ("status_text", "status")
    code: tuple[str, ...] = ("code",)
    name: tuple[str, ...] = ("name_text", "name")
    version: tuple[str, ...] = ("version_text", "version")


# --- fixed values: element names of the live detail payloads -----------------
LIVE_DETAIL_LAYOUT = DetailLayout(
    companies_tag="ettevotjad", entity_id="ariregistri_kood",
    legal_form=("oiguslik_vorm_tekstina", "oiguslik_vorm"),
    founded=("esmakande_aeg", "esmaregistreerimise_kpv", "asutamise_kuupaev"),
    region="piirkond_tekstina", address_text="ehak_nimetus", status=("staatus_tekstina", "staatus"),
    code=("emtak_kood",), name=("emtak_tekstina", "emtak_nimetus"),
    version=("emtak_versioon_tekstina", "emtak_versioon"))
# --- end of fixed values -----------------------------------------------------

#: Separates the texts of one evaluation; XML text cannot hold it.
UNIT = "\x1f"
#: The XML library takes expressions of up to 100 operators.
AT_ONCE = 3


def _company_fields(col: str, layout: DetailLayout):
    """Array of the company's texts, ``AT_ONCE`` to an XPath evaluation: children by name, then elements at any
    depth.  Prefixes are ignored; a text is what stands before an element's first child."""
    company = f"(//*[local-name()='{layout.companies_tag}']/*[local-name()='item'])[1]"
    text = "/text()[not(preceding-sibling::*)]"
    children = (layout.entity_id, *layout.legal_form, *layout.founded, layout.region, *layout.status)
    parts = [f"string({company}/*[local-name()='{n}'][1]{text})" for n in children]
    for names in ((layout.address_text,), layout.code, layout.name, layout.version):
        named = " or ".join(f"local-name()='{n}'" for n in names)
        parts.append(f"string({company}/descendant-or-self::*[{named}]{text}"
                     f"[translate(., '{txt.WHITE_SPACE}', '') != ''])")

    def texts(some: list[str]):
        path = "concat(" + f", '{UNIT}', ".join(some) + ", '')"
        return F.split(F.xpath_string(F.col(col), F.lit(path)), UNIT, -1)

    # a payload that is not well formed would end the job
    broken = F.from_xml(F.col(col), "_corrupt_record string")["_corrupt_record"].isNotNull()
    return F.when(~broken, F.concat(*[texts(parts[i:i + AT_ONCE]) for i in range(0, len(parts), AT_ONCE)]))


def detail_records(payloads: DataFrame, col: str = "xml", domain=BOUND,
                   layout: DetailLayout = DetailLayout()) -> DataFrame:
    """A8 + B7 + B8: detail payload -> register-shaped row (increment rules: no trim).

    Payloads without a company, without its key, or not well formed give no row.
    """
    # a generator keeps the optimizer from copying the evaluation into every field
    d = payloads.select(F.inline(F.array(F.struct(_company_fields(col, layout).alias("_f")))))
    at = 0

    def field(names=("",)):
        nonlocal at
        at += len(names)
        return F.coalesce(*[txt.blank_to_null(F.get("_f", i)) for i in range(at - len(names), at)])

    rows = d.select(
        field().alias("entity_id"), field(layout.legal_form).alias("legal_form"),
        P.multi_format_date(field(layout.founded)).alias("founded_on"), field().alias("region"),
        field(layout.status).alias("status"), field().alias("address"), field().alias("activity_code"),
        field().alias("activity_name"), field().alias("activity_version"))
    rows = rows.select("entity_id", "legal_form", "founded_on", F.coalesce("region", "address").alias("county"),
                       "status", "activity_code", "activity_name", "activity_version")
    return normalise_register_fields(rows, domain, trim=False)


@dataclass(frozen=True)
class FeedLayout:
    """Element names of a feed page: the element holding the company list
    (used as rowTag, so it may sit anywhere in an envelope), the company key,
    the entry list and the entry fields."""

    companies_tag: str = "companies"
    entity_id: str = "entity_id"
    entries: str = "entries"
    entry_type: str = "entry_type"
    entry_at: str = "entry_at"
    ruling_no: str = "ruling_no"


# --- fixed values: element names of the live change feed ---------------------
# company list, company key, entry list, entry type text, entry date, ruling number
LIVE_FEED_LAYOUT = FeedLayout(companies_tag="ettevotjad", entity_id="ariregistri_kood", entries="kanded",
                              entry_type="kandeliik_tekstina", entry_at="kande_kpv", ruling_no="maaruse_nr")
# --- end of fixed values -----------------------------------------------------


def _list_schema(L: FeedLayout) -> T.StructType:
    entry = T.StructType([T.StructField(n, S) for n in (L.entry_type, L.entry_at, L.ruling_no)])
    return T.StructType([T.StructField("item", T.ArrayType(T.StructType([
        T.StructField(L.entity_id, S),
        T.StructField(L.entries, T.StructType([T.StructField("item", T.ArrayType(entry))]))])))])


def _lists(reader, path: str, layout: FeedLayout) -> DataFrame:
    """One row per company list of the files at ``path``: (file, path, item)."""
    raw = (reader.format("xml").option("rowTag", layout.companies_tag).option("ignoreNamespace", "true")
           .schema(_list_schema(layout)).load(path))
    return raw.select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_path").alias("path"), "item")


def read_feed_pages(spark, path: str, layout: FeedLayout = FeedLayout()) -> DataFrame:
    """Scan landed feed pages (XML files) into entry rows
    (entity_id, entry_type, entry_at, ruling_no, page, position).

    Every ``companies_tag`` element becomes one row (namespaces ignored);
    ``page`` is the number that ends the file name (0 without one), ``position``
    orders the entries of a page by file, list, company and entry.
    """
    return list_entries(_lists(spark.read, path, layout), layout)


def stream_feed_lists(spark, path: str, layout: FeedLayout = FeedLayout(), files_per_batch: int = 1000) -> DataFrame:
    """Landed feed pages as a stream of company lists; the unit of progress is a
    file, and a file that was read is not read again by the same checkpoint.
    :func:`list_entries` turns a micro-batch into entries."""
    return _lists(spark.readStream.option("maxFilesPerTrigger", files_per_batch), path, layout)


def list_entries(lists: DataFrame, layout: FeedLayout = FeedLayout()) -> DataFrame:
    """Entry rows of company lists (file, path, item), as in :func:`read_feed_pages`."""
    L = layout
    # the number at the end of the file name orders pages (page-10 after page-2); the row's
    # number orders the lists inside a file, which one task reads from start to end
    number = F.regexp_extract(F.col("file"), r"(\d+)\D*$", 1)
    listed = lists.select(F.coalesce(F.nullif(number, F.lit("")).cast("long"), F.lit(0)).alias("page"),
                          F.col("path").alias("_file"), F.monotonically_increasing_id().alias("_list"), "item")
    comp = listed.select("page", "_file", "_list", F.posexplode("item").alias("_ci", "_c"))
    ent = comp.select("page", "_file", "_list", "_ci", F.col("_c")[L.entity_id].alias("_id"),
                      F.posexplode(F.col("_c")[L.entries]["item"]).alias("_ei", "_e"))
    return (ent.filter(txt.blank_to_null("_id").isNotNull())
            .select(txt.blank_to_null("_id").alias("entity_id"),
                    txt.blank_to_null(F.col("_e")[L.entry_type]).alias("entry_type"),
                    P.multi_format_timestamp(F.col("_e")[L.entry_at]).alias("entry_at"),
                    txt.blank_to_null(F.col("_e")[L.ruling_no]).alias("ruling_no"), "page",
                    F.struct(F.col("_file").alias("file"), F.col("_list").alias("list"),
                             F.col("_ci").alias("company"), F.col("_ei").alias("entry")).alias("position")))
