"""Register dump (XML): one ``company`` element per record.

Read with Spark's XML source and an explicit schema (never inferred: codes
such as ``01`` would become numbers).  A dump should land as many files: each
is read whole by one task, compressed or not.

Record layout (element names are parameters of the schema below)::

    <company>
      <entity_id/>
      <general>
        <status/> <legal_form_text/> (repeated: last wins) <first_registered/>
        <addresses><item><ehak_name>street, town, county</ehak_name></item>...</addresses>
      </general>
      <activities><item><code/><name/><version_text/><version/><is_main/></item>...</activities>
    </company>
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulse.domain import BOUND
from pulse.functions import parse as P
from pulse.functions import text as txt
from pulse.functions.calendar import ntz_lit
from pulse.operators.normalise import normalise_register_fields

S = T.StringType()
ACTIVITY_ITEM = T.StructType([T.StructField(n, S) for n in
                              ("code", "name", "version_text", "version", "is_main")])
COMPANY_SCHEMA = T.StructType([
    T.StructField("entity_id", S),
    T.StructField("general", T.StructType([
        T.StructField("status", S),
        T.StructField("legal_form_text", T.ArrayType(S)),
        T.StructField("first_registered", S),
        T.StructField("addresses", T.StructType([
            T.StructField("item", T.ArrayType(T.StructType([T.StructField("ehak_name", S)])))])),
    ])),
    T.StructField("activities", T.StructType([
        T.StructField("item", T.ArrayType(ACTIVITY_ITEM))])),
])


@dataclass(frozen=True)
class RecordLayout:
    """Where each canonical field sits in a parsed company record (dotted
    paths; activity and address fields are relative to one list item).
    The defaults match ``COMPANY_SCHEMA``; a dump with other element names
    needs only its own schema and layout."""

    entity_id: str = "entity_id"
    status: str = "general.status"
    legal_form: str = "general.legal_form_text"        # repeated element: the last one wins
    first_registered: str = "general.first_registered"
    addresses: str = "general.addresses.item"
    address_text: str = "ehak_name"
    activities: str = "activities.item"
    code: str = "code"
    name: str = "name"
    version_text: str = "version_text"
    version: str = "version"
    is_main: str = "is_main"


DEFAULT_LAYOUT = RecordLayout()


def _texts(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, S) for n in names])


def _items(item: T.StructType) -> T.StructType:
    return T.StructType([T.StructField("item", T.ArrayType(item))])


# --- fixed values: element names of the live register dump (rowTag "ettevotja") ---
LIVE_COMPANY_SCHEMA = T.StructType([
    T.StructField("ariregistri_kood", S),
    T.StructField("yldandmed", T.StructType([
        T.StructField("staatus_tekstina", S),
        T.StructField("oiguslik_vorm_tekstina", T.ArrayType(S)),
        T.StructField("esmaregistreerimise_kpv", S),
        T.StructField("aadressid", _items(_texts("ehak_nimetus"))),
        T.StructField("teatatud_tegevusalad", _items(_texts(
            "emtak_kood", "emtak_tekstina", "emtak_versioon_tekstina", "emtak_versioon", "on_pohitegevusala"))),
    ])),
])
LIVE_LAYOUT = RecordLayout(
    entity_id="ariregistri_kood", status="yldandmed.staatus_tekstina",
    legal_form="yldandmed.oiguslik_vorm_tekstina", first_registered="yldandmed.esmaregistreerimise_kpv",
    addresses="yldandmed.aadressid.item", address_text="ehak_nimetus",
    activities="yldandmed.teatatud_tegevusalad.item", code="emtak_kood", name="emtak_tekstina",
    version_text="emtak_versioon_tekstina", version="emtak_versioon", is_main="on_pohitegevusala")
# --- end of fixed values ----------------------------------------------------------


def read_register_xml(spark: SparkSession, path: str, row_tag: str = "company",
                      domain=BOUND, run_ts=None, schema=COMPANY_SCHEMA,
                      layout: RecordLayout = DEFAULT_LAYOUT) -> DataFrame:
    """Scan XML files of the dump and return canonical register rows."""
    raw = (spark.read.format("xml").option("rowTag", row_tag).option("ignoreNamespace", "true")
           .schema(schema).load(path))
    return register_records(raw, domain, run_ts, layout)


def parse_register_payloads(df: DataFrame, col: str = "xml", domain=BOUND, run_ts=None,
                            schema=COMPANY_SCHEMA, layout: RecordLayout = DEFAULT_LAYOUT) -> DataFrame:
    """Same as :func:`read_register_xml` for payloads held in a text column."""
    return register_records(parse_once(df, col, schema), domain, run_ts, layout)


def parse_once(df: DataFrame, col: str, schema) -> DataFrame:
    """Parse an XML text column into top-level columns, evaluating the parser once.

    ``inline`` over a one-element array is a generator: later filters on the
    parsed fields cannot be pushed below it, so the optimizer never copies
    the (expensive) parser call into a pushed-down predicate.
    """
    return df.select(F.inline(F.array(F.from_xml(F.col(col), schema, {"ignoreNamespace": "true"}))))


def _path(base, dotted: str):
    out = base
    for part in dotted.split("."):
        out = out[part]
    return out


def register_records(raw: DataFrame, domain=BOUND, run_ts=None,
                     layout: RecordLayout = DEFAULT_LAYOUT) -> DataFrame:
    """Parsed company structs -> register staging rows (all native expressions).

    The parsed record and the activity fold are each computed in their own
    projection and referenced by name afterwards, so neither the parser nor
    the fold is re-evaluated per output field.
    """
    L = layout
    head, _, rest = L.legal_form.partition(".")
    legal = _path(F.col(head), rest) if rest else F.col(head)
    if isinstance(raw.select(legal).schema[0].dataType, T.ArrayType):
        legal = F.try_element_at(legal, F.lit(-1))
    h, _, r = L.addresses.partition(".")
    tails = F.filter(F.transform(_path(F.col(h), r) if r else F.col(h),
                                 lambda a: txt.address_tail(_path(a, L.address_text))),
                     lambda t: t.isNotNull())
    h, _, r = L.activities.partition(".")
    items = F.transform(_path(F.col(h), r) if r else F.col(h), lambda x: F.struct(
        _path(x, L.code).alias("code"), _path(x, L.name).alias("name"),
        _path(x, L.version_text).alias("version_text"), _path(x, L.version).alias("version"),
        _path(x, L.is_main).alias("is_main")))
    pick = P.main_activity(P.activity_items(items, tokens=domain.truthy_tokens))

    def col(dotted):
        h, _, r = dotted.partition(".")
        return _path(F.col(h), r) if r else F.col(h)
    rows = raw.select(
        col(L.entity_id).cast("string").alias("entity_id"),
        txt.blank_to_null(legal).alias("legal_form"),
        # the full load takes no zone mark, unlike the increment
        P.multi_format_date(txt.blank_to_null(col(L.first_registered)), strip_z=False).alias("founded_on"),
        F.try_element_at(tails, F.lit(-1)).alias("county"),      # last address wins
        txt.blank_to_null(col(L.status)).alias("status"),
        pick.alias("_pick"),
    ).select("entity_id", "legal_form", "founded_on", "county", "status",
             F.col("_pick.code").alias("activity_code"),
             F.col("_pick.name").alias("activity_name"),
             F.col("_pick.version").alias("activity_version"))
    out = normalise_register_fields(rows, domain, trim=True)
    return out.withColumn("loaded_at", ntz_lit(run_ts))
