"""Golden cases for the DataFrame operators."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pulse.operators import crosswalk as cw
from pulse.operators import quality as Q
from pulse.operators import upsert as U
from pulse.operators.hierarchy import closure_with_labels, root_closure
from pulse.operators.ids import dense_surrogate_id
from pulse.sources import cube


def test_closure_golden(spark):
    tree = spark.createDataFrame(
        [("A", None, "root a"), ("01", "A", "l1"), ("011", "01", "l2"), ("B", None, "root b"),
         ("X", "Z", "orphan"), ("C1", "C2", "cyc"), ("C2", "C1", "cyc")],
        "code string, parent string, label string")
    got = {(r.code, r.root) for r in root_closure(tree).collect()}
    assert got == {("A", "A"), ("01", "A"), ("011", "A"), ("B", "B")}
    lab = {r.code: (r.code_label, r.root_code, r.root_label) for r in closure_with_labels(tree).collect()}
    assert lab["011"] == ("l2", "A", "root a")


def test_crosswalk_golden(spark):
    x = spark.createDataFrame(
        [("01111", "01999"), ("01111", "01112"), ("01111", "02000"),
         ("T", "T2"), ("T", "T1"), ("T", None), ("N", None), ("Q", "Z9")],
        "old_code string, new_code string")
    got = {r.old_code: r.new_code for r in cw.resolve(x).collect()}
    assert got == {"01111": "01112", "T": "T1", "N": None, "Q": "Z9"}
    reg = spark.createDataFrame([("e1", "01111", "OLD"), ("e2", "01111", "NEW"), ("e3", "M", "OLD")],
                                "id string, code string, v string")
    out = {r.id: r.activity_code_std for r in cw.translate(reg, cw.resolve(x), "code", "v", "OLD").collect()}
    assert out == {"e1": "01112", "e2": "01111", "e3": None}


TARGET = "entity_id string, status string, activity_code string, loaded_at timestamp_ntz"
T0 = dt.datetime(2020, 1, 1)
T1 = dt.datetime(2024, 1, 15)


def _upsert_both(spark, target, updates, **kw):
    a = U.upsert(target, updates, "entity_id", run_ts=T1, **kw)                # broadcast plan
    b = U.upsert(target, updates, "entity_id", run_ts=T1, key_bound=0, **kw)   # full outer plan
    ra, rb = sorted(map(tuple, a.collect())), sorted(map(tuple, b.collect()))
    assert ra == rb
    return {r[0]: r for r in ra}


def test_upsert_preserve_and_replace(spark):
    t = spark.createDataFrame([("1", "old", "01", T0), ("2", "old", "07", T0)], TARGET)
    u = spark.createDataFrame([("1", "new", None), ("3", "new", "02")],
                              "entity_id string, status string, activity_code string")
    p = _upsert_both(spark, t, u, preserve=("activity_code",))
    assert p["1"][1:] == ("new", "01", T1)
    assert p["2"][1:] == ("old", "07", T0)
    assert p["3"][1:] == ("new", "02", T1)
    r = _upsert_both(spark, t, u)
    assert r["1"][1:] == ("new", None, T1)


def test_upsert_duplicate_updates_last_wins(spark):
    t = spark.createDataFrame([("1", "old", "01", T0)], TARGET)
    u = spark.createDataFrame([("1", "a", "x", 1), ("1", "b", "y", 2)],
                              "entity_id string, status string, activity_code string, pos int")
    out = U.upsert(t, u, "entity_id", run_ts=T1, order=["pos"])
    row = out.collect()[0]
    assert (row.status, row.activity_code) == ("b", "y")


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 20), st.sampled_from(["a", "b", None])), max_size=15))
def test_upsert_idempotent(spark, rows):
    t = spark.createDataFrame([(str(i), "old", "c", T0) for i in range(0, 20, 2)], TARGET)
    seen = {}
    for k, v in rows:
        seen[str(k)] = v
    u = spark.createDataFrame([(k, "s", v) for k, v in seen.items()],
                              "entity_id string, status string, activity_code string")
    once = U.upsert(t, u, "entity_id", preserve=("activity_code",), run_ts=T1)
    twice = U.upsert(once, u, "entity_id", preserve=("activity_code",), run_ts=T1)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_insert_if_absent_and_first_by_key(spark):
    ledger = spark.createDataFrame([("1", 5)], "entity_id string, v int")
    rows = spark.createDataFrame([("1", 9), ("2", 7), ("2", 3)], "entity_id string, v int")
    got = sorted(map(tuple, U.insert_if_absent(ledger, rows, order=["v"]).collect()))
    assert got == [("1", 5), ("2", 3)]


def test_dense_ids(spark):
    df = spark.range(0, 1000).selectExpr("cast(999 - id as int) as k").repartition(7)
    rows = dense_surrogate_id(df, ["k"], out="id").collect()
    assert sorted((r.k, r.id) for r in rows) == [(k, k + 1) for k in range(1000)]


def test_cube_golden(spark):
    js = ('{"id":["aa","d"],"size":[2,3],"dimension":{"aa":{"category":{"index":{"AA1":0,"AA2":1},'
          '"label":{"AA1":"AA1","AA2":"AA2"}}},"d":{"category":{"label":{"X":"X","Y":"Y","Z":"Z"}}}},'
          '"value":[1,2,null,4,5,6]}')
    df = spark.createDataFrame([(js,)], "json string")
    got = sorted(map(tuple, cube.flatten_cube(df, ["aa", "d"]).collect()))
    assert got == [("AA1", "X", 1), ("AA1", "Y", 2), ("AA2", "X", 4), ("AA2", "Y", 5), ("AA2", "Z", 6)]


def test_cube_round_trip(spark):
    fact = spark.createDataFrame([("c1", 2001, "a", 3), ("c1", 2002, "b", 4), ("c2", 2001, "a", 5)],
                                 "county string, year int, band string, v long")
    cubes = cube.build_cubes(fact, "county", ["county", "year", "band"], "v")
    back = cube.flatten_cube(cubes, ["county", "year", "band"], value_name="v", int_dims=("year",))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, fact.collect()))


def test_quality_kinds(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, None, -1), (None, "z", None)], "k int, g string, p int")
    parent = spark.createDataFrame([("a",)], "g string")
    tables = {"t": df, "p": parent}
    checks = [Q.Check("nn", "t", "not_null", ("g",)), Q.Check("uq", "t", "unique", ("k",)),
              Q.Check("acc", "t", "accepted", ("g",), ("a",)),
              Q.Check("rel", "t", "relationship", ("g",), ref_table="p", ref_column="g"),
              Q.Check("combo", "t", "unique_combo", ("k",)),
              Q.Check("expr", "t", "expression", ("p",), expr="p >= 0"),
              Q.Check("sing", "t", "singular", expr="p < 0")]
    got = {r.check_name: (r.failures, r.status) for r in Q.summary(tables, checks).collect()}
    assert got == {"nn": (1, "fail"), "uq": (1, "fail"), "acc": (1, "fail"), "rel": (1, "fail"),
                   "combo": (1, "fail"), "expr": (1, "fail"), "sing": (1, "fail")}


def test_register_xml_reader_ignores_namespaces(spark):
    from pulse.session import shared_dir
    from pulse.sources import register_xml
    doc = """<x:dump xmlns:x="urn:reg">
<x:company><x:entity_id> 10 </x:entity_id>
  <x:general><x:status>Registris</x:status><x:legal_form_text>old</x:legal_form_text>
    <x:legal_form_text>Osaühing</x:legal_form_text><x:first_registered>1.2.2019</x:first_registered>
    <x:addresses><x:item><x:ehak_name>Centre, Tallinn, Harju maakond</x:ehak_name></x:item>
      <x:item><x:ehak_name> , </x:ehak_name></x:item></x:addresses></x:general>
  <x:activities><x:item><x:code>01</x:code><x:is_main>false</x:is_main></x:item>
    <x:item><x:code>02</x:code><x:name>n</x:name><x:version>EMTAK 2008</x:version><x:is_main>jah</x:is_main></x:item>
  </x:activities></x:company>
<x:company><x:entity_id></x:entity_id></x:company>
</x:dump>"""
    path = shared_dir(spark, "xml-ns")
    spark.createDataFrame([(doc,)], "value string").coalesce(1).write.text(path)
    rows = register_xml.read_register_xml(spark, path).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.entity_id, r.legal_form, r.founded_on, r.county, r.status) == \
        ("10", "Osaühing", dt.date(2019, 2, 1), "Harju maakond", "Registris")
    assert (r.activity_code, r.activity_name, r.activity_version) == ("02", "n", "EMTAK 2008")


def test_fused_unique_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "k int, v string")
    checks = [Q.Check("uk", "t", "unique", ("k",)), Q.Check("uv", "t", "unique", ("v",))]
    got = {r.check_name: (r.failures, r.status) for r in Q.summary({"t": df}, checks).collect()}
    assert got == {"uk": (1, "fail"), "uv": (0, "pass")}


def test_bucket_layout_follows_the_table_size(spark, tmp_path, monkeypatch):
    from pulse.plans import catalog
    from pulse.sources import tables
    for n_bytes in (0, 1, 10**9, 10**12, 10**14):
        buckets, files = tables.bucket_layout(n_bytes)
        assert 64 <= buckets <= 10_000 and n_bytes <= buckets * files * tables.FILE_BYTES
    assert tables.bucket_layout(10**9) == (64, 1)
    spark.range(100).repartition(3).write.parquet(str(tmp_path / "folder"))
    parts = [p.stat().st_size for p in (tmp_path / "folder").glob("part-*")]
    assert len(parts) == 3
    assert tables.stored_bytes(spark, str(tmp_path / "folder")) == sum(parts)
    # with small bounds the test register is a table of many buckets and files
    monkeypatch.setattr(tables, "LEAST_BUCKETS", 1)
    monkeypatch.setattr(tables, "BUCKET_BYTES", 20_000)
    monkeypatch.setattr(tables, "FILE_BYTES", 5_000)
    used = []
    write = tables.write_bucketed
    monkeypatch.setattr(tables, "write_bucketed", lambda *a: (used.append(a[3:]), write(*a)))
    got = catalog.CHANGE_QUERIES["upsert_bucketed"](spark, "/root/testdata/sf0.001")
    want = catalog.CHANGE_QUERIES["upsert_preserve"](spark, "/root/testdata/sf0.001")
    assert used[0][0] > 1 and used[0][1] > 1
    assert got.exceptAll(want.select(got.columns)).isEmpty() and got.count() == want.count()


def test_bucketed_upsert_rewrites_only_touched_buckets(spark):
    import os
    from pulse.session import shared_dir
    from pulse.sources import tables
    target = spark.createDataFrame([(str(i), "old", f"c{i}", T0) for i in range(200)], TARGET)
    updates = spark.createDataFrame([("5", "new", None), ("500", "new", "x")],
                                    "entity_id string, status string, activity_code string")
    path, staging = shared_dir(spark, "bucketed"), shared_dir(spark, "bucketed-stage")
    tables.write_bucketed(target, path, ["entity_id"], 16)
    local = path.replace("file:", "")

    def files():
        return {(d, f, os.path.getmtime(os.path.join(local, d, f)))
                for d in os.listdir(local) if d.startswith("_bucket=")
                for f in os.listdir(os.path.join(local, d)) if f.endswith(".parquet")}
    before = files()
    touched = tables.upsert_bucketed(spark, path, updates, ["entity_id"], 16, staging,
                                     preserve=("activity_code",), stamp_col="loaded_at", run_ts=T1)
    after = files()
    untouched_dirs = {f"_bucket={b}" for b in range(16)} - {f"_bucket={b}" for b in touched}
    assert {x for x in before if x[0] in untouched_dirs} == {x for x in after if x[0] in untouched_dirs}
    got = sorted(map(tuple, tables.read_bucketed(spark, path).select(*target.columns).collect()))
    want = sorted(map(tuple, U.upsert(target, updates, "entity_id", preserve=("activity_code",),
                                      run_ts=T1).collect()))
    assert got == want


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["c1", "c2"]), st.integers(2000, 2003),
                          st.sampled_from(["a", "b", "c"]), st.integers(0, 10**6)),
                min_size=1, max_size=25, unique_by=lambda t: t[:3]))
def test_cube_round_trip_property(spark, rows):
    fact = spark.createDataFrame(rows, "county string, year int, band string, v long")
    cubes = cube.build_cubes(fact, "county", ["county", "year", "band"], "v")
    back = cube.flatten_cube(cubes, ["county", "year", "band"], value_name="v", int_dims=("year",))
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_register_xml_with_native_element_names(spark):
    """Any element naming/nesting works given its schema and a RecordLayout."""
    from pyspark.sql import types as T
    from pulse.domain import REGISTRY
    from pulse.session import shared_dir
    from pulse.sources import register_xml as RX
    S_ = T.StringType()
    schema = T.StructType([
        T.StructField("ariregistri_kood", S_),
        T.StructField("yldandmed", T.StructType([
            T.StructField("staatus_tekstina", S_), T.StructField("oiguslik_vorm_tekstina", S_),
            T.StructField("esmaregistreerimise_kpv", S_),
            T.StructField("aadressid", T.StructType([T.StructField("item", T.ArrayType(
                T.StructType([T.StructField("ehak_nimetus", S_)])))]))])),
        T.StructField("teatatud_tegevusalad", T.StructType([T.StructField("item", T.ArrayType(T.StructType(
            [T.StructField(n, S_) for n in ("emtak_kood", "emtak_tekstina", "emtak_versioon_tekstina",
                                               "emtak_versioon", "on_pohitegevusala")])))]))])
    layout = RX.RecordLayout(
        entity_id="ariregistri_kood", status="yldandmed.staatus_tekstina",
        legal_form="yldandmed.oiguslik_vorm_tekstina", first_registered="yldandmed.esmaregistreerimise_kpv",
        addresses="yldandmed.aadressid.item", address_text="ehak_nimetus",
        activities="teatatud_tegevusalad.item", code="emtak_kood", name="emtak_tekstina",
        version_text="emtak_versioon_tekstina", version="emtak_versioon", is_main="on_pohitegevusala")
    doc = """<ettevotjad><ettevotja><ariregistri_kood>123</ariregistri_kood>
  <yldandmed><staatus_tekstina>Registrisse kantud</staatus_tekstina>
    <oiguslik_vorm_tekstina>Osaühing</oiguslik_vorm_tekstina>
    <esmaregistreerimise_kpv>05.03.2021</esmaregistreerimise_kpv>
    <aadressid><item><ehak_nimetus>Kesklinn, Tallinn, Harju maakond</ehak_nimetus></item></aadressid>
  </yldandmed>
  <teatatud_tegevusalad>
    <item><emtak_kood>62011</emtak_kood><emtak_tekstina>a</emtak_tekstina>
      <emtak_versioon>EMTAK 2008</emtak_versioon><on_pohitegevusala>false</on_pohitegevusala></item>
    <item><emtak_kood>62021</emtak_kood><emtak_tekstina>b</emtak_tekstina>
      <emtak_versioon_tekstina>EMTAK 2025</emtak_versioon_tekstina><on_pohitegevusala>jah</on_pohitegevusala></item>
  </teatatud_tegevusalad></ettevotja></ettevotjad>"""
    path = shared_dir(spark, "xml-native")
    spark.createDataFrame([(doc,)], "value string").coalesce(1).write.text(path)
    r = RX.read_register_xml(spark, path, row_tag="ettevotja", domain=REGISTRY, schema=schema,
                             layout=layout).collect()[0]
    assert (r.entity_id, r.legal_form, r.founded_on, r.county, r.status) == \
        ("123", "Osaühing", dt.date(2021, 3, 5), "Harju maakond", "Registrisse kantud")
    assert (r.activity_code, r.activity_name, r.activity_version) == ("62021", "b", "EMTAK 2025")


def test_live_register_layout(spark):
    from pulse.domain import REGISTRY
    from pulse.sources import register_xml as RX
    doc = """<v:ettevotja xmlns:v="urn:x"><v:ariregistri_kood>7</v:ariregistri_kood><v:yldandmed>
  <v:staatus_tekstina>Kustutatud</v:staatus_tekstina><v:oiguslik_vorm_tekstina>Aktsiaselts</v:oiguslik_vorm_tekstina>
  <v:esmaregistreerimise_kpv>2019-01-21</v:esmaregistreerimise_kpv>
  <v:aadressid><v:item><v:ehak_nimetus>Tartu linn, Tartu maakond</v:ehak_nimetus></v:item></v:aadressid>
  <v:teatatud_tegevusalad><v:item><v:emtak_kood>1</v:emtak_kood></v:item><v:item><v:emtak_kood>2</v:emtak_kood>
    <v:emtak_versioon>EMTAK 2025</v:emtak_versioon><v:on_pohitegevusala>1</v:on_pohitegevusala></v:item>
  </v:teatatud_tegevusalad></v:yldandmed></v:ettevotja>"""
    r = RX.parse_register_payloads(spark.createDataFrame([(doc,)], "xml string"), domain=REGISTRY,
                                   schema=RX.LIVE_COMPANY_SCHEMA, layout=RX.LIVE_LAYOUT).collect()[0]
    assert (r.entity_id, r.legal_form, r.founded_on, r.county, r.status, r.activity_code, r.activity_version) == \
        ("7", "Aktsiaselts", dt.date(2019, 1, 21), "Tartu maakond", "Kustutatud", "2", "EMTAK 2025")


def test_detail_payload_anywhere_in_an_envelope(spark):
    from pulse.domain import REGISTRY
    from pulse.sources import feed
    doc = """<s:Envelope xmlns:s="urn:env" xmlns:p="urn:prod"><s:Header><p:ettevotjad/></s:Header><s:Body><p:keha>
  <p:ettevotjad><p:item><p:ariregistri_kood> 55 </p:ariregistri_kood><p:oiguslik_vorm_tekstina>\u00a0</p:oiguslik_vorm_tekstina>
    <p:oiguslik_vorm>OÜ</p:oiguslik_vorm><p:esmaregistreerimise_kpv>2024-01-03Z</p:esmaregistreerimise_kpv>
    <p:koht><p:ehak_nimetus> </p:ehak_nimetus><p:ehak_nimetus>Harju &amp; maakond</p:ehak_nimetus></p:koht>
    <p:alad><p:item><p:tase><p:emtak_kood>62011</p:emtak_kood></p:tase><p:emtak_nimetus>first</p:emtak_nimetus>
      <p:emtak_versioon>EMTAK 2025</p:emtak_versioon></p:item>
      <p:item><p:emtak_tekstina>second</p:emtak_tekstina><p:emtak_versioon_tekstina>EMTAK 2008</p:emtak_versioon_tekstina>
      </p:item></p:alad></p:item>
    <p:item><p:ariregistri_kood>56</p:ariregistri_kood></p:item></p:ettevotjad></p:keha></s:Body></s:Envelope>"""
    keyless = doc.replace("> 55 <", "> <")
    df = spark.createDataFrame([(doc,), (keyless,), ("<a><b></a>",), ("",), (None,), ("<a/>",)], "xml string")
    r, = feed.detail_records(df, domain=REGISTRY, layout=feed.LIVE_DETAIL_LAYOUT).collect()
    assert (r.entity_id, r.legal_form, r.founded_on, r.county) == ("55", "OÜ", dt.date(2024, 1, 3), "Harju & maakond")
    assert (r.activity_code, r.activity_name, r.activity_version) == ("62011", "first", "EMTAK 2025")


def test_live_feed_pages_in_a_soap_envelope(spark):
    from pulse.session import shared_dir
    from pulse.sources import feed
    doc = """<s:Envelope xmlns:s="urn:env" xmlns:p="urn:prod"><s:Body><p:resp><p:keha><p:ettevotjad>
  <p:item><p:ariregistri_kood>111</p:ariregistri_kood><p:kanded>
    <p:item><p:kandeliik_tekstina>Esmakanne</p:kandeliik_tekstina><p:kande_kpv>14.01.2024 10:11:12</p:kande_kpv>
      <p:maaruse_nr>M1</p:maaruse_nr></p:item>
    <p:item><p:kandeliik_tekstina>Muutmiskanne</p:kandeliik_tekstina><p:kande_kpv>2024-01-14</p:kande_kpv></p:item>
  </p:kanded></p:item>
  <p:item><p:ariregistri_kood></p:ariregistri_kood><p:kanded><p:item>
    <p:kandeliik_tekstina>Esmakanne</p:kandeliik_tekstina></p:item></p:kanded></p:item>
</p:ettevotjad></p:keha></p:resp></s:Body></s:Envelope>"""
    path = shared_dir(spark, "feed-live")
    spark.createDataFrame([(doc,)], "value string").coalesce(1).write.text(path)
    rows = feed.read_feed_pages(spark, path, feed.LIVE_FEED_LAYOUT).collect()
    got = sorted((r.entity_id, r.entry_type, r.entry_at, r.ruling_no) for r in rows)
    assert got == [("111", "Esmakanne", dt.datetime(2024, 1, 14, 10, 11, 12), "M1"),
                   ("111", "Muutmiskanne", dt.datetime(2024, 1, 14), None)]


def test_closure_of_a_tree_of_150_levels_and_of_a_cycle(spark):
    import pytest as pt
    from pulse.operators.hierarchy import root_closure
    rows = [("0", None)] + [(str(i), str(i - 1)) for i in range(1, 151)]
    got = root_closure(spark.createDataFrame(rows, "code string, parent string").coalesce(1)).collect()
    assert len(got) == 151 and {r["root"] for r in got} == {"0"}
    cycle = [("a", None), ("b", "a"), ("a", "b")]
    with pt.raises(RuntimeError):
        root_closure(spark.createDataFrame(cycle, "code string, parent string").coalesce(1)).count()


def test_white_space_of_every_kind_is_stripped(spark):
    from pulse.functions import text as txt
    df = spark.createDataFrame([("A,\tTallinn,\n",), ("A,  ,B ",), (" ",)], "x string")
    assert [r[0] for r in df.select(txt.address_tail("x")).collect()] == ["Tallinn", "B", None]
    assert [r[0] for r in df.select(txt.blank_to_null("x")).collect()][2] is None


def test_a_load_without_success_marker_is_repeated(spark, tmp_path):
    import os
    from pulse.sources import tables
    path = str(tmp_path / "t")
    df = spark.range(3)
    assert not tables.table_exists(spark, path)
    df.write.parquet(path)
    assert tables.table_exists(spark, path)
    os.rename(f"{path}/_SUCCESS", f"{path}/_moved")
    assert tables.load_if_missing(spark, path, lambda: df)[1]


def test_staged_tables_need_a_key_and_a_refresh_drops_dependent_views(spark):
    from pulse.session import shared_dir
    from pulse.sources import tables
    path = shared_dir(spark, "keyed")
    good = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    for bad in ([("a", 1), ("a", 2)], [("a", 1), (None, 2)]):
        with pytest.raises(ValueError):
            tables.load_if_missing(spark, path, lambda: spark.createDataFrame(bad, "k string, v int"), ["k"])
    table, loaded = tables.load_if_missing(spark, path, lambda: good, ["k"])
    assert loaded and table.count() == 2
    table.createOrReplaceTempView("keyed_view")
    assert tables.full_refresh(spark, path, good.limit(1), ["k"], dependents=("keyed_view",)).count() == 1
    assert not spark.catalog.tableExists("keyed_view")
