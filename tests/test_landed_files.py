"""Landed XML files: one task reads a file whole, so none may follow the input's size."""

import datetime as dt

from pyspark.sql import functions as F

from pulse.domain import LOADED_AT
from pulse.operators.quality import Check, failing_frame
from pulse.plans import catalog
from pulse.session import shared_dir, stored_bytes
from pulse.sources import bindings, feed, payloads, register_xml

SF = "/root/testdata/sf0.001"


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def files(spark, path):
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).count()


def test_files_of_the_dump_are_bounded(spark, monkeypatch):
    want = content(catalog.all_queries()["register_xml_parse"](spark, SF))
    monkeypatch.setattr(payloads, "COMPANIES_PER_FILE", 20)
    path = shared_dir(spark, "small-files")
    payloads.write_register_dump(spark, SF, path)
    assert files(spark, path) >= len(want) / 20
    assert content(register_xml.read_register_xml(spark, path, run_ts=LOADED_AT)) == want


def store_orders(spark, at, n):
    """Tables of ``n`` orders with two lines each, then one order without customer, date or lines, twice."""
    day = dt.datetime(2001, 2, 3)
    orders = [(k, k % 7, "OFP"[k % 3], 1.0, day + dt.timedelta(days=k % 900), f"{k % 5}-LIMITED & <CO>") for k in range(n)]
    lines = [(k, 1, k % 11 + i, i + 1, 1.0, 1.0, 0.0, 0.0, "RN"[(k + i) % 2], "O", day) for k in range(n) for i in range(2)]
    rows = {"orders": orders + [(n, None, None, None, None, None)] * 2, "lineitem": lines,
            "customer": [(k, f"c{k}", k % 3, 1.0, "m") for k in range(6)] + [(6, None, None, None, None)]}
    for name, r in rows.items():
        spark.createDataFrame(r, bindings.TABLE_SCHEMAS[name]).write.parquet(f"{at}/{name}.parquet")
    spark.createDataFrame([(0, "NORTH"), (1, "ÕUE"), (2, None)], "n_nationkey int, n_name string").write.parquet(f"{at}/nation.parquet")


def test_the_landed_dump_takes_a_small_part_of_its_text(spark):
    at = shared_dir(spark, "orders")
    store_orders(spark, at, 5000)
    path = shared_dir(spark, "dump")
    payloads.write_register_dump(spark, at, path)
    text = payloads.register_dump(spark, at).agg(F.sum(F.length("xml"))).first()[0]
    assert stored_bytes(spark, path) * 5 < text
    landed = content(register_xml.read_register_xml(spark, path, run_ts=LOADED_AT))
    assert len(landed) == 5002
    assert landed == content(catalog.all_queries()["register_xml_parse"](spark, at))
    assert landed == content(catalog.all_queries()["register_xml_scan"](spark, at))


def test_a_dump_without_orders_lands_and_reads_empty(spark):
    at = shared_dir(spark, "no-orders")
    store_orders(spark, f"{at}-all", 3)
    for name in ("orders", "lineitem", "customer", "nation"):
        some = spark.read.parquet(f"{at}-all/{name}.parquet")
        (some.limit(0) if name in ("orders", "lineitem") else some).write.parquet(f"{at}/{name}.parquet")
    assert content(catalog.all_queries()["register_xml_scan"](spark, at)) == []


def test_files_of_feed_pages_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(payloads, "PAGES_PER_FILE", 2)
    pages = payloads.feed_page_records(spark, SF)
    for k, land in enumerate((lambda p: payloads.write_feed_pages(spark, SF, p), lambda p: payloads.land_feed_pages(pages, p))):
        path = shared_dir(spark, f"small-pages-{k}")
        land(path)
        assert files(spark, path) >= pages.count() / 2
        landed = spark.read.format("xml").option("rowTag", "page").schema(feed.PAGE_SCHEMA).load(path)
        assert landed.count() == pages.count()


def test_rendering_tasks_follow_the_stored_lines(spark, monkeypatch, capsys):
    want = content(payloads.register_dump_records(spark, SF))
    monkeypatch.setattr(payloads, "RENDER_BYTES", 5_000)
    rows = payloads.register_dump_records(spark, SF)
    capsys.readouterr()
    rows.explain(mode="extended")
    dealt = 1 + stored_bytes(spark, f"{SF}/lineitem.parquet") // 5_000
    assert dealt > 4 and f", {dealt}), REPARTITION_BY_NUM" in capsys.readouterr().out
    assert content(rows) == want


def test_failing_rows_are_read_and_rendered_once(spark, capsys):
    capsys.readouterr()
    catalog.all_queries()["quality_failing_rows"](spark, SF).explain(mode="extended")
    plan = capsys.readouterr().out
    assert "json_tuple" in plan and "get_json_object" not in plan
    rows = spark.createDataFrame([(1, None, 9), (2, "x", 9), (3, None, 0), (None, "x", 1)], "a int, b string, c int")
    checks = [Check("no_b", "t", "not_null", ("b",)), Check("small_c", "t", "expression", expr="c < 5")]
    found = failing_frame({"t": rows}, checks)
    assert content(found) == [("no_b", '{"a":1,"c":9}'), ("no_b", '{"a":3,"c":0}'),
                              ("small_c", '{"a":1,"c":9}'), ("small_c", '{"a":2,"b":"x","c":9}')]
    found.explain(mode="formatted")
    generate = capsys.readouterr().out.split(") Generate")[-1].split("\n\n")[0]
    assert "row_json" in generate  # the text is there before a row is multiplied
