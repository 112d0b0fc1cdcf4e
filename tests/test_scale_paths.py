"""Operators for inputs beyond one task or one broadcast: same rows as the plain ones, and the plans they promise."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulse.domain import FEED_AS_OF
from pulse.operators import bloom
from pulse.operators import hierarchy as H
from pulse.operators import quality as Q
from pulse.operators import upsert as U
from pulse.plans import build, catalog
from pulse.plans import incremental as I
from pulse.plans import marts as M
from pulse.session import shared_dir
from pulse.sources import bindings, cube, quarantine, tables

SF = "/root/testdata/sf0.001"


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def plan_of(df, capsys):
    capsys.readouterr()
    df.explain(mode="formatted")
    return capsys.readouterr().out


# -- closure by pointer doubling ---------------------------------------------

TREE = "code string, parent string, label string"


def test_long_chain_needs_few_rounds(spark):
    n = 5000
    chain = spark.range(n).select(F.col("id").cast("string").alias("code"),
                                  F.when(F.col("id") > 0, (F.col("id") - 1).cast("string")).alias("parent"))
    rounds = []
    got = H.doubled_closure(chain, rounds=rounds)
    assert len(rounds) <= 14
    assert got.agg(F.count("*"), F.min("root"), F.max("root"), F.count_distinct("code")).first() == (n, "0", "0", n)


def test_doubling_equals_the_frontier_loop(spark):
    rng = random.Random(4)
    rows = [(f"r{i}", None, "root") for i in range(3)] + [("r0", None, "a second row of a root")]
    for i in range(200):
        rows.append((f"n{i}", rng.choice([r[0] for r in rows]), "node"))
    rows += [("o1", "missing", "orphan"), ("o2", "o1", "below an orphan"), ("s", "s", "itself"),
             ("c1", "c2", "cycle"), ("c2", "c3", "cycle"), ("c3", "c1", "cycle"), ("c4", "c1", "below a cycle")]
    rows += [(f"d{i}", f"d{i - 1}" if i else "c1", "deep below a cycle") for i in range(70)]
    rows += [(None, "r1", "no code"), ("two", "r1", "two parents"), ("two", "r2", "two parents")]
    tree = spark.createDataFrame(rows, TREE)
    assert content(H.doubled_closure(tree)) == content(H.root_closure(tree))
    assert content(H.closure_with_labels(tree, closure=H.doubled_closure)) == content(H.closure_with_labels(tree))


def test_doubling_of_roots_only_and_nothing(spark):
    tree = spark.createDataFrame([("a", None, "x"), ("b", "none", "y")], TREE)
    assert content(H.doubled_closure(tree)) == [("a", "a")]
    assert content(H.doubled_closure(tree.limit(0))) == []


# -- upsert with a Bloom filter ----------------------------------------------

def test_bloom_filter_holds_its_keys_and_few_others(spark):
    keys = spark.range(0, 20_000, 2).select((F.col("id") * 7).alias("k"), F.col("id").cast("string").alias("t"))
    known = bloom.key_filter(keys, ["k", "t"], 10_000)
    every = spark.range(20_000).select((F.col("id") * 7).alias("k"), F.col("id").cast("string").alias("t"), "id")
    passed = every.join(F.broadcast(known.rows), bloom.may_hold(known, ["k", "t"]), "left_semi")
    even, odd = passed.agg(F.count_if(F.col("id") % 2 == 0), F.count_if(F.col("id") % 2 == 1)).first()
    assert even == 10_000 and odd < 300
    held = bloom.key_filter(keys, ["k", "t"], 10_000, most_bytes=1)
    assert held.blocks == 1
    passed = every.join(F.broadcast(held.rows), bloom.may_hold(held, ["k", "t"]), "left_semi")
    assert passed.filter("id % 2 = 0").count() == 10_000


@pytest.mark.parametrize("preserve", [(), ("b",)])
def test_all_upsert_plans_agree(spark, preserve):
    target = spark.createDataFrame([(i, str(i), f"a{i}", f"b{i}", None) for i in range(500)] + [(None, "n", "a", "b", None)],
                                   "k int, k2 string, a string, b string, loaded_at timestamp_ntz")
    updates = spark.createDataFrame([(i, str(i), f"u{i}", None if i % 2 else "v", i) for i in range(490, 520)]
                                    + [(495, "495", "later", "w", 1000), (None, "n", "null key", "x", 1)],
                                    "k int, k2 string, a string, b string, seq int")
    options = dict(preserve=preserve, run_ts=dt.datetime(2024, 1, 1), order=["seq"])
    want = content(U.upsert(target, updates, ["k", "k2"], key_bound=0, **options))
    assert content(U.upsert_stored(target, updates, ["k", "k2"], **options)) == want
    assert content(U.upsert_stored(target, updates, ["k", "k2"], broadcast_bytes=0, **options)) == want
    assert content(U.upsert_stored(target, updates, ["k", "k2"], broadcast_bytes=0, filter_bytes=0, **options)) == want
    none = updates.limit(0)
    assert content(U.upsert_stored(target, none, ["k", "k2"], broadcast_bytes=0, **options)) == content(target)


def test_only_rows_that_may_match_are_shuffled(spark, capsys):
    plan = plan_of(catalog.CHANGE_QUERIES["upsert_bloom"](spark, SF), capsys)
    assert "LeftAnti" in plan and "LeftSemi" in plan and "BroadcastHashJoin" in plan and "FullOuter" in plan


# -- failing rows in one pass -------------------------------------------------

def test_failing_rows_scan_a_table_once_for_its_row_checks(spark, capsys):
    found = catalog._raw_tables(spark, SF)
    checks = catalog.RAW_CHECKS
    key_checks = [c for c in checks if c.kind not in Q.ROW_LEVEL]
    plan = plan_of(Q.failing_frame(found, checks), capsys)
    scans = plan.split("\n\n\n")[0].count("Scan parquet")
    assert scans <= 1 + len(key_checks) + 1  # one for the row checks, one a key check, one for the parent
    many = checks[:1] * 30
    assert plan_of(Q.failing_frame(found, many), capsys).split("\n\n\n")[0].count("Scan parquet") == 1


def test_a_row_that_fails_twice_comes_out_twice(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (-3, None), (4, "ok")], "n int, v string")
    checks = [Q.Check("nn", "t", "not_null", ("v",)), Q.Check("pos", "t", "expression", ("n",), expr="n > 0"),
              Q.Check("list", "t", "accepted", ("v",), ("ok",))]
    got = content(Q.failing_frame({"t": df}, checks))
    assert got == [("list", '{"n":2,"v":"x"}'), ("nn", '{"n":-3}'), ("nn", '{"n":1}'), ("pos", '{"n":-3}')]
    counters = tables.observed_write(df, shared_dir(spark, "observed"), Q.row_counters(checks))
    assert counters == {"nn": 2, "pos": 1, "list": 1}
    want = Q.summary({"t": df}, checks)
    assert content(Q.counted_summary(spark, checks, counters).select(want.columns)) == content(want)


def test_observed_counters_equal_counted_ones(spark, capsys):
    sources = [f(spark, SF) for f in (bindings.register, bindings.ledger, bindings.feed, bindings.details)]
    paths, counters = I.run_observed(*sources, shared_dir(spark, "run"), FEED_AS_OF)
    plain = I.from_testdata(spark, SF)
    assert plain.metrics().first().asDict() == counters
    assert content(spark.read.parquet(paths["ledger"])) == content(plain.ledger)
    assert content(spark.read.parquet(paths["register"]).select(plain.register.columns)) == content(plain.register)
    assert "Scan parquet" not in plan_of(I.counters_frame(spark, counters), capsys)


# -- stored marts --------------------------------------------------------------

def test_stored_mart_prunes_years_and_pushes_counties(spark, capsys):
    paths = build.build_marts(M.Registry.from_testdata(spark, SF), shared_dir(spark, "marts"))
    got = build.read_mart(spark, paths["rate_per_1000"], county=["1", "7"], year=[1996, 1999])
    plan = plan_of(got, capsys)
    assert any(line.startswith("PartitionFilters") and "year" in line for line in plan.splitlines())
    assert any(line.startswith("PushedFilters") and "In(county" in line for line in plan.splitlines())
    whole = spark.read.parquet(paths["rate_per_1000"])
    assert content(got) == content(whole.filter("county IN ('1', '7') AND year IN (1996, 1999)"))
    by_file = whole.groupBy(F.input_file_name().alias("f")).agg(F.count_distinct("year").alias("n"))
    assert by_file.filter("n > 1").count() == 0


# -- cubes ----------------------------------------------------------------------

def big_cube(spark, sizes, holes=7):
    n = 1
    for s in sizes:
        n *= s
    dims = "abcd"[:len(sizes)]
    label = lambda d, s: {d: {"category": {"index": {f"{d}{i}": i for i in range(s)}, "label": {f"{d}{i}": f"{d.upper()}{i}" for i in range(s)}}}}
    dimension = {k: v for d, s in zip(dims, sizes) for k, v in label(d, s).items()}
    head = spark.createDataFrame([(list(dims), list(sizes), dimension)], T.StructType(cube.CUBE_SCHEMA.fields[:3]))
    values = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.when(i % holes != 0, i.cast("double")))
    whole = head.withColumn("value", values)
    return whole.select(F.struct(*whole.columns).alias("_cube")), list(dims), n


def test_pieces_give_the_rows_of_whole_cubes(spark):
    cubes, dims, n = big_cube(spark, (7, 5, 3))
    small, _, _ = big_cube(spark, (2, 1, 2))
    nothing = cubes.select(cubes["_cube"].withField("value", F.array().cast("array<double>")).alias("_cube"))
    several = cubes.union(small).union(nothing)
    want = content(cube.flatten_cubes(several, dims))
    for piece in (1, 10, 105, 1000):
        assert content(cube.flatten_cubes_in_pieces(several, dims, piece=piece)) == want
    assert len(want) == sum(1 for i in range(n) if i % 7) + 3
    assert content(cube.flatten_cubes_in_pieces(several, dims, keep_nulls=True, piece=4)) == content(
        cube.flatten_cubes(several, dims, keep_nulls=True))


def test_a_large_cube_is_spread_over_tasks(spark):
    cubes, dims, n = big_cube(spark, (100, 100, 20, 10))
    assert n == 2_000_000
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        cells = cube.flatten_cubes_in_pieces(cubes, dims, piece=50_000)
        per_task = cells.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()
        total, checksum = cells.agg(F.count("*"), F.sum("value")).first()
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    held = [i for i in range(0, n, 7)]
    assert total == n - len(held) and checksum == n * (n - 1) // 2 - sum(held)
    assert len(per_task) >= 4 and max(r["n"] for r in per_task) < n / 2


# -- stored generations ------------------------------------------------------------

def test_generations_of_two_schemas_read_as_one(spark, capsys):
    path = shared_dir(spark, "generations")
    spark.createDataFrame([(1, "Ann", 5)], "id int, name string, n int").write.mode("append").parquet(path)
    spark.createDataFrame([(2, 6_000_000_000, "v2", None)], "id int, n long, version string, extra date").write.mode("append").parquet(path)
    schema = T.StructType.fromDDL("id int, n long, version string")
    got = tables.read_evolved(spark, path, schema, {"version": "v1"}, private=("name",))
    assert content(got) == [(1, 5, "v1"), (2, 6_000_000_000, "v2")]
    assert "name" not in plan_of(got, capsys)
    with pytest.raises(ValueError, match="name"):
        tables.read_evolved(spark, path, T.StructType.fromDDL("id int, name string"), private=("name",))


# -- quarantine --------------------------------------------------------------------

ITEM = T.StructType([T.StructField("entity_id", T.StringType()),
                     T.StructField("general", T.StructType([T.StructField("status", T.StringType())]))])


def test_unreadable_payloads_are_kept_with_their_reason(spark):
    good = "<company><entity_id>{}</entity_id><general><status>R</status></general></company>"
    texts = [good.format(1), good.format(2)[:-12], "", None, "no xml", good.format(" "), "<company/>", good.format(3)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, xml string")
    path = shared_dir(spark, "landed")
    counters = quarantine.land(quarantine.parsed(df, "xml", ITEM, "entity_id"), path, "xml")
    kept = quarantine.good_records(spark, path, ITEM)
    bad = quarantine.quarantined(spark, path, "xml", "n int")
    assert counters["landed"] == len(texts) == counters["good"] + counters["quarantined"]
    assert sorted(r["entity_id"] for r in kept.collect()) == ["1", "3"]
    got = {r["n"]: (r["xml"], r["reason"]) for r in bad.collect()}
    assert got[1] == (texts[1], "malformed") and got[5] == (texts[5], "without key") and got[6][1] == "without key"
    assert {i: got[i][0] for i in (2, 3, 4)} == {2: "", 3: None, 4: "no xml"}
    # a retry of mended payloads
    mended = bad.filter("n = 1").withColumn("xml", F.concat("xml", F.lit(good[-12:]))).drop("reason")
    again = quarantine.parsed(mended, "xml", ITEM, "entity_id").collect()
    assert [(r["reason"], r["record"]["entity_id"]) for r in again] == [(None, "2")]


def test_unreadable_records_of_files(spark, tmp_path):
    (tmp_path / "dump.xml").write_text(
        "<companies><company><entity_id>1</entity_id></company><company><entity_id>2</entity_id><general>"
        "</company><company><entity_id>3</entity_id></company></companies>")
    got = quarantine.read_records(spark, str(tmp_path), "company", ITEM, "entity_id").collect()
    assert sorted(r["record"]["entity_id"] for r in got if r["reason"] is None)[:1] == ["1"]
    assert any(r["reason"] == "malformed" and "<entity_id>2" in r["payload"] for r in got)
