"""Mart golden cases on a hand-made fixture in the live-register vocabulary."""

import datetime as dt

import pytest

from pulse.domain import REGISTRY, REGISTRY_COUNTY_SEED
from pulse.plans import marts as M

D = dt.date
TS = dt.datetime(2026, 6, 4, 3, 0)
V_OLD, V_NEW = "EMTAK 2008", "EMTAK 2025"
REG = ("entity_id string, legal_form string, founded_on date, county string, status string, "
       "activity_code string, activity_name string, activity_version string, loaded_at timestamp_ntz")
POP = "year int, age_band string, county string, sex string, ethnicity string, population long, loaded_at timestamp_ntz"
ALL_SEX, ALL_ETH = "Mehed ja naised", "Rahvused kokku"


@pytest.fixture(scope="module")
def reg(spark):
    register = spark.createDataFrame([
        ("1", "Osaühing", D(2026, 1, 10), "Harju maakond", "Registris", "01111", "a", V_OLD, TS),
        ("2", "Füüsilisest isikust ettevõtja", D(2025, 3, 1), "Tartu maakond", "Registris", "02", "b", V_NEW, TS),
        ("3", "Mittetulundusühing", D(2026, 5, 1), "Harju maakond", "Registris", "02", "c", V_NEW, TS),
        ("4", "Aktsiaselts", D(2019, 1, 1), "Harju maakond", "Registris", "02", "d", V_NEW, TS),
    ], REG)
    classification = spark.createDataFrame([
        ("A", None, "Põllumajandus"), ("01", "A", "x"), ("011", "01", "y"), ("01112", "011", "z"),
        ("B", None, "Tööstus"), ("02", "B", "w")], "code string, parent string, label string")
    crosswalk = spark.createDataFrame([("01111", "01999"), ("01111", "01112"), ("01111", "02000")],
                                      "old_code string, new_code string")
    population = spark.createDataFrame([
        (2026, "20-24", "Harju maakond", ALL_SEX, ALL_ETH, 1000, TS),
        (2026, "20-24", "Tartu maakond", ALL_SEX, ALL_ETH, 500, TS),
        (2025, "20-24", "Tartu maakond", ALL_SEX, ALL_ETH, 400, TS),
        (2026, "0-4", "Harju maakond", ALL_SEX, ALL_ETH, 70, TS),            # young: not working age
        (2026, "Vanuserühmad kokku", "Harju maakond", ALL_SEX, ALL_ETH, 9, TS),   # total band: dropped
        (2026, "20-24", "Tallinn", ALL_SEX, ALL_ETH, 9, TS),                 # a city, not a county
        (2026, "20-24", "Harju maakond", "Mehed", ALL_ETH, 9, TS),           # not the sex total
    ], POP)
    seed = spark.createDataFrame(list(REGISTRY_COUNTY_SEED),
                                 "county_name string, map_code string, region string, display_order int")
    return M.Registry(register, classification, crosswalk, population, seed, domain=REGISTRY,
                      as_of=D(2026, 6, 4))


def test_register_std(reg):
    rows = {r.entity_id: r for r in M.register_std(reg).collect()}
    r1 = rows["1"]
    assert (r1.legal_group, r1.county, r1.activity_code_std, r1.rolling_year, r1.in_last_6) == \
        ("1_äriettevõtted", "Harju", "01112", 2026, 1)
    assert (rows["2"].legal_group, rows["2"].rolling_year) == ("2_FIE", 2025)
    assert (rows["3"].legal_group, rows["4"].years_ago, rows["4"].in_last_6) == ("3_Muud_jur_isikud", 7, 0)


def test_rate_zero_fill_and_labels(reg):
    got = {(r.year, r.county): (r.entity_count, r.per_1000, r.sector_label, r.region)
           for r in M.rate_per_1000(reg).collect()}
    assert got == {(2026, "Harju"): (1, 1.0, "A-Põllumajandus", "Põhja-Eesti"),
                   (2026, "Tartu"): (0, 0.0, None, "Lõuna-Eesti"),
                   (2025, "Tartu"): (1, 2.5, "B-Tööstus", "Lõuna-Eesti")}


def test_portfolio_present_only_now_or_only_before(reg):
    rows = [tuple(r) for r in M.portfolio_shift(reg).collect()]
    assert rows == [("Harju", "A-Põllumajandus", 1, None, 100.0, None)]


def test_counts_exclude_other_group(reg):
    got = {(r.rolling_year, r.county, r.sector_label, r.in_last_6): r.entity_count
           for r in M.entity_counts(reg).collect()}
    assert got == {(2026, "Harju", "A-Põllumajandus", 1): 1, (2025, "Tartu", "B-Tööstus", 1): 1,
                   (2019, "Harju", "B-Tööstus", 0): 1}


def test_aligned_buckets_follow_printed_period(reg):
    import dataclasses
    base = {r.entity_id: r for r in M.register_std(reg).collect()}
    aligned = {r.entity_id: r for r in M.register_std(dataclasses.replace(reg, aligned_buckets=True)).collect()}
    for k, r in aligned.items():
        if r.founded_on is not None and r.founded_on <= reg.as_of:
            assert r.period_start <= r.founded_on <= r.period_end
    assert base.keys() == aligned.keys()


def test_aligned_anniversary(spark):
    import dataclasses
    df = spark.createDataFrame([(D(2025, 6, 4),), (D(2025, 6, 3),), (D(2025, 6, 5),)], "founded_on date")
    r = M.Registry(df, None, None, None, None, as_of=D(2026, 6, 4), aligned_buckets=True)
    got = [row[0] for row in df.select(M.years_ago_of(r)).collect()]
    assert got == [0, 1, 0]           # the anniversary belongs to the period ending 2026-06-03
    plain = [row[0] for row in df.select(M.years_ago_of(dataclasses.replace(r, aligned_buckets=False))).collect()]
    assert plain == [1, 1, 0]


def test_portfolio_full(reg):
    rows = {(r.county, r.sector_label): tuple(r)[2:] for r in M.portfolio_shift(reg, full=True).collect()}
    assert rows == {("Harju", "A-Põllumajandus"): (1, None, 100.0, None),
                    ("Harju", "B-Tööstus"): (None, 1, None, 100.0),
                    ("Tartu", "B-Tööstus"): (None, 1, None, 100.0)}


def test_cube_shape_issues(spark):
    from pulse.sources import cube
    good = '{"id":["a"],"size":[2],"dimension":{"a":{"category":{"label":{"x":"x","y":"y"}}}},"value":[1,2]}'
    bad = '{"id":["a"],"size":[3],"dimension":{"a":{"category":{"label":{"x":"x","y":"y","z":"z"}}}},"value":[1,2]}'
    df = spark.createDataFrame([(good,), (bad,)], "json string")
    got = [(r.expected_cells, r.actual_cells) for r in cube.cube_shape_issues(df).collect()]
    assert got == [(3, 2)]


def test_daily_run_all(spark):
    from pulse.domain import FEED_AS_OF
    from pulse.plans.daily import run_all
    from pulse.session import shared_dir
    from pulse.sources import bindings
    sf = "/root/testdata/sf0.001"
    reg = M.Registry.from_testdata(spark, sf)
    paths = run_all(reg, bindings.ledger(spark, sf), bindings.feed(spark, sf), bindings.details(spark, sf),
                    shared_dir(spark, "daily"), FEED_AS_OF)
    metrics = spark.read.parquet(paths["load_metrics"]).collect()[0]
    assert metrics.discovered >= metrics.unseen >= metrics.upserted == metrics.seen_inserted
    assert spark.read.parquet(paths["quality_summary"]).count() == 57
    assert spark.read.parquet(paths["rate_per_1000"]).count() > 0


SMALL = "/root/testdata/sf0.001"


def test_current_shares_sum_to_100_per_county(spark):
    from pyspark.sql import functions as F
    reg = M.Registry.from_testdata(spark, SMALL)
    per = (M.portfolio_shift(reg).groupBy("county")
           .agg(F.sum("share_current").alias("s"), F.count(F.lit(1)).alias("n")).collect())
    assert per
    for r in per:
        assert abs(r.s - 100.0) <= 0.05 * r.n + 1e-9      # each share is rounded to 0.1


def test_closure_has_one_root_per_reached_node(spark):
    from pyspark.sql import functions as F
    reg = M.Registry.from_testdata(spark, SMALL)
    dup = reg.closure.groupBy("code").agg(F.countDistinct("root_code").alias("r")).filter("r != 1")
    assert dup.count() == 0
    roots = {r.code for r in reg.classification.filter("parent is null").collect()}
    assert {r.root_code for r in reg.closure.select("root_code").distinct().collect()} <= roots


def test_live_source_files_feed_the_marts(spark):
    """Live-format files (classification / crosswalk CSV, seed CSV, cube JSON) read into a Registry."""
    import json
    from pulse.session import shared_dir
    from pulse.sources import live
    base = shared_dir(spark, "live-files")
    cls_header = ["Kood", "Vanem", "Tegevusala tekst", "Siia kuulub?"]
    spark.createDataFrame([("A", "", "Põllumajandus", "x"), ("01", "A", "x", ""), ("011", "01", "y", ""),
                           ("01112", "011", "z", ""), ("B", "", "Tööstus", ""), ("02", "B", "w", "")],
                          "a string, b string, c string, d string") \
        .coalesce(1).write.option("sep", ";").option("header", True).csv(f"{base}/cls")
    cw_header = ["Kood EMTAK 2008", "Kood EMTAK 2025"]
    spark.createDataFrame([("01111", "01999"), ("01111", "01112"), ("01111", "02000")], "a string, b string") \
        .coalesce(1).write.option("sep", ";").option("header", True).csv(f"{base}/cw")
    spark.createDataFrame(list(REGISTRY_COUNTY_SEED), "a string, b string, c string, d int") \
        .toDF("maakond_nimi", "iso_kood", "regioon", "kuvajarjestus").coalesce(1) \
        .write.option("header", True).csv(f"{base}/seed")
    dims = {"Aasta": ["2025", "2026"], "Vanuserühm": ["20-24"], "Maakond": ["Harju maakond", "Tartu maakond"],
            "Sugu": [ALL_SEX], "Rahvus": [ALL_ETH]}
    cube_doc = {"id": list(dims), "size": [len(v) for v in dims.values()],
                "dimension": {d: {"category": {"index": {m: i for i, m in enumerate(v)},
                                               "label": {m: m for m in v}}} for d, v in dims.items()},
                "value": [0, 400, 1000, 500]}   # row-major: (2025,Harju) (2025,Tartu) (2026,Harju) (2026,Tartu)
    spark.createDataFrame([(json.dumps(cube_doc, ensure_ascii=False),)], "v string") \
        .coalesce(1).write.text(f"{base}/cube")

    classification = live.read_classification(spark, f"{base}/cls", cls_header, TS)
    assert classification.filter("code = 'A'").collect()[0].parent is None
    assert [r.code for r in classification.orderBy("id").collect()] == ["A", "01", "011", "01112", "B", "02"]
    staged = live.read_crosswalk(spark, f"{base}/cw", cw_header, TS).orderBy("id").collect()
    assert [(r.id, r.new_code) for r in staged] == [(1, "01999"), (2, "01112"), (3, "02000")]
    crosswalk = live.read_crosswalk(spark, f"{base}/cw", cw_header)
    seed = live.read_county_seed(spark, f"{base}/seed")
    population = live.read_population_cubes(spark, f"{base}/cube", TS, multi_line=False)
    register = spark.createDataFrame([
        ("1", "Osaühing", D(2026, 1, 10), "Harju maakond", "Registris", "01111", "a", V_OLD, TS),
        ("2", "Füüsilisest isikust ettevõtja", D(2025, 3, 1), "Tartu maakond", "Registris", "02", "b", V_NEW, TS),
    ], REG)
    reg = M.Registry(register, classification.select("code", "parent", "label"), crosswalk, population, seed,
                     domain=REGISTRY, as_of=D(2026, 6, 4))
    got = {(r.year, r.county): (r.entity_count, r.per_1000, r.sector_label)
           for r in M.rate_per_1000(reg).collect()}
    assert got == {(2026, "Harju"): (1, 1.0, "A-Põllumajandus"), (2026, "Tartu"): (0, 0.0, None),
                   (2025, "Tartu"): (1, 2.5, "B-Tööstus"), (2025, "Harju"): (0, None, None)}
