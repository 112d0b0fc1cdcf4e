"""Golden cases for the column functions (calendar, labels, parsing, folds)."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulse.domain import BOUND
from pulse.functions import calendar as cal
from pulse.functions import labels as lab
from pulse.functions import parse as P
from pulse.functions import text as txt

D = dt.date


def _bucket(spark, founded, as_of):
    df = spark.createDataFrame([(founded,)], "d date")
    r = cal.with_rolling_year(df, "d", as_of).collect()[0]
    return r


def test_anniversary_and_day_after(spark):
    r = _bucket(spark, D(2025, 6, 4), D(2026, 6, 4))
    assert (r.years_ago, r.rolling_year, r.period_start, r.period_end) == (1, 2025, D(2024, 6, 4), D(2025, 6, 3))
    r = _bucket(spark, D(2025, 6, 5), D(2026, 6, 4))
    assert (r.years_ago, r.rolling_year) == (0, 2026)


def test_leap_day_future_null_new_year(spark):
    assert _bucket(spark, D(2024, 2, 29), D(2025, 2, 28)).years_ago == 0
    assert _bucket(spark, D(2024, 2, 29), D(2025, 3, 1)).years_ago == 1
    r = _bucket(spark, D(2026, 12, 1), D(2026, 6, 4))
    assert (r.years_ago, r.in_last_6) == (0, 1)
    assert _bucket(spark, D(2028, 6, 4), D(2026, 6, 4)).years_ago == -2
    r = _bucket(spark, None, D(2026, 6, 4))
    assert (r.years_ago, r.rolling_year, r.period_start, r.in_last_6) == (None, None, None, 0)
    assert _bucket(spark, D(2026, 12, 31), D(2027, 1, 1)).rolling_year == 2026


def test_year_shift_clamps(spark):
    r = _bucket(spark, D(2024, 2, 29), D(2024, 2, 29))
    assert (r.years_ago, r.period_start, r.period_end) == (0, D(2023, 2, 28), D(2024, 2, 28))


def _py_years(d, a):
    if d <= a:
        return a.year - d.year - ((d.month, d.day) > (a.month, a.day))
    return -(d.year - a.year - ((a.month, a.day) > (d.month, d.day)))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.dates(D(1990, 1, 1), D(2030, 12, 31)), min_size=1, max_size=40),
       st.dates(D(2000, 1, 1), D(2027, 12, 31)))
def test_buckets_partition_past_dates(spark, dates, as_of):
    df = spark.createDataFrame([(d,) for d in dates], "d date")
    rows = cal.with_rolling_year(df, "d", as_of).collect()
    for r in rows:
        assert r.years_ago == _py_years(r.d, as_of)
        if r.d <= as_of and not (r.d.month == 2 and r.d.day == 29) and not (as_of.month == 2 and as_of.day == 29):
            # bucket n holds (as_of - (n+1)y, as_of - n y]
            assert r.period_start < r.d <= r.period_end + dt.timedelta(days=1)


def test_groups_and_labels(spark):
    df = spark.createDataFrame([("1-URGENT", "1"), ("3-MEDIUM", "7"), (None, "99"), ("x", None)],
                               "f string, b string")
    rows = df.select(lab.legal_group("f", BOUND).alias("g"), lab.age_group("b", BOUND).alias("a")).collect()
    assert [r.g for r in rows] == ["1_business", "2_sole_trader", "3_other", "3_other"]
    assert [r.a for r in rows] == ["1_young_0-19", "3_old_75+", "2_working_20-74", "2_working_20-74"]
    long = "x" * 59 + " yz"
    df = spark.createDataFrame([("A", long), ("B", "short "), (None, "z"), ("C", None)], "c string, l string")
    got = [r[0] for r in df.select(lab.sector_label("c", "l")).collect()]
    assert got == ["A-" + "x" * 59 + "...", "B-short", "unassigned", "unassigned"]


def test_half_up_ratio(spark):
    df = spark.createDataFrame([(1, 8), (3, 20), (0, 5), (5, 0), (None, 3)], "n long, d long")
    got = [r[0] for r in df.select(lab.half_up_ratio("n", "d", 100)).collect()]
    assert got == [12.5, 15.0, 0.0, None, None]
    df = spark.createDataFrame([(1, 16)], "n long, d long")   # 6.25 -> 6.3 (half up)
    assert df.select(lab.half_up_ratio("n", "d", 100)).collect()[0][0] == 6.3


def test_dates_and_addresses(spark):
    df = spark.createDataFrame([("21.01.2019",), ("2019-01-21",), ("1.2.2019",), ("2019-01-21Z",),
                                ("zz",), (None,)], "s string")
    got = [r[0] for r in df.select(P.multi_format_date("s")).collect()]
    assert got == [D(2019, 1, 21), D(2019, 1, 21), D(2019, 2, 1), D(2019, 1, 21), None, None]
    ts = spark.createDataFrame([("21.01.2019 13:05:09",), ("2019-01-21T01:02:03Z",)], "s string")
    got = [r[0] for r in ts.select(P.multi_format_timestamp("s")).collect()]
    assert got == [dt.datetime(2019, 1, 21, 13, 5, 9), dt.datetime(2019, 1, 21, 1, 2, 3)]
    a = spark.createDataFrame([("Centre, Tallinn, Harju county",), ("A, B, ",), (" , ",)], "s string")
    assert [r[0] for r in a.select(txt.address_tail("s")).collect()] == ["Harju county", "B", None]


def test_main_activity_fold(spark):
    item = "struct<code:string,name:string,version_text:string,version:string,is_main:string>"
    rows = [
        ([("01", "a", None, "v", "false"), ("02", "b", None, "v", "true"), ("03", "c", None, "v", "JAH")],),
        ([(None, "a", None, "v", "true"), ("02", "b", None, "v", "false"), ("03", "c", None, "v", "false")],),
        ([(None, "a", None, "v1", "false"), (None, "z", "vt", "v2", "false")],),
        ([],),
    ]
    df = spark.createDataFrame(rows, f"items array<{item}>")
    got = df.select(P.main_activity(P.activity_items(F.col("items"))).alias("m")).collect()
    assert got[0].m.code == "03"
    assert got[1].m.code == "02"
    assert (got[2].m.code, got[2].m.name, got[2].m.version) == (None, "z", "vt")
    assert got[3].m is None
