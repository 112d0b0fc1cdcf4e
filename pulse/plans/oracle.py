"""Independent SQL (DuckDB dialect) for every registered query.

Only the base tables are visible to the oracle, so each text inlines the
bindings of :mod:`pulse.sources.bindings` as CTEs and then states the rules
in its own structure: a climbing recursion for the hierarchy, a ranked pick
for the crosswalk, day-of-year arithmetic for the rolling year, conditional
sums for the portfolio shift.
"""

from __future__ import annotations

from pulse.domain import AS_OF, BOUND, FEED_AS_OF, LEDGER_AS_OF, LOADED_AT
from pulse.plans.checks import declared_checks

D = BOUND
ASOF = f"DATE '{AS_OF.isoformat()}'"
ASOF_TS = f"TIMESTAMP '{AS_OF.isoformat()} 00:00:00'"
LOADED = f"TIMESTAMP '{LOADED_AT.isoformat(sep=' ')}'"
YEAR = AS_OF.year
FEED_TS = f"TIMESTAMP '{FEED_AS_OF.isoformat(sep=' ')}'"
LEDGER_TS = f"TIMESTAMP '{LEDGER_AS_OF.isoformat(sep=' ')}'"


def _q(vals) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in vals)


G1, G2, G3 = D.legal_group_labels
YOUNG, WORKING, OLD = D.age_group_labels

LEGAL_GROUP = (f"CASE WHEN legal_form IN ({_q(D.business_forms)}) THEN '{G1}' "
               f"WHEN legal_form IN ({_q(D.sole_trader_forms)}) THEN '{G2}' ELSE '{G3}' END")


def sector(code: str, label: str) -> str:
    return (f"coalesce({code} || '-' || trim(left({label}, {D.label_width})) || "
            f"CASE WHEN length({label}) > {D.label_width} THEN '...' ELSE '' END, "
            f"'{D.unassigned_label}')")


def half_up(num: str, den: str, scale: int) -> str:
    """round(num*scale/den, 1), exact half-up, DOUBLE; NULL unless den > 0."""
    return (f"CASE WHEN ({den}) > 0 THEN CAST((CAST({num} AS BIGINT) * {scale * 20} + ({den})) "
            f"// (2 * ({den})) AS DOUBLE) / 10 END")


BINDINGS = f"""
b_register AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS entity_id,
         o.o_orderpriority AS legal_form,
         CAST(o.o_orderdate AS DATE) AS founded_on,
         cn.county AS county,
         o.o_orderstatus AS status,
         'S' || CAST(li.main_supp AS VARCHAR) AS activity_code,
         'Activity S' || CAST(li.main_supp AS VARCHAR) AS activity_name,
         CASE WHEN o.o_orderkey % 3 = 0 THEN 'V1' ELSE 'V2' END AS activity_version,
         {LOADED} AS loaded_at
  FROM orders o
  LEFT JOIN (SELECT c.c_custkey, n.n_name AS county
             FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey) cn
         ON o.o_custkey = cn.c_custkey
  LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS main_supp FROM lineitem GROUP BY l_orderkey) li
         ON o.o_orderkey = li.l_orderkey
),
b_class AS (
  SELECT 'R' || CAST(r_regionkey AS VARCHAR) AS code, CAST(NULL AS VARCHAR) AS parent, r_name AS label FROM region
  UNION ALL
  SELECT 'N' || CAST(n_nationkey AS VARCHAR), 'R' || CAST(n_regionkey AS VARCHAR), n_name FROM nation
  UNION ALL
  SELECT 'S' || CAST(s_suppkey AS VARCHAR), 'N' || CAST(s_nationkey AS VARCHAR), s_name FROM supplier
),
b_crosswalk AS (
  SELECT 'S' || CAST(a.s_suppkey AS VARCHAR) AS old_code, 'S' || CAST(t.s_suppkey AS VARCHAR) AS new_code
  FROM supplier a
  CROSS JOIN (SELECT unnest([1, 3, 10, 30, 100]) AS off) o
  LEFT JOIN supplier t ON t.s_suppkey = a.s_suppkey + o.off
),
b_population AS (
  SELECT CAST(year(l.l_shipdate) AS INTEGER) AS year,
         CAST(l.l_linenumber AS VARCHAR) AS age_band,
         n.n_name AS county,
         l.l_returnflag AS sex,
         l.l_linestatus AS ethnicity,
         CAST(sum(l.l_quantity) AS BIGINT) AS population,
         {LOADED} AS loaded_at
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  GROUP BY 1, 2, 3, 4, 5
),
b_county_seed AS (
  SELECT replace(n.n_name, 'NATION_', '') AS county_name,
         'C' || CAST(n.n_nationkey AS VARCHAR) AS map_code,
         r.r_name AS region,
         CAST(n.n_nationkey + 1 AS INTEGER) AS display_order
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
b_feed AS (
  SELECT CAST(user_id AS VARCHAR) AS entity_id, event_type AS entry_type, ts AS entry_at,
         CAST(event_id AS VARCHAR) AS ruling_no, CAST(ts AS DATE) AS page, event_id AS position
  FROM events
),
b_details AS (
  SELECT CAST(user_id AS VARCHAR) AS entity_id,
         event_type AS legal_form,
         CAST(ts AS DATE) AS founded_on,
         CAST(NULL AS VARCHAR) AS county,
         'active' AS status,
         CASE WHEN event_type IN ('purchase', 'click') THEN 'S' || CAST(event_id % 100 AS VARCHAR) END AS activity_code,
         CASE WHEN event_type IN ('purchase', 'click') THEN 'Activity S' || CAST(event_id % 100 AS VARCHAR) END AS activity_name,
         CASE WHEN event_type IN ('purchase', 'click') THEN 'V2' END AS activity_version
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
        FROM events) WHERE rn = 1 AND event_type <> 'error'
),
b_ledger AS (
  SELECT CAST(user_id AS VARCHAR) AS entity_id, ts AS first_seen_at, ts AS source_entry_at,
         CAST(event_id AS VARCHAR) AS source_ruling_no
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
        FROM events WHERE event_type = 'signup' AND ts < {LEDGER_TS}) WHERE rn = 1
)"""

#: Largest k up to five for which both codes start with the same k characters.
PREFIX_SCORE = ("list_sum(list_transform(range(1, 6), lambda k: "
                "CAST(coalesce(left(new_code, k) = left(old_code, k), false) AS INTEGER)))")

#: Whole years between two dates, by calendar year and day of the year; negative for later dates.
WHOLE_YEARS = ("CASE WHEN {a} <= {b} THEN year({b}) - year({a}) - CAST(strftime({b}, '%m%d') < strftime({a}, '%m%d') AS INTEGER) "
               "ELSE year({b}) - year({a}) + CAST(strftime({a}, '%m%d') < strftime({b}, '%m%d') AS INTEGER) END")

DERIVED = f"""
climb(code, at_code, next_code) AS (
  SELECT code, code, parent FROM b_class
  UNION
  SELECT climb.code, up.code, up.parent FROM climb JOIN b_class up ON up.code = climb.next_code
),
labels AS (SELECT code, label FROM b_class),
closure AS (
  SELECT own.code, own.label AS code_label, top.code AS root_code, top.label AS root_label
  FROM labels own JOIN climb ON climb.code = own.code AND climb.next_code IS NULL
  JOIN labels top ON top.code = climb.at_code
  WHERE EXISTS (SELECT 1 FROM b_class t WHERE t.code = climb.at_code AND t.parent IS NULL)
),
candidates AS (
  SELECT old_code, new_code,
         row_number() OVER (PARTITION BY old_code ORDER BY {PREFIX_SCORE} DESC, new_code NULLS LAST) AS place
  FROM b_crosswalk
),
best_code AS (SELECT old_code, new_code FROM candidates WHERE place = 1),
aged AS (
  SELECT *, CAST({WHOLE_YEARS.format(a='founded_on', b=ASOF)} AS INTEGER) AS years_ago FROM b_register
),
dated AS (
  SELECT *, CAST({ASOF} - to_years(years_ago) - INTERVAL 1 DAY AS DATE) AS period_end,
         CAST({ASOF} - to_years(years_ago + 1) AS DATE) AS period_start FROM aged
),
reg_std AS (
  SELECT d.entity_id, d.legal_form, {LEGAL_GROUP} AS legal_group, d.founded_on, d.years_ago, d.period_start,
         d.period_end, CAST(year(d.period_end) AS INTEGER) AS rolling_year,
         replace(d.county, '{D.county_strip}', '') AS county, d.status, d.activity_code,
         if(d.activity_version IS NOT DISTINCT FROM '{D.old_code_version}', b.new_code, d.activity_code) AS activity_code_std,
         CAST(coalesce(d.years_ago < 6, false) AS INTEGER) AS in_last_6, d.loaded_at
  FROM dated d LEFT JOIN best_code b ON b.old_code = d.activity_code
),
company_counts AS (
  SELECT rolling_year, county, in_last_6, legal_group, root_code, root_label, code IS NOT NULL AS placed,
         count(entity_id) AS n
  FROM reg_std LEFT JOIN closure ON code = activity_code_std
  GROUP BY ALL
),
entity_counts AS (
  SELECT rolling_year, county, {sector('root_code', 'root_label')} AS sector_label, in_last_6,
         CAST(sum(n) AS BIGINT) AS entity_count
  FROM company_counts WHERE legal_group <> '{G3}'
  GROUP BY rolling_year, county, root_code, root_label, in_last_6
),
band_groups AS (
  SELECT unnest([{_q(D.young_bands)}]) AS age_band, '{YOUNG}' AS age_group
  UNION ALL SELECT unnest([{_q(D.old_bands)}]), '{OLD}'
),
pop_clean AS (
  SELECT p.year, coalesce(g.age_group, '{WORKING}') AS age_group,
         replace(p.county, '{D.county_strip}', '') AS county, p.population, p.loaded_at
  FROM b_population p LEFT JOIN band_groups g ON g.age_band = p.age_band
  WHERE p.sex = '{D.sex_total}' AND p.ethnicity = '{D.ethnicity_total}'
    AND left(p.county, {len(D.county_filter_affix)}) = '{D.county_filter_affix}'
    AND NOT list_contains([{_q(D.excluded_bands)}], p.age_band)
),
county_dim AS (
  SELECT CAST(row_number() OVER (ORDER BY display_order) AS BIGINT) AS county_id,
         county_name AS county, map_code, region, display_order
  FROM b_county_seed
),
workers AS (
  SELECT county, year, CAST(sum(population) AS BIGINT) AS working_age_pop
  FROM pop_clean GROUP BY county, year, age_group HAVING age_group = '{WORKING}' AND year > {YEAR} - 6
),
rate AS (
  SELECT w.year, w.county, w.working_age_pop, CAST(coalesce(n.entity_count, 0) AS BIGINT) AS entity_count,
         {half_up('coalesce(n.entity_count, 0)', 'w.working_age_pop', 1000)} AS per_1000,
         c.region, n.sector_label
  FROM county_dim c JOIN workers w USING (county)
  LEFT JOIN entity_counts n ON n.in_last_6 = 1 AND n.county = w.county AND n.rolling_year = w.year
),
young_companies AS (
  SELECT county, activity_code, count(entity_id) AS n FROM reg_std
  WHERE date_diff('day', founded_on, {ASOF}) <= 30
    AND list_contains([{_q(D.business_forms + D.sole_trader_forms)}], legal_form)
  GROUP BY county, activity_code
),
recent AS (
  SELECT y.county, CAST(sum(y.n) AS BIGINT) AS entity_count, {sector('c.root_code', 'c.root_label')} AS sector_label
  FROM young_companies y LEFT JOIN closure c ON c.code = y.activity_code
  GROUP BY y.county, c.root_code, c.root_label
),
both_periods AS (
  SELECT county, sector_label,
         CAST(sum(entity_count) FILTER (rolling_year = {YEAR}) AS BIGINT) AS now_n,
         CAST(CASE WHEN county IS NOT NULL THEN sum(entity_count) FILTER (rolling_year < {YEAR}) END AS BIGINT) AS then_n
  FROM entity_counts WHERE sector_label IS NOT NULL GROUP BY county, sector_label
  HAVING bool_or(rolling_year = {YEAR})
),
county_totals AS (
  SELECT county, sum(now_n) AS now_all, sum(then_n) AS then_all FROM both_periods GROUP BY county
)"""


def with_ctes(select: str, extra: str = "") -> str:
    extra_part = ("," + extra) if extra else ""
    return f"WITH RECURSIVE {BINDINGS},{DERIVED}{extra_part}\n{select}"


MART_FINAL: dict[str, str] = {
    "register_std": "SELECT * FROM reg_std",
    "hierarchy_closure": ("SELECT * FROM closure"),
    "crosswalk_resolve": "SELECT old_code, new_code FROM best_code",
    "county_dimension": ("SELECT * FROM county_dim"),
    "population_clean": ("SELECT * FROM pop_clean"),
    "entity_counts": ("SELECT * FROM entity_counts"),
    "trend_by_region": """
SELECT n.year, n.county, c.region, n.entity_count, n.sector_label, n.in_last_6
FROM (SELECT rolling_year AS year, county, sector_label, in_last_6, CAST(sum(entity_count) AS BIGINT) AS entity_count
      FROM entity_counts GROUP BY ALL) n
LEFT JOIN county_dim c USING (county)""",
    "portfolio_shift": f"""
SELECT p.county, p.sector_label, p.now_n AS entity_count_current, p.then_n AS entity_count_earlier,
       {half_up('p.now_n', 't.now_all', 100)} AS share_current,
       {half_up('p.then_n', 't.then_all', 100)} AS share_earlier
FROM both_periods p JOIN county_totals t ON t.county IS NOT DISTINCT FROM p.county""",
    "rate_per_1000": ("SELECT * FROM rate"),
    "rate_geo": """
SELECT rate.*, c.map_code FROM rate LEFT JOIN county_dim c ON c.county = rate.county""",
    "new_by_activity": f"""
SELECT legal_group, county, root_code, root_label, {sector('root_code', 'root_label')} AS sector_label,
       CAST(sum(n) AS BIGINT) AS entity_count
FROM company_counts WHERE placed AND rolling_year = {YEAR}
GROUP BY legal_group, county, root_code, root_label""",
    "recent_30d": ("SELECT * FROM recent"),
    "top_sectors": """
SELECT CAST(row_number() OVER (ORDER BY n DESC, sector_label) AS INTEGER) AS rank, sector_label, n AS entity_count
FROM (SELECT sector_label, CAST(sum(entity_count) AS BIGINT) AS n FROM recent GROUP BY sector_label)
ORDER BY rank LIMIT 10""",
    "kpi_recent_total": (
        "SELECT CAST(coalesce(sum(entity_count), 0) AS BIGINT) AS recent_total FROM recent"),
    "kpi_data_freshness": (
        "SELECT max(founded_on) AS latest_founded_on, max(loaded_at) AS latest_loaded_at FROM b_register"),
}

MART_SQL: dict[str, str] = {k: with_ctes(v) for k, v in MART_FINAL.items()}


# ---------------------------------------------------------------------------
# Change capture
# ---------------------------------------------------------------------------

def normalised(src: str, trim: bool) -> str:
    t = (lambda e: f"trim({e})") if trim else (lambda e: e)

    def dflt(c, d, w):
        return t(f"left(coalesce(nullif(trim({c}), ''), '{d}'), {w})")

    def cut(c, w):
        return t(f"left(nullif(trim({c}), ''), {w})")
    return f"""SELECT trim(entity_id) AS entity_id,
         {dflt('legal_form', D.default_legal_form, 100)} AS legal_form,
         founded_on,
         {dflt('county', D.default_county, 100)} AS county,
         {dflt('status', D.default_status, 100)} AS status,
         {cut('activity_code', 50)} AS activity_code,
         {cut('activity_name', 255)} AS activity_name,
         {cut('activity_version', 50)} AS activity_version
  FROM {src} WHERE nullif(trim(entity_id), '') IS NOT NULL"""


REGISTER_COLS = ["entity_id", "legal_form", "founded_on", "county", "status", "activity_code",
                 "activity_name", "activity_version", "loaded_at"]
ACTIVITY = ("activity_code", "activity_name", "activity_version")


def upsert_sql(target: str, upd: str, preserve: bool, run_ts: str) -> str:
    cols = ["coalesce(u.entity_id, t.entity_id) AS entity_id"]
    for c in REGISTER_COLS[1:]:
        if c == "loaded_at":
            cols.append(f"CASE WHEN u.entity_id IS NOT NULL THEN {run_ts} ELSE t.loaded_at END AS loaded_at")
        elif preserve and c in ACTIVITY:
            cols.append(f"CASE WHEN u.entity_id IS NOT NULL THEN coalesce(u.{c}, t.{c}) ELSE t.{c} END AS {c}")
        else:
            cols.append(f"CASE WHEN u.entity_id IS NOT NULL THEN u.{c} ELSE t.{c} END AS {c}")
    return (f"SELECT {', '.join(cols)}\nFROM {target} t FULL OUTER JOIN {upd} u "
            f"ON t.entity_id = u.entity_id")


FEED_DAY_START = "TIMESTAMP '2024-01-14 00:00:00'"

CHANGE = f"""
disc AS (
  SELECT entity_id, entry_at, ruling_no, page, position FROM (
    SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY page, position) AS rn
    FROM b_feed WHERE entry_type = '{D.first_entry_type}') WHERE rn = 1
),
unseen AS (
  SELECT d.* FROM disc d WHERE NOT EXISTS (SELECT 1 FROM b_ledger l WHERE l.entity_id = d.entity_id)
),
det_n AS ({normalised('b_details', False)}),
det_t AS ({normalised('b_details', True)}),
loaded AS (SELECT * FROM det_n WHERE entity_id IN (SELECT entity_id FROM unseen)),
failed AS (SELECT * FROM unseen WHERE entity_id NOT IN (SELECT entity_id FROM det_n)),
seen_rows AS (
  SELECT entity_id, {FEED_TS} AS first_seen_at, entry_at AS source_entry_at, ruling_no AS source_ruling_no
  FROM unseen WHERE entity_id IN (SELECT entity_id FROM loaded)
)"""


def with_change(select: str) -> str:
    return with_ctes(select, CHANGE)


def after_increment(select: str, extra: str) -> str:
    """A select over the marts, with the register as the daily increment leaves it."""
    before = BINDINGS.replace("b_register AS", "b_register_before AS")
    return (f"WITH RECURSIVE {before},{CHANGE},\nb_register AS ({upsert_sql('b_register_before', 'loaded', True, FEED_TS)}),"
            f"{DERIVED},{extra}\n{select}")


CHANGE_SQL: dict[str, str] = {
    "feed_first_entries": with_change(
        f"SELECT entity_id, date_trunc('second', entry_at) AS entry_at, ruling_no FROM b_feed "
        f"WHERE entry_type = '{D.first_entry_type}'"),
    "first_occurrence_dedup": with_change("SELECT * FROM disc"),
    "unseen_anti_join": with_change("SELECT * FROM unseen"),
    "insert_if_absent": with_change(f"""
SELECT * FROM b_ledger
UNION ALL
SELECT d.entity_id, {FEED_TS} AS first_seen_at, d.entry_at, d.ruling_no FROM disc d
WHERE NOT EXISTS (SELECT 1 FROM b_ledger l WHERE l.entity_id = d.entity_id)"""),
    "daily_window_slice": with_change(
        f"SELECT * FROM b_feed WHERE entry_at >= {FEED_DAY_START} AND entry_at < {FEED_TS}"),
    "enrich_or_retry": with_change("""
SELECT entity_id, 'loaded' AS outcome FROM loaded
UNION ALL SELECT entity_id, 'failed' AS outcome FROM failed"""),
    "incremental_run_metrics": with_change("""
SELECT CAST((SELECT count(*) FROM disc) AS BIGINT) AS discovered,
       CAST((SELECT count(*) FROM unseen) AS BIGINT) AS unseen,
       CAST((SELECT count(*) FROM loaded) AS BIGINT) AS upserted,
       CAST((SELECT count(*) FROM seen_rows) AS BIGINT) AS seen_inserted,
       CAST((SELECT count(*) FROM failed) AS BIGINT) AS failed"""),
    "incremental_register": with_change(upsert_sql("b_register", "loaded", True, FEED_TS)),
    "incremental_ledger": with_change("SELECT * FROM b_ledger UNION ALL SELECT * FROM seen_rows"),
    "normalise_fields": with_change("SELECT * FROM det_t"),
    "upsert_replace": with_change(upsert_sql("b_register", "det_t", False, FEED_TS)),
    "upsert_preserve": with_change(upsert_sql("b_register", "det_n", True, FEED_TS)),
}


# ---------------------------------------------------------------------------
# Raw sources
# ---------------------------------------------------------------------------

MAIN_PICK = """
act AS (
  SELECT l_orderkey, l_suppkey, l_linenumber, l_returnflag = 'R' AS main,
         row_number() OVER (PARTITION BY l_orderkey
                            ORDER BY l_linenumber, l_suppkey, l_partkey, l_returnflag) AS pos
  FROM lineitem
),
pick AS (
  SELECT a.l_orderkey, a.l_suppkey, a.l_linenumber FROM act a
  JOIN (SELECT l_orderkey, coalesce(max(CASE WHEN main THEN pos END), 1) AS chosen
        FROM act GROUP BY l_orderkey) c
    ON a.l_orderkey = c.l_orderkey AND a.pos = c.chosen
)"""


def _tr(e: str, w: int) -> str:
    return f"trim(left({e}, {w}))"


SOURCE_SQL: dict[str, str] = {
    "register_xml_parse": with_ctes(f"""
SELECT CAST(o.o_orderkey AS VARCHAR) AS entity_id,
       {_tr("coalesce(nullif(trim(o.o_orderpriority), ''), 'unspecified')", 100)} AS legal_form,
       CASE WHEN o.o_orderstatus <> 'P' THEN CAST(o.o_orderdate AS DATE) END AS founded_on,  -- 'P' is dumped with a zone mark
       {_tr("coalesce(n.n_name, 'unspecified')", 100)} AS county,
       {_tr("coalesce(nullif(trim(o.o_orderstatus), ''), 'registered')", 100)} AS status,
       'S' || CAST(p.l_suppkey AS VARCHAR) AS activity_code,
       'Activity S' || CAST(p.l_suppkey AS VARCHAR) AS activity_name,
       CASE WHEN p.l_suppkey IS NULL THEN NULL WHEN o.o_orderkey % 3 = 0 THEN 'V1' ELSE 'V2' END AS activity_version,
       {LOADED} AS loaded_at
FROM orders o
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN pick p ON p.l_orderkey = o.o_orderkey""", MAIN_PICK),
    "main_activity_pick": with_ctes("""
SELECT CAST(l_orderkey AS VARCHAR) AS entity_id, 'S' || CAST(l_suppkey AS VARCHAR) AS activity_code,
       'Activity S' || CAST(l_suppkey AS VARCHAR) AS activity_name,
       'V' || CAST(l_linenumber AS VARCHAR) AS activity_version
FROM pick""", MAIN_PICK),
    "address_tail": with_ctes("""
SELECT customer_id, address,
       list_filter(list_transform(string_split(address, ','), lambda x: trim(x)), lambda x: x <> '')[-1] AS county
FROM (SELECT CAST(c.c_custkey AS VARCHAR) AS customer_id,
             'Street ' || CAST(c.c_custkey AS VARCHAR) || ', ' || c.c_mktsegment || ', ' ||
             CASE WHEN c.c_acctbal < 0 THEN ' ' ELSE n.n_name END AS address
      FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"""),
    "multi_format_date": with_ctes("""
SELECT CAST(o_orderkey AS VARCHAR) AS entity_id,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS founded_on
FROM orders"""),
    "cube_flatten": with_ctes(
        "SELECT year, age_band, county, sex, ethnicity, CAST(population AS INTEGER) AS population "
        "FROM b_population"),
    "detail_extract": with_change("SELECT * FROM det_n"),
    "delimited_scan": with_ctes(f"""
SELECT CAST(row_number() OVER (ORDER BY label DESC, code) AS BIGINT) AS id, code, parent AS parent_code,
       label AS label_text, {LOADED} AS created_at
FROM b_class"""),
    "dense_surrogate_id": with_ctes("""
SELECT entity_id, founded_on, CAST(row_number() OVER (ORDER BY founded_on, entity_id) AS BIGINT) AS id
FROM b_register"""),
    "schema_align": with_ctes("""
SELECT entity_id, legal_form, founded_on, county, status, activity_code, activity_name, activity_version,
       CAST(NULL AS TIMESTAMP) AS loaded_at
FROM b_register"""),
    "full_refresh": with_ctes("SELECT * FROM b_class"),
    "load_if_missing": with_ctes("SELECT * FROM b_county_seed"),
}


# ---------------------------------------------------------------------------
# Quality checks: the declared list, evaluated independently in SQL
# ---------------------------------------------------------------------------

CHECK_TABLES = {
    "population": "b_population", "register": "b_register", "register_std": "reg_std",
    "closure": "closure", "county_dimension": "county_dim", "entity_counts": "entity_counts",
    "population_clean": "pop_clean", "rate_per_1000": "rate", "rate_geo": "q_rate_geo",
    "new_by_activity": "q_new_by_activity", "portfolio_shift": "q_portfolio_shift",
}
QUALITY_CTES = ",\n".join(f"q_{k} AS ({MART_FINAL[k]})"
                          for k in ("rate_geo", "new_by_activity", "portfolio_shift"))


def _lit(v) -> str:
    return str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"


def check_sql(ch) -> str:
    t = CHECK_TABLES[ch.table]
    head = f"SELECT '{ch.name}' AS check_name, '{ch.kind}' AS kind, '{ch.table}' AS table_name, "
    if ch.kind == "not_null":
        n = f"(SELECT count(*) FROM {t} WHERE {ch.columns[0]} IS NULL)"
    elif ch.kind == "accepted":
        c = ch.columns[0]
        n = (f"(SELECT count(*) FROM {t} WHERE {c} IS NOT NULL AND "
             f"{c} NOT IN ({', '.join(_lit(v) for v in ch.values)}))")
    elif ch.kind == "expression":
        n = f"(SELECT count(*) FROM {t} WHERE NOT ({ch.expr}))"
    elif ch.kind == "singular":
        n = f"(SELECT count(*) FROM {t} WHERE {ch.expr})"
    elif ch.kind == "unique":
        c = ch.columns[0]
        n = f"(SELECT count(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1))"
    elif ch.kind == "unique_combo":
        cols = ", ".join(ch.columns)
        n = f"(SELECT count(*) FROM (SELECT {cols} FROM {t} GROUP BY {cols} HAVING count(*) > 1))"
    elif ch.kind == "relationship":
        c, p = ch.columns[0], CHECK_TABLES[ch.ref_table]
        n = (f"(SELECT count(*) FROM {t} x WHERE x.{c} IS NOT NULL AND NOT EXISTS "
             f"(SELECT 1 FROM {p} y WHERE y.{ch.ref_column} = x.{c}))")
    else:
        raise ValueError(ch.kind)
    return head + f"CAST({n} AS BIGINT) AS failures"


def quality_sql(kinds=None, failing_only: bool = False, stored: bool = False) -> str:
    checks = [c for c in declared_checks(D) if kinds is None or c.kind in kinds]
    body = "\nUNION ALL\n".join(check_sql(c) for c in checks)
    if stored:
        sel = f"SELECT check_name, failures AS stored_rows FROM ({body}) WHERE failures > 0"
    else:
        sel = (f"SELECT *, CASE WHEN failures > 0 THEN 'fail' ELSE 'pass' END AS status FROM ({body})")
    return with_ctes(sel, QUALITY_CTES)


QUALITY_SQL: dict[str, str] = {
    "quality_not_null": quality_sql(("not_null",)),
    "quality_unique": quality_sql(("unique",)),
    "quality_accepted": quality_sql(("accepted",)),
    "quality_relationship": quality_sql(("relationship",)),
    "quality_unique_combo": quality_sql(("unique_combo",)),
    "quality_expression": quality_sql(("expression", "singular")),
    "quality_summary": quality_sql(None),
    "quality_failures": quality_sql(None, stored=True),
}
