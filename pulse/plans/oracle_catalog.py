"""key -> DuckDB SQL for every query that has an SQL oracle."""

from __future__ import annotations

from pulse.plans import oracle as O


def _stored_rows() -> str:
    """The marts' rows as mart_build_rows shows them."""
    parts = {"trend_by_region": ("q_trend_by_region", "year", "region", "entity_count"),
             "rate_per_1000": ("rate", "year", "region", "entity_count"),
             "rate_geo": ("q_rate_geo", "year", "map_code", "entity_count"),
             "portfolio_shift": ("q_portfolio_shift", "NULL", "NULL", "entity_count_current"),
             "new_by_activity": ("q_new_by_activity", "NULL", "legal_group", "entity_count"),
             "recent_30d": ("recent", "NULL", "NULL", "entity_count")}
    return "\nUNION ALL\n".join(
        f"SELECT '{mart}' AS mart, CAST({year} AS INTEGER) AS year, county, CAST({extra} AS VARCHAR) AS extra, sector_label, "
        f"CAST({n} AS BIGINT) AS entity_count FROM {view}" for mart, (view, year, extra, n) in parts.items())


def all_oracles() -> dict[str, str]:
    out = dict(O.MART_SQL)
    out["mart_filtered"] = O.with_ctes(
        "SELECT * FROM rate WHERE county IN ('1', '7', '13', '24') AND year IN (1996, 1999)")
    marts = {"county_dimension": "county_dim", "hierarchy_closure": "closure",
             "population_clean": "pop_clean", "entity_counts": "entity_counts",
             "trend_by_region": "q_trend_by_region", "portfolio_shift": "q_portfolio_shift",
             "rate_per_1000": "rate", "rate_geo": "q_rate_geo", "new_by_activity": "q_new_by_activity",
             "recent_30d": "recent"}
    extra = ",\n".join(f"q_{k} AS ({O.MART_FINAL[k]})"
                        for k in ("trend_by_region", "portfolio_shift", "rate_geo", "new_by_activity"))
    out["mart_build"] = O.with_ctes("\nUNION ALL\n".join(
        f"SELECT '{k}' AS mart, CAST(count(*) AS BIGINT) AS row_count FROM {v}" for k, v in marts.items()),
        extra)
    out["intermediate_views"] = O.with_ctes(
        "SELECT legal_group, in_last_6, root_code, CAST(sum(n) AS BIGINT) AS companies "
        "FROM company_counts GROUP BY legal_group, in_last_6, root_code")
    raw = """
WITH per_key AS (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1),
per_pair AS (SELECT l_partkey, l_suppkey FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1),
found(check_name, kind, failures) AS (
  SELECT 'not_null__lines__kept_flag', 'not_null', count(*) FROM lineitem WHERE l_returnflag = 'R'
  UNION ALL SELECT 'unique__lines__l_orderkey', 'unique', count(*) FROM per_key
  UNION ALL SELECT 'accepted__lines__l_returnflag', 'accepted', count(*) FROM lineitem WHERE l_returnflag NOT IN ('A', 'N')
  UNION ALL SELECT 'relationship__lines__l_suppkey', 'relationship', count(*) FROM lineitem
    WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 12)
  UNION ALL SELECT 'unique_combo__lines__part_supplier', 'unique_combo', count(*) FROM per_pair
  UNION ALL SELECT 'expression__lines__l_quantity_le_40', 'expression', count(*) FROM lineitem WHERE l_quantity > 40
  UNION ALL SELECT 'singular__lines__discount_without_tax', 'singular', count(*) FROM lineitem
    WHERE l_discount > 0.05 AND l_tax = 0
)
"""
    out["quality_raw_lines"] = raw + (
        "SELECT check_name, kind, 'lines' AS table_name, CAST(failures AS BIGINT) AS failures, "
        "if(failures > 0, 'fail', 'pass') AS status FROM found")
    out["quality_raw_failures"] = raw + (
        "SELECT check_name, CAST(failures AS BIGINT) AS stored_rows FROM found WHERE failures > 0")
    out["quality_failing_rows"] = """
WITH lines AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_quantity, l_discount, l_tax FROM lineitem),
failed AS (
  SELECT 'not_null__lines__kept_flag' AS check_name, l_orderkey, l_linenumber, l_partkey, l_suppkey, NULL AS n_records
    FROM lines WHERE l_returnflag = 'R'
  UNION ALL SELECT 'accepted__lines__l_returnflag', l_orderkey, l_linenumber, l_partkey, l_suppkey, NULL
    FROM lines WHERE l_returnflag NOT IN ('A', 'N')
  UNION ALL SELECT 'expression__lines__l_quantity_le_40', l_orderkey, l_linenumber, l_partkey, l_suppkey, NULL
    FROM lines WHERE l_quantity > 40
  UNION ALL SELECT 'singular__lines__discount_without_tax', l_orderkey, l_linenumber, l_partkey, l_suppkey, NULL
    FROM lines WHERE l_discount > 0.05 AND l_tax = 0
  UNION ALL SELECT 'relationship__lines__l_suppkey', l_orderkey, l_linenumber, l_partkey, l_suppkey, NULL
    FROM lines WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 12)
  UNION ALL SELECT 'unique__lines__l_orderkey', l_orderkey, NULL, NULL, NULL, count(*) FROM lines GROUP BY ALL HAVING count(*) > 1
  UNION ALL SELECT 'unique_combo__lines__part_supplier', NULL, NULL, l_partkey, l_suppkey, count(*) FROM lines
    GROUP BY ALL HAVING count(*) > 1)
SELECT check_name, CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  CAST(l_partkey AS BIGINT) AS l_partkey, CAST(l_suppkey AS BIGINT) AS l_suppkey, CAST(n_records AS BIGINT) AS n_records FROM failed"""
    out["mart_stored_filtered"] = out["mart_filtered"]
    out["hierarchy_doubling"] = O.MART_SQL["hierarchy_closure"]
    out["live_files"] = O.MART_SQL["rate_per_1000"]
    out["mart_build_rows"] = O.with_ctes(_stored_rows(), extra)
    out["daily_run"] = O.after_increment(_stored_rows(), extra)
    out.update(O.CHANGE_SQL)
    out.update(O.SOURCE_SQL)
    out.update(O.QUALITY_SQL)
    out["register_xml_scan"] = O.SOURCE_SQL["register_xml_parse"]
    out["cube_scan"] = O.SOURCE_SQL["cube_flatten"]
    out["upsert_bucketed"] = O.CHANGE_SQL["upsert_preserve"]
    out["feed_xml_scan"] = O.CHANGE_SQL["feed_first_entries"]
    out["population_reload"] = O.with_ctes(
        "SELECT t.year, t.age_band, t.county, t.sex, t.ethnicity, "
        "CASE WHEN u.year IS NOT NULL THEN CAST(u.population AS BIGINT) ELSE t.population END AS population, "
        f"CASE WHEN u.year IS NOT NULL THEN {O.FEED_TS} ELSE t.loaded_at END AS loaded_at "
        "FROM b_population t FULL OUTER JOIN b_population u ON t.year = u.year AND t.age_band = u.age_band "
        "AND t.county = u.county AND t.sex = u.sex AND t.ethnicity = u.ethnicity")
    out["incremental_metrics_observed"] = O.CHANGE_SQL["incremental_run_metrics"]
    out["upsert_bloom"] = O.CHANGE_SQL["upsert_preserve"]
    out["cube_pieces"] = O.SOURCE_SQL["cube_flatten"]
    out["quality_observed"] = O.QUALITY_SQL["quality_summary"]
    out["schema_evolve_stored"] = O.with_ctes(
        "SELECT entity_id, county, CAST(year(founded_on) AS BIGINT) AS year, "
        "CASE WHEN CAST(entity_id AS BIGINT) % 2 = 0 THEN 'V1' ELSE coalesce(activity_version, 'V1') END AS activity_version, "
        f"CASE WHEN CAST(entity_id AS BIGINT) % 2 = 0 THEN {O.LOADED} ELSE loaded_at END AS loaded_at FROM b_register")
    out["quarantine_payloads"] = """
SELECT 'register' AS source, CASE WHEN o_orderkey % 13 = 5 THEN 'without key' WHEN o_orderkey % 11 = 4 THEN 'malformed'
  ELSE 'good' END AS outcome, count(*) AS n FROM orders GROUP BY ALL
UNION ALL
SELECT 'feed', CASE WHEN page % 5 = 2 THEN 'malformed' ELSE 'good' END, count(*)
FROM (SELECT DISTINCT event_id // 50 AS page FROM events) GROUP BY ALL"""
    out["upsert_recorded_layout"] = O.CHANGE_SQL["upsert_preserve"]
    out["stream_keyed_ledger"] = O.CHANGE_SQL["incremental_ledger"]
    out["stream_compacted"] = O.CHANGE_SQL["incremental_register"]
    # pages are runs of event ids here, and page texts hold whole seconds
    out["stream_feed_files"] = O.with_change(f"""
SELECT * FROM b_ledger
UNION ALL
SELECT entity_id, {O.FEED_TS} AS first_seen_at, date_trunc('second', entry_at) AS source_entry_at,
       ruling_no AS source_ruling_no
FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY position) AS nth FROM b_feed
      WHERE entry_type = '{O.D.first_entry_type}') f
WHERE nth = 1 AND NOT EXISTS (SELECT 1 FROM b_ledger l WHERE l.entity_id = f.entity_id)
  AND entity_id IN (SELECT entity_id FROM det_n)""")
    out["stream_first_seen"] = O.CHANGE_SQL["incremental_ledger"]
    out["stream_replay_idempotent"] = O.CHANGE_SQL["incremental_ledger"]
    out["stream_register"] = O.CHANGE_SQL["incremental_register"]
    out["stream_daily_counts"] = O.with_ctes(
        "SELECT date_trunc('day', ts) AS day, event_type, CAST(count(*) AS BIGINT) AS n "
        "FROM events GROUP BY 1, 2")
    return out
