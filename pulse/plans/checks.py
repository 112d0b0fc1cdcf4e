"""The declared quality checks of the registry marts (57) and their tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame

from pulse.domain import BOUND
from pulse.operators.quality import ROW_LEVEL, Check, counted_summary, failing_frame, row_counters, summary
from pulse.plans import marts as M
from pulse.sources.tables import observed_write


def _nn(table, *cols):
    return [Check(f"not_null__{table}__{c}", table, "not_null", (c,)) for c in cols]


def _uq(table, *cols):
    return [Check(f"unique__{table}__{c}", table, "unique", (c,)) for c in cols]


def declared_checks(domain=BOUND) -> list[Check]:
    groups = tuple(domain.legal_group_labels)
    c: list[Check] = []
    # sources
    c += _nn("population", "population")
    c += [Check("expression__population__population_ge_0", "population", "expression",
                ("population",), expr="population >= 0")]
    c += _uq("register", "entity_id") + _nn("register", "entity_id")
    # intermediate layer
    c += _nn("register_std", "entity_id") + _uq("register_std", "entity_id")
    c += _nn("register_std", "legal_group")
    c += [Check("accepted__register_std__legal_group", "register_std", "accepted", ("legal_group",), groups),
          Check("relationship__register_std__activity_code_std", "register_std", "relationship",
                ("activity_code_std",), ref_table="closure", ref_column="code")]
    c += _nn("register_std", "in_last_6")
    c += [Check("accepted__register_std__in_last_6", "register_std", "accepted", ("in_last_6",), (0, 1))]
    c += _nn("closure", "code") + _uq("closure", "code")
    c += _nn("closure", "code_label", "root_code", "root_label")
    for col in ("county_id", "county", "map_code"):
        c += _nn("county_dimension", col) + _uq("county_dimension", col)
    c += _nn("county_dimension", "region", "display_order") + _uq("county_dimension", "display_order")
    c += _nn("entity_counts", "rolling_year", "county", "sector_label", "in_last_6")
    c += [Check("accepted__entity_counts__in_last_6", "entity_counts", "accepted", ("in_last_6",), (0, 1))]
    c += _nn("entity_counts", "entity_count")
    # marts
    c += [Check("unique_combo__rate_per_1000", "rate_per_1000", "unique_combo",
                ("year", "county", "sector_label"))]
    c += _nn("rate_per_1000", "year", "county", "sector_label", "working_age_pop", "entity_count")
    c += [Check("unique_combo__rate_geo", "rate_geo", "unique_combo", ("year", "county", "sector_label"))]
    c += _nn("rate_geo", "year", "county", "map_code", "working_age_pop", "entity_count", "per_1000",
             "sector_label")
    c += [Check("unique_combo__new_by_activity", "new_by_activity", "unique_combo",
                ("legal_group", "county", "root_code"))]
    c += _nn("new_by_activity", "legal_group")
    c += [Check("accepted__new_by_activity__legal_group", "new_by_activity", "accepted",
                ("legal_group",), groups)]
    c += _nn("new_by_activity", "county", "root_code", "sector_label", "entity_count")
    c += [Check("unique_combo__portfolio_shift", "portfolio_shift", "unique_combo",
                ("county", "sector_label"))]
    c += _nn("portfolio_shift", "county", "sector_label", "entity_count_current")
    # singular query
    c += [Check("singular__population_clean__negative", "population_clean", "singular",
                expr="population < 0")]
    return c


# Checked tables in dependency order: each level reads only stored results of
# earlier levels, so no mart is derived twice.
TABLE_LEVELS = (
    {"population": lambda r, t: r.population, "register": lambda r, t: r.register,
     "register_std": lambda r, t: M.register_std(r), "closure": lambda r, t: r.closure,
     "county_dimension": lambda r, t: M.county_dimension(r),
     "population_clean": lambda r, t: M.population_clean(r),
     "entity_counts": lambda r, t: M.entity_counts(r),
     "new_by_activity": lambda r, t: M.new_by_activity(r)},
    {"rate_per_1000": lambda r, t: M.rate_per_1000(r, t["entity_counts"]),
     "portfolio_shift": lambda r, t: M.portfolio_shift(r, t["entity_counts"])},
    {"rate_geo": lambda r, t: M.rate_geo(r, t["rate_per_1000"])},
)
NEEDS = {"rate_per_1000": {"entity_counts"}, "portfolio_shift": {"entity_counts"},
         "rate_geo": {"rate_per_1000", "entity_counts"}}


def registry_tables(reg: M.Registry, checks: list[Check] | None = None,
                    materialize: bool = True, published: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The tables the given checks read.  ``published`` ones are checked as
    they are.  With ``materialize`` each other one is computed once and
    checkpointed to the shared checkpoint folder (the tables of one level
    concurrently), so the checks scan stored tables instead of re-deriving
    the marts per check."""
    wanted = {n for lv in TABLE_LEVELS for n in lv} if checks is None else (
        {c.table for c in checks} | {c.ref_table for c in checks if c.ref_table})
    tables: dict[str, DataFrame] = dict(published or {})
    wanted |= {d for n in wanted - set(tables) for d in NEEDS.get(n, ())}
    if wanted - set(tables):
        reg.prepare("closure_side", "resolved_crosswalk", "county_dim")
    for level in TABLE_LEVELS:
        names = [n for n in level if n in wanted and n not in tables]
        frames = {n: level[n](reg, tables) for n in names}
        if materialize and frames:
            with ThreadPoolExecutor(len(frames)) as pool:
                done = pool.map(lambda kv: (kv[0], kv[1].checkpoint(eager=True)), frames.items())
                frames = dict(done)
        tables.update(frames)
    return tables


def kind_summary(reg: M.Registry, kinds: tuple[str, ...]) -> DataFrame:
    checks = [c for c in declared_checks(reg.domain) if c.kind in kinds]
    return summary(registry_tables(reg, checks), checks)


def failures_frame(reg: M.Registry, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """(check_name, row_json) for every failing row of every declared check, one plan.
    ``tables`` reuses already materialised checked tables."""
    return failing_frame(tables if tables is not None else registry_tables(reg), declared_checks(reg.domain))


def publish_checked(reg: M.Registry, out_dir: str, checks: list[Check] | None = None) -> tuple[dict[str, str], DataFrame]:
    """Write the checked tables and take their row-level checks while they are
    written: no table is read again for them.  Key checks then read the written
    tables.  Returns the paths and the summary of all checks."""
    checks = declared_checks(reg.domain) if checks is None else checks
    spark = reg.register.sparkSession
    row_level = [c for c in checks if c.kind in ROW_LEVEL]
    wanted = {c.table for c in checks} | {c.ref_table for c in checks if c.ref_table}
    wanted |= {d for n in wanted for d in NEEDS.get(n, ())}
    reg.prepare("closure_side", "resolved_crosswalk", "county_dim")
    paths: dict[str, str] = {}
    stored: dict[str, DataFrame] = {}
    failures: dict[str, int] = {}
    for level in TABLE_LEVELS:
        for name in (n for n in level if n in wanted):
            path = f"{out_dir.rstrip('/')}/{name}"
            counters = row_counters([c for c in row_level if c.table == name])
            failures |= observed_write(level[name](reg, stored), path, counters)
            paths[name], stored[name] = path, spark.read.parquet(path)
    found = counted_summary(spark, row_level, failures)
    keyed = [c for c in checks if c.kind not in ROW_LEVEL]
    return paths, found.unionByName(summary(stored, keyed)) if keyed else found
