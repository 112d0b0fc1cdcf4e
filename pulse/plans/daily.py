"""The daily run in order: incremental load, mart build, data-quality checks.

The original scheduled three jobs (daily increment at 03:30, transformation
and tests at 05:00).  Here they are one plain function; each step writes
tables under ``out_dir`` and the next step reads what the previous wrote.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame

from pulse.plans import incremental as I
from pulse.plans import marts as M
from pulse.plans.build import build_marts
from pulse.plans.checks import declared_checks, failures_frame, registry_tables
from pulse.operators.quality import summary
from pulse.sources.tables import write_table


def run_all(reg: M.Registry, ledger: DataFrame, feed: DataFrame, details: DataFrame,
            out_dir: str, run_ts: dt.datetime) -> dict[str, str]:
    """Returns the paths written: register, ledger, metrics, every mart, quality."""
    spark = reg.register.sparkSession
    base = out_dir.rstrip("/")
    paths: dict[str, str] = {}

    run = I.run(reg.register, ledger, feed, details, run_ts, reg.domain)
    for name, df in (("register", run.register), ("ledger", run.ledger),
                     ("load_metrics", run.metrics())):
        write_table(df, f"{base}/staging/{name}")
        paths[name] = f"{base}/staging/{name}"

    # marts are built from the freshly written register snapshot
    fresh = replace(reg, register=spark.read.parquet(paths["register"]), cached=[])
    for name, path in build_marts(fresh, f"{base}/marts", release=False).items():
        paths[name] = path

    # the checks read what was published; the population input and the
    # standardised register (a view over the written register) are not copied
    checks = declared_checks(fresh.domain)
    stored = {name: spark.read.parquet(paths[key]) for name, key in (
        ("register", "register"), ("closure", "hierarchy_closure"), ("county_dimension", "county_dimension"),
        ("population_clean", "population_clean"), ("entity_counts", "entity_counts"),
        ("new_by_activity", "new_by_activity"), ("rate_per_1000", "rate_per_1000"),
        ("portfolio_shift", "portfolio_shift"), ("rate_geo", "rate_geo"))}
    checked = registry_tables(fresh, checks, published={
        **stored, "population": fresh.population, "register_std": M.register_std(fresh)})
    write_table(summary(checked, checks), f"{base}/quality/summary")
    failures_frame(fresh, checked).write.mode("overwrite").partitionBy("check_name").parquet(
        f"{base}/quality/failures")
    paths["quality_summary"] = f"{base}/quality/summary"
    paths["quality_failures"] = f"{base}/quality/failures"
    fresh.release()
    return paths
