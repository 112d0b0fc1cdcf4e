"""Declarative data-quality checks (not_null, unique, accepted values,
relationships, unique combinations, expressions, singular queries).

``failing_rows`` returns the offending rows of one check; ``summary``
evaluates many checks at once.  Row-level checks on the same table
(not_null, accepted, expression) are fused into a single aggregation with
one ``count_if`` per check, so each table is scanned once for all of them;
key checks (unique, combinations, relationships) are one grouped aggregate
or anti join each, except that all single-column uniqueness checks of a table
share one shuffle.  All results are unioned into one plan.  ``failing_frame``
gives the failing rows of many checks with the same sharing of scans.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROW_LEVEL = ("not_null", "accepted", "expression", "singular")


@dataclass(frozen=True)
class Check:
    name: str
    table: str
    kind: str                     # not_null|unique|accepted|relationship|unique_combo|expression|singular
    columns: tuple[str, ...] = ()
    values: tuple = ()
    expr: str | None = None       # expression: must be TRUE (NULL passes); singular: rows to report
    ref_table: str | None = None
    ref_column: str | None = None


def _fails(check: Check) -> Column:
    """Row predicate that marks a failing row of a row-level check."""
    if check.kind == "not_null":
        return F.col(check.columns[0]).isNull()
    if check.kind == "accepted":
        c = F.col(check.columns[0])
        return c.isNotNull() & ~c.isin(list(check.values))
    if check.kind == "expression":
        return F.coalesce(~F.expr(check.expr), F.lit(False))
    if check.kind == "singular":
        return F.coalesce(F.expr(check.expr), F.lit(False))
    raise ValueError(check.kind)


def failing_rows(tables: dict[str, DataFrame], check: Check) -> DataFrame:
    df = tables[check.table]
    if check.kind in ROW_LEVEL:
        return df.filter(_fails(check))
    if check.kind == "unique":
        c = check.columns[0]
        return (df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n_records"))
                .filter(F.col("n_records") > 1))
    if check.kind == "unique_combo":
        return (df.groupBy(*check.columns).agg(F.count(F.lit(1)).alias("n_records"))
                .filter(F.col("n_records") > 1))
    if check.kind == "relationship":
        c = check.columns[0]
        parent = tables[check.ref_table].select(F.col(check.ref_column).alias("_ref")).distinct()
        child = df.filter(F.col(c).isNotNull())
        return child.join(parent, child[c] == parent._ref, "left_anti")
    raise ValueError(check.kind)


def summary(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """(check_name, kind, table_name, failures, status) for every check."""
    def tag(ch: Check, failures: Column) -> list[Column]:
        return [F.lit(ch.name).alias("check_name"), F.lit(ch.kind).alias("kind"),
                F.lit(ch.table).alias("table_name"), failures.cast("long").alias("failures")]

    def stacked(agg: DataFrame, chs: list[Check]) -> DataFrame:
        stack = F.explode(F.array(*[F.struct(*tag(ch, F.col(f"_c{i}"))) for i, ch in enumerate(chs)]))
        return agg.select(stack.alias("_s")).select("_s.*")

    parts = []
    by_table = defaultdict(list)
    unique_by_table = defaultdict(list)
    for ch in checks:
        if ch.kind in ROW_LEVEL:
            by_table[ch.table].append(ch)
        elif ch.kind == "unique":
            unique_by_table[ch.table].append(ch)
        else:
            parts.append(failing_rows(tables, ch).agg(F.count(F.lit(1)).alias("_n"))
                         .select(*tag(ch, F.col("_n"))))
    for tname, chs in unique_by_table.items():
        # all single-column uniqueness checks of a table in one shuffle:
        # (check, value) pairs -> count per pair -> duplicated values per check
        pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("_i"),
                                             F.col(ch.columns[0]).cast("string").alias("_v"))
                                    for i, ch in enumerate(chs)]))
        dup = (tables[tname].select(pairs.alias("_p")).select("_p.*").filter(F.col("_v").isNotNull())
               .groupBy("_i", "_v").agg(F.count(F.lit(1)).alias("_n")))
        agg = dup.agg(*[F.count_if((F.col("_i") == i) & (F.col("_n") > 1)).alias(f"_c{i}")
                        for i in range(len(chs))])
        parts.append(stacked(agg, chs))
    for tname, chs in by_table.items():
        # one pass over the table for all its row-level checks
        agg = tables[tname].agg(*[F.count_if(_fails(ch)).alias(f"_c{i}") for i, ch in enumerate(chs)])
        parts.append(stacked(agg, chs))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", F.when(F.col("failures") > 0, "fail").otherwise("pass"))


def failing_frame(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """(check_name, row_json) for every failing row of the given checks, one plan.

    The row-level checks of a table share one scan: each row is given the
    names of the checks it fails, is rendered once and comes out once for each
    of them; a row that passes them all is not rendered.  A key check is one
    aggregation or anti join.
    """
    by_table = defaultdict(list)
    parts = []
    row = F.to_json(F.struct("*"))
    for ch in checks:
        if ch.kind in ROW_LEVEL:
            by_table[ch.table].append(ch)
        else:
            parts.append(failing_rows(tables, ch).select(F.lit(ch.name).alias("check_name"), row.alias("row_json")))
    for name, chs in by_table.items():
        failed = F.array_compact(F.array(*[F.when(_fails(ch), F.lit(ch.name)) for ch in chs]))
        rendered = tables[name].select(failed.alias("_failed"), F.when(F.size(failed) > 0, row).alias("row_json"))
        parts.append(rendered.select(F.explode("_failed").alias("check_name"), "row_json"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def row_counters(checks: list[Check]) -> dict[str, Column]:
    """Counters of failing rows for the row-level checks, to be taken while the
    checked table is written (see :func:`pulse.sources.tables.observed_write`)."""
    return {ch.name: F.count_if(_fails(ch)) for ch in checks if ch.kind in ROW_LEVEL}


def counted_summary(spark: SparkSession, checks: list[Check], failures: dict[str, int]) -> DataFrame:
    """The rows of :func:`summary` for checks whose failures are known (one row per check)."""
    rows = [(ch.name, ch.kind, ch.table, int(failures[ch.name]), "fail" if failures[ch.name] else "pass")
            for ch in checks if ch.name in failures]
    return spark.createDataFrame(rows, "check_name string, kind string, table_name string, failures long, status string")
