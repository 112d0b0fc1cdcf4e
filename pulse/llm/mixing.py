"""Mixing sources to target weights by subset-sum budget fitting.

Every source's target is its weight's share of all words, stopped at
``max_epochs`` times the source's size; the excess is shared again by weight
among the other sources.  A source takes whole passes over its documents as
often as they fit, and fits the remaining budget with a subset: documents are
counted by exact length, every length gives its proportional part first, then
the lengths with the largest remainders, and a bounded knapsack over what is
left of each length closes the last gap, which is shorter than four of the
longest documents.  The tables handled per source have one row per
distinct length, never one per document.  Which documents of a length are
taken follows a seeded hash, so reruns agree.

Null and blank texts have size 0 and take nothing.  A null source is a source
of its own, ordered last.  Rows that repeat an id count each; which of several
equal rows is taken does not show.  An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulse.llm.common import save, ship, spread_join, words
from pulse.operators.ids import dense_surrogate_id

ship(__name__)

#: Seeded hash ranges per length; only the range where the count ends is ranked row by row.
RANGES = 4096


def source_targets(sizes: DataFrame, weights=(1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """(source, source_size, target) from (source, source_size); weights repeat
    over the sources in code point order, null last."""
    ordered = dense_surrogate_id(sizes.withColumn("_null", F.col("source").isNull()),
                                 ["_null", "source"], "_at", start=0)
    cycle = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                         (F.col("_at") % len(weights) + 1).cast("int"))
    listed = save(ordered.select("source", "source_size", cycle.alias("w"),
                                 (F.col("source_size") * max_epochs).alias("cap")), "sources")
    level = 0.0
    total = listed.agg(F.sum("source_size")).first()[0] or 0
    # a source that has reached its cap at a lower level stays there, so the level only rises
    while total:
        full = F.col("w") * F.lit(level) >= F.col("cap")
        capped, open_weight = listed.agg(F.sum(F.when(full, F.col("cap")).otherwise(0)),
                                         F.sum(F.when(full, 0.0).otherwise(F.col("w")))).first()
        if not open_weight:
            break
        new = (total - capped) / open_weight
        if new <= level:
            break
        level = new
    return listed.select("source", "source_size",
                         F.least(F.col("w") * F.lit(level), F.col("cap").cast("double")).alias("target"))


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that their words come close
    to ``budget`` (0 <= budget < sum): from below up to half of all words, and
    beyond that from above, by fitting what is left out.

    Proportional part, then largest remainders that fit, then an exact
    bounded knapsack over the documents left.
    """
    take = np.zeros(len(lengths), np.int64)
    total = int(sum(int(a) * int(b) for a, b in zip(lengths, counts)))
    if total == 0 or budget <= 0:
        return take
    if 2 * budget > total:
        return counts - fit(lengths, counts, total - budget)
    share = budget / total
    take = np.minimum(np.floor(counts * share).astype(np.int64), counts)
    rest = budget - int(sum(int(a) * int(b) for a, b in zip(lengths, take)))
    while rest < 0:  # rounding of the share may overshoot by a few documents
        k = int(np.argmax(take * lengths > 0))
        take[k] -= 1
        rest += int(lengths[k])
    longest = int(lengths.max())
    mixed = (lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
    for k in np.lexsort((mixed, -(counts * share - take))):  # equal remainders in an order free of length
        if rest < 4 * longest:  # the gap is left to the knapsack while documents of every size remain
            break
        if take[k] < counts[k]:
            take[k] += 1
            rest -= int(lengths[k])
    if rest == 0:
        return take
    # first[s]: the step that first reaches the sum s; memory is bounded by the gap, not by the steps
    first = np.full(rest + 1, -1, np.int32)
    first[0], steps = 0, [(0, 0)]
    for k in np.lexsort((mixed,)):
        size, left, part = int(lengths[k]), int(counts[k] - take[k]), 1
        if not 0 < size <= rest:
            continue
        left = min(left, rest // size)
        while left > 0 and size * part <= rest:  # binary splitting of the count
            part = min(part, left)
            reached = np.nonzero((first[:rest + 1 - size * part] >= 0) & (first[size * part:] < 0))[0]
            steps.append((int(k), part))
            first[reached + size * part] = len(steps) - 1
            left -= part
            part *= 2
        if first[rest] >= 0:
            break
    at = int(np.nonzero(first >= 0)[0][-1])
    while at:
        k, part = steps[first[at]]
        take[k] += part
        at -= part * int(lengths[k])
    return take


def _fit_source(frame: pd.DataFrame) -> pd.DataFrame:
    size, target = int(frame["source_size"].iloc[0]), float(frame["target"].iloc[0])
    budget = int(round(target))
    passes = budget // size if size else 0
    frame = frame.sort_values("size")
    lengths, counts = frame["size"].to_numpy(np.int64), frame["n"].to_numpy(np.int64)
    return pd.DataFrame({"source": frame["source"].to_numpy(), "size": lengths, "passes": passes,
                         "subset": fit(lengths, counts, budget - passes * size)})


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=(1, 2, 3), max_epochs: int = 3, seed: int = 42, keep: tuple[Column, ...] = ()) -> DataFrame:
    """One row per input row: id, size, source, source_size, target, copies
    (how often the mix takes the document) and the columns of ``keep``."""
    order = F.xxhash64(F.lit(seed), F.col(id_col), F.xxhash64(F.col(text_col)))
    sized = save(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                             F.size(words(F.col(text_col))).cast("long").alias("size"), order.alias("o"), *keep)
                 .withColumn("part", F.shiftrightunsigned(F.col("o"), 52)), "sizes")
    parts = save(sized.groupBy("source", "size", "part").agg(F.count(F.lit(1)).alias("n")), "lengths")
    by_length = parts.groupBy("source", "size").agg(F.sum("n").alias("n"))
    totals = by_length.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = save(source_targets(totals, weights, max_epochs), "targets")
    plan = (by_length.join(targets, by_length["source"].eqNullSafe(targets["source"]))
            .select(by_length["source"], "size", "n", "source_size", "target")
            .groupBy("source").applyInPandas(_fit_source, "source string, size long, passes long, subset long"))
    plan = save(plan, "plan")
    before = F.coalesce(F.sum("n").over(Window.partitionBy("source", "size").orderBy("part")
                                        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranged = parts.withColumn("before", before)
    ranged = (ranged.join(plan, ranged["source"].eqNullSafe(plan["source"]) & (ranged["size"] == plan["size"]))
              .select(ranged["source"], ranged["size"], "part", "passes",
                      F.least(F.greatest(F.col("subset") - F.col("before"), F.lit(0)), F.col("n")).alias("quota"), "n"))
    # a range is taken whole, not at all, or (one per length) up to a rank within it
    joined = sized.alias("d").join(
        ranged.alias("r"), F.col("d.source").eqNullSafe(F.col("r.source"))
        & (F.col("d.size") == F.col("r.size")) & (F.col("d.part") == F.col("r.part")))
    joined = joined.select("d.*", "r.passes", "r.quota", "r.n")
    whole = joined.filter("quota = n or quota = 0").withColumn("extra", (F.col("quota") > 0).cast("long"))
    rank = F.row_number().over(Window.partitionBy("source", "size", "part").orderBy("o", "id"))
    split = joined.filter("quota > 0 and quota < n").withColumn("extra", (rank <= F.col("quota")).cast("long"))
    chosen = whole.unionByName(split)
    return (spread_join(chosen, targets, F.col("r.source").eqNullSafe(F.col("g.source")))
            .select("r.*", "g.source_size", "g.target")
            .withColumn("copies", F.when(F.col("size") == 0, F.lit(0)).otherwise(F.col("passes") + F.col("extra")))
            .drop("o", "part", "passes", "quota", "n", "extra", "_salt"))


def op6_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs).select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                            (F.col("size") * F.col("copies")).alias("taken"))
