"""Quality rules with robust multivariate outlier rejection.

Every document gets base counts (words, word characters, symbols, repeated
lines, words in repeated 8-word windows) and a base verdict.  The documents
that pass it get a statistic vector (log word length, log symbol, repeated
line and repeated word rates).  Per language and source a minimum covariance
determinant estimate describes the usual vectors: starting from medians and
quartiles, concentration steps re-estimate mean and covariance from the share
``SUPPORT`` of documents that lie closest, then one reweighting step uses all
documents inside the 97.5 % ellipsoid.  Documents whose squared Mahalanobis
distance exceeds ``cutoff`` are rejected.

All of it is DataFrame work: a group's state is one row, distances and the
Cholesky factor are column expressions, and the closest share is found from
counts of binned distances, so no group is ever gathered.  Vectors are
rounded to thousandths and summed as decimals, which makes the estimates the
same whatever the partitioning.

Two safeguards keep usual text: ``FLOOR`` is the least standard deviation per
statistic (most documents have no repeated line at all, and a spread of zero
would reject the first that has one), and groups of under ``MIN_GROUP``
documents are estimated together per language, then together over all
languages; if even that is too few, only the base rules count.

Null and blank texts have no words and fail the base rules; null languages
and sources form groups of their own; repeated rows are judged alike; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import SPACES, let, positions, save, spread_join, words

WINDOW = 8
MIN_WORDS = 20
SYMBOLS = "#*$%&|<>"
SCALE = 1000
SUPPORT = 0.6
STEPS = 3
MIN_GROUP = 50
#: Least standard deviation of each statistic, in its own (log) units.
FLOOR = (0.1, 0.5, 0.5, 0.5)
#: Upper quantiles of the chi-square distribution with four degrees of freedom: 50 %, 97.5 %, 1 - 1e-9.
CHI_HALF, CHI_TRIM, CHI_CUT = 3.357, 11.143, 47.0
DIM = len(FLOOR)
BINS = 64


def repeated_words(tokens: Column) -> Column:
    """Words covered by windows of ``WINDOW`` words that occur twice or more in the text."""
    def hashed(h: Column) -> Column:
        return F.transform(positions(F.size(h) - (WINDOW - 1)),
                           lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))

    def covered(p: Column) -> Column:
        return F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))),
            F.lit(0), lambda a, x: a + x)

    def repeated(s: Column) -> Column:
        twice = F.filter(s, lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]))
        return let(F.sort_array(F.transform(twice, lambda x: x["i"])), covered)

    def count(g: Column) -> Column:
        ordered = F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(let(ordered, repeated))

    return let(F.transform(tokens, lambda w: F.xxhash64(w)), lambda h: let(hashed(h), count))


def base_counts(docs: DataFrame, text_col: str = "text", carry: tuple[Column, ...] = ()) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    measured = docs.select(
        *carry, let(words(text), lambda w: F.struct(F.size(w).alias("n"), repeated_words(w).alias("r"))).alias("w"),
        F.length(F.translate(text, SPACES, "")).alias("chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).alias("symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).alias("dup"))
    names = measured.columns[:len(carry)]
    out = measured.select(*names, F.col("w.n").cast("long").alias("n_words"),
                          F.col("chars").cast("long").alias("word_chars"),
                          F.col("symbols").cast("long").alias("n_symbols"),
                          F.col("dup").cast("long").alias("n_dup_lines"),
                          F.col("w.r").cast("long").alias("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def _vector() -> list[Column]:
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    rate = lambda c: F.log1p(100.0 * F.col(c) / n)
    raw = [F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n), rate("n_symbols"), rate("n_dup_lines"),
           rate("n_repeat_words")]
    return [F.round(SCALE * x).cast("long").alias(f"q{i}") for i, x in enumerate(raw)]


def _groups(rows: DataFrame) -> DataFrame:
    """(lang, source, level): 2 = own estimate, 1 = with the language's other small sources, 0 = with all that is left."""
    sizes = rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    small = sizes.withColumn("small", F.col("n") < MIN_GROUP)
    per_lang = small.groupBy("lang").agg(F.sum(F.when(F.col("small"), F.col("n"))).alias("rest"))
    joined = small.alias("s").join(per_lang.alias("l"), F.col("s.lang").eqNullSafe(F.col("l.lang")))
    level = F.when(~F.col("small"), 2).when(F.col("rest") >= MIN_GROUP, 1).otherwise(0)
    return joined.select("s.lang", "s.source", level.alias("level"))


def _solve(cov: dict, prefix: str = "l") -> list[Column]:
    """Columns of the Cholesky factor, row by row; each is a plain column before the next uses it."""
    steps = []
    for i in range(DIM):
        for j in range(i + 1):
            value = cov[i, j]
            for k in range(j):
                value = value - F.col(f"{prefix}{i}{k}") * F.col(f"{prefix}{j}{k}")
            value = F.sqrt(F.greatest(value, F.lit(1e-9))) if i == j else value / F.col(f"{prefix}{j}{j}")
            steps.append((f"{prefix}{i}{j}", value))
    return steps


def _factor(sums: DataFrame) -> DataFrame:
    """One row per group: count and sums in, mean m0.. and Cholesky factor l00.. of the covariance out."""
    n = F.col("n").cast("double")
    out = sums.select("g", *[(F.col(f"s{i}").cast("double") / n / SCALE).alias(f"m{i}") for i in range(DIM)],
                      *[(F.col(f"s{i}{j}").cast("double") / n / SCALE / SCALE).alias(f"p{i}{j}")
                        for i in range(DIM) for j in range(i + 1)])
    cov = {(i, j): F.col(f"p{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}") + (F.lit(FLOOR[i] ** 2) if i == j else 0)
           for i in range(DIM) for j in range(i + 1)}
    for name, value in _solve(cov):
        out = out.withColumn(name, value)
    return out.select("g", *[f"m{i}" for i in range(DIM)],
                      *[f"l{i}{j}" for i in range(DIM) for j in range(i + 1)])


def _distance() -> Column:
    """Squared Mahalanobis distance of q0.. from the row's m0.. and l00.., by forward substitution."""
    solved: list[Column] = []
    for i in range(DIM):
        value = F.col(f"q{i}") / float(SCALE) - F.col(f"m{i}")
        for k in range(i):
            value = value - F.col(f"l{i}{k}") * solved[k]
        solved.append(value / F.col(f"l{i}{i}"))
    return sum((y * y for y in solved[1:]), solved[0] * solved[0])


def _bin(d: Column) -> Column:
    return F.floor(BINS * F.log1p(d)).cast("int")


def _sums(rows: DataFrame) -> DataFrame:
    wide = lambda c: c.cast("decimal(38,0)")
    return rows.groupBy("g").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(wide(F.col(f"q{i}"))).alias(f"s{i}") for i in range(DIM)],
        *[F.sum(wide(F.col(f"q{i}") * F.col(f"q{j}"))).alias(f"s{i}{j}")
          for i in range(DIM) for j in range(i + 1)])


def estimates(rows: DataFrame) -> DataFrame:
    """(g, m0.., l00.., scale): the reweighted minimum covariance determinant estimate of every group g of q0..."""
    quart = [F.percentile(f"q{i}", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"t{i}") for i in range(DIM)]
    start = rows.groupBy("g").agg(*quart)
    zero = F.lit(0.0)
    state = start.select(
        "g", *[(F.col(f"t{i}")[1] / SCALE).alias(f"m{i}") for i in range(DIM)],
        *[(F.greatest((F.col(f"t{i}")[2] - F.col(f"t{i}")[0]) / (1.349 * SCALE), F.lit(FLOOR[i])) if i == j else zero)
          .alias(f"l{i}{j}") for i in range(DIM) for j in range(i + 1)])
    for _ in range(STEPS):
        state = save(state, "estimate")
        binned = _near(rows, state).withColumn("b", _bin(_distance()))
        edge = binned.groupBy("g").agg(F.ceil(F.percentile("b", F.lit(SUPPORT))).alias("edge"))
        bounded = save(state.join(edge, "g"), "estimate")
        inside = _near(rows, bounded).filter(_bin(_distance()) <= F.col("edge"))
        state = _factor(_sums(inside))
    state = save(state, "estimate")
    half = (_near(rows, state).groupBy("g").agg(F.percentile(_bin(_distance()), F.lit(0.5)).alias("half")))
    spread = F.greatest((F.exp((F.col("half") + 0.5) / BINS) - 1) / CHI_HALF, F.lit(1.0))
    trimmed = save(state.join(half, "g").withColumn("edge", CHI_TRIM * spread), "estimate")
    inner = _near(rows, trimmed).filter(_distance() <= F.col("edge"))
    return save(_factor(_sums(inner)), "estimate")


def _near(rows: DataFrame, state: DataFrame) -> DataFrame:
    """Every vector with its group's state."""
    both = spread_join(rows, state, F.col("r.g") == F.col("g.g"))
    return both.select("r.*", *[F.col(f"g.{c}") for c in state.columns if c != "g"]).drop("_salt")


def judge(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          cutoff: float = CHI_CUT, carry: tuple[Column, ...] = ()) -> DataFrame:
    """One row per input row: the carried columns, the base counts, base_failed, distance and kept."""
    names = [f"_c{i}" for i in range(len(carry))]
    rows = save(base_counts(docs, text_col, (F.col(f"`{lang_col}`").alias("lang"),
                                             F.col(f"`{source_col}`").alias("source"),
                                             *[c.alias(n) for c, n in zip(carry, names)]))
                .select("*", *_vector()), "counts")
    passed = rows.filter(~F.col("base_failed"))
    groups = save(_groups(passed), "groups")
    g = (F.when(F.col("level") == 2, F.struct(F.lit(2).alias("level"), F.col("g.lang"), F.col("g.source")))
         .when(F.col("level") == 1, F.struct(F.lit(1).alias("level"), F.col("g.lang"),
                                            F.lit(None).cast("string").alias("source")))
         .otherwise(F.struct(F.lit(0).alias("level"), F.lit(None).cast("string").alias("lang"),
                             F.lit(None).cast("string").alias("source"))))
    own = spread_join(rows, groups, F.col("r.lang").eqNullSafe(F.col("g.lang"))
                      & F.col("r.source").eqNullSafe(F.col("g.source")), "left")
    own = own.select("r.*", F.to_json(F.when(~F.col("base_failed"), g), {"ignoreNullFields": "false"}).alias("g"))
    vectors = save(own.filter("g is not null").select("g", *[f"q{i}" for i in range(DIM)]), "vectors")
    known = estimates(vectors)
    sizes = vectors.groupBy("g").agg(F.count(F.lit(1)).alias("members"))
    usable = save(known.join(sizes, "g").filter(F.col("members") >= MIN_GROUP).drop("members"), "estimate")
    met = spread_join(own.drop("_salt"), usable, F.col("r.g") == F.col("g.g"), "left")
    judged = met.select("r.*", *[F.col(f"g.{c}") for c in usable.columns if c != "g"]).withColumn(
        "distance", _distance())
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True))
    return judged.select(*[F.col(n) for n in names], "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "distance", kept.alias("kept"))


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The input's rows that the rules keep, with the input's columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return judge(docs, carry=(row,), **options).filter("kept").select(
        *[F.col(f"_c0.`{c}`") for c in docs.columns])


def op4_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    judged = judge(docs, carry=(F.col("doc_id"),))
    return judged.select(F.col("_c0").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept")
