"""Benchmark decontamination by SimHash item-sized windows.

Texts are lower-cased and split at everything but letters and digits; five
consecutive words make a shingle (an item of fewer words is one shingle of
its own length, compared with document shingles of that length).  A window is
a run of as many shingles as the item has, cut at the document's ends.  Every
item and every window gets a 64-bit SimHash over its shingles, repeats
included.  Windows and items of the same size meet in a multi-index over blocks
of the fingerprint: two that differ in at most ``RADIUS`` bits differ in at
most ``NEAR`` bits in one of ``RADIUS // (NEAR + 1) + 1`` blocks, so items
are listed under every block value within that and no pair within the radius
is missed.  With four blocks of 16 bits about one unrelated pair in 25 meets.
Pairs within the radius are verified by exact weighted shingle similarity
(sum of the smaller counts over sum of the larger counts) of at least
``SIMILARITY``.  At just that similarity fingerprints differ in about ten bits
and in more than ``RADIUS`` in a few of a hundred cases, above it more rarely.

Every window start is judged.  A window as similar as that holds at least
``SIMILARITY / (1 + SIMILARITY)`` times the sum of both sizes in shingles that
the item has too, in whatever order, so windows with fewer shingles of items
of their size are left out and none is lost; the number per window is a
running count over the document's shared positions.  The item shingles are
joined to the documents' by broadcast if they number at most ``BROADCAST``,
by shuffle otherwise.  The texts of documents with windows are then read again;
a Bloom filter of these documents keeps all other texts where they are.

Results: one row per document and item, with the best window.  Null and blank
texts and items have no shingles and match nothing; rows that repeat a
document or an item are reported once; empty tables give an empty result.
Ids may repeat with other texts and may be null.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulse.llm.common import let, positions, save, split_listed, spread_join, whole_rows

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 15
BITS = 64
#: Bits in which a block of two near fingerprints may differ.
NEAR = 3
BROADCAST = 500_000
APART = r"[^\p{L}\p{N}]+"


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), APART, -1), lambda w: w != "")


def _shingles(text: Column, size: int) -> Column:
    """Shingle hashes in text order."""
    def hashed(h: Column) -> Column:
        return F.transform(positions(F.size(h) - (size - 1)),
                           lambda i: F.xxhash64(F.lit(size), *[F.get(h, i + k) for k in range(size)]))

    return let(F.transform(_words(text), lambda w: F.xxhash64(w)), hashed)


def _simhash(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per keys: fp over the rows' column h, repeats included."""
    n = F.count(F.lit(1))
    ones = [F.sum(F.shiftrightunsigned(F.col("h"), b).bitwiseAND(F.lit(1))) for b in range(BITS)]
    fp = F.lit(0).cast("long")
    for b in range(BITS):
        fp = fp.bitwiseOR(F.when(2 * F.col(f"b{b}") > F.col("n"),
                                 F.lit((1 << b) - ((1 << 64) if b == 63 else 0)).cast("long")).otherwise(F.lit(0)))
    return (rows.groupBy(*keys).agg(n.alias("n"), *[x.alias(f"b{b}") for b, x in enumerate(ones)])
            .select(*keys, "n", fp.alias("fp")))


def _block_count(radius: int) -> int:
    """Blocks of which one differs in at most ``NEAR`` bits if the fingerprints differ in at most ``radius``."""
    return radius // (NEAR + 1) + 1


def _blocks(radius: int) -> Column:
    """The fingerprint's blocks."""
    n = _block_count(radius)
    cuts = [i * BITS // n for i in range(n + 1)]
    return F.array(*[F.shiftrightunsigned(F.col("fp"), lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1))
                     for lo, hi in zip(cuts, cuts[1:])])


def _masks(radius: int) -> list[int]:
    width = -(-BITS // _block_count(radius))
    return [sum(1 << b for b in flips) for k in range(radius // _block_count(radius) + 1)
            for flips in itertools.combinations(range(width), k)]


def _neighbours(radius: int) -> Column:
    """Every value within NEAR bits of the block value ``bits``, which has the block's width at most."""
    return F.transform(F.lit(_masks(radius)), lambda m: F.col("bits").bitwiseXOR(m.cast("long")))


def _near(windows: DataFrame, items: DataFrame, key: list[str], radius: int) -> DataFrame:
    """(key, cut, item) for the windows (key, cut, fp) and items (item, length, fp) of one length within the radius.

    Only distinct fingerprints meet, so a passage that many documents hold is
    one row.  The index (2,788 rows an item) is joined by shuffle: a broadcast
    of it would be held whole by the driver."""
    seen = windows.select("length", "fp").distinct().select(
        "length", "fp", F.posexplode(_blocks(radius)).alias("block", "bits"))
    index = (items.select("length", "fp").distinct()
             .select("length", F.col("fp").alias("ifp"), F.posexplode(_blocks(radius)).alias("block", "bits"))
             .withColumn("bits", F.explode(_neighbours(radius))))
    pairs = (seen.join(index.hint("merge"), ["length", "block", "bits"])
             .filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("ifp"))) <= radius)
             .select("length", "fp", "ifp").distinct()
             .join(items.select("item", "length", F.col("fp").alias("ifp")), ["length", "ifp"])
             .select("length", "fp", "item"))
    met = spread_join(windows, pairs, (F.col("r.length") == F.col("g.length")) & (F.col("r.fp") == F.col("g.fp")), salts=8)
    return met.select(*[f"r.{c}" for c in (*key, "cut")], "g.item")


def _windows(hits: DataFrame, similarity: float) -> DataFrame:
    """(doc, length, start) of every window with enough shared positions for the similarity."""
    pos, length, start = F.col("pos"), F.col("length"), F.col("start")
    shared = (hits.groupBy("doc", "n", "length").agg(F.collect_set("pos").alias("ps"))
              .filter(F.size("ps") >= similarity * length - 1e-9))
    # a position is in the windows that start in (pos - length, pos]
    steps = (shared.select("doc", "n", "length", F.explode("ps").alias("pos"))
             .select("doc", "n", "length", F.explode(F.array(
                 F.struct((pos - length + 1).alias("at"), F.lit(1).alias("d")),
                 F.struct((pos + 1).alias("at"), F.lit(-1).alias("d")))).alias("e"))
             .groupBy("doc", "n", "length", "e.at").agg(F.sum("e.d").alias("d")))
    order = Window.partitionBy("doc", "n", "length").orderBy("at")
    runs = steps.select("doc", "n", "length", "at", F.lead("at").over(order).alias("upto"), F.sum("d").over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("held"))
    starts = runs.filter(F.col("held") >= F.greatest(similarity * length - 1e-9, F.lit(1))).select(
        "doc", "n", "length", "held", F.explode(F.sequence("at", F.col("upto") - 1)).alias("start"))
    cut = F.least(start + length, F.col("n")) - F.greatest(start, F.lit(0))
    return (starts.filter(F.col("held") * (1 + similarity) >= similarity * (cut + length) - 1e-9)
            .select("doc", "length", "start"))


def _matches(texts: DataFrame, items: DataFrame, size: int, similarity: float, radius: int) -> DataFrame:
    """(doc_id, item_id, ...) for the items whose shingles have ``size`` words."""
    placed = save(items.select("item", "item_id", F.posexplode(_shingles(F.col("text"), size)).alias("off", "h")),
                  "item-shingles")
    lengths = placed.groupBy("item").agg(F.count(F.lit(1)).cast("int").alias("length"))
    known = placed.join(lengths, "item").select("h", "length").distinct()
    seen = (texts.select("doc", _shingles(F.col("text"), size).alias("hs"))
            .select("doc", F.size("hs").alias("n"), F.posexplode("hs").alias("pos", "h")))
    hits = seen.join(F.broadcast(known) if placed.count() <= BROADCAST else known, "h")
    windows = save(_windows(hits, similarity), "windows")

    own = save(windows.groupBy("doc").agg(F.collect_set(F.struct("start", "length")).alias("spans")), "window-spans")
    # only texts that may have a window are moved to it
    near, _ = split_listed(texts, own, ["doc"])
    # rows that repeat a document would count its shingles twice
    full = (near.join(own, "doc").dropDuplicates(["doc"])
            .select("doc", "spans", _shingles(F.col("text"), size).alias("hs")))
    cut = full.select("doc", "hs", F.explode("spans").alias("w")).select(
        "doc", "w.start", "w.length", F.explode(F.slice(
            "hs", F.greatest(F.col("w.start"), F.lit(0)) + 1,
            F.greatest(F.col("w.start") + F.col("w.length") - F.greatest(F.col("w.start"), F.lit(0)), F.lit(0)))).alias("h"))
    key = ["doc", "start", "length"]
    cut = save(cut.groupBy(*key, "h").agg(F.count(F.lit(1)).alias("c")), "window-shingles")
    # stored, so that the driver never plans these wide aggregates together
    window_fp = save(_simhash(cut.withColumn("h", F.explode(F.array_repeat("h", F.col("c").cast("int")))), key)
                     .withColumnRenamed("n", "cut"), "window-fingerprints")
    item_fp = save(_simhash(placed, ["item"]).select("item", F.col("n").cast("int").alias("length"), "fp"),
                   "item-fingerprints")
    near = save(_near(window_fp, item_fp, key, radius), "near-windows")
    counts = placed.groupBy("item", "h").agg(F.count(F.lit(1)).alias("ic"))
    shared = (near.join(cut, key).join(counts, ["item", "h"])
              .groupBy(*key, "cut", "item").agg(F.sum(F.least("c", "ic")).alias("both")))
    score = F.col("both") / (F.col("cut") + F.col("length") - F.col("both"))
    return shared.withColumn("similarity", score).filter(F.col("similarity") >= similarity)


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      item_id_col: str = "item_id", item_text_col: str = "text",
                      similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """(doc, doc_id, item_id, similarity, start, length): the best window per
    document and item.  doc identifies a text: the struct of its id and hash."""
    key = lambda i, t: F.struct(F.col(f"`{i}`").alias("id"), F.xxhash64(F.col(f"`{t}`")).alias("hash"))
    texts = docs.select(key(id_col, text_col).alias("doc"), F.col(f"`{text_col}`").alias("text"))
    items = save(benchmark.select(F.col(f"`{item_id_col}`").alias("item_id"), F.col(f"`{item_text_col}`").alias("text"))
                 .distinct().withColumn("item", F.struct("item_id", F.xxhash64("text").alias("hash")))
                 .withColumn("size", F.least(F.size(_words(F.col("text"))), F.lit(SHINGLE))), "items")
    found = None
    for (size,) in items.select("size").distinct().filter("size > 0").orderBy("size").collect():  # at most SHINGLE
        part = _matches(texts, items.filter(F.col("size") == size), size, similarity, radius)
        found = part if found is None else found.unionByName(part)
    if found is None:
        empty = lambda kind, name: F.lit(None).cast(kind).alias(name)
        found = texts.filter("false").select("doc", empty(items.schema["item"].dataType, "item"),
                                             empty("double", "similarity"), empty("int", "start"),
                                             empty("int", "length"))
    best = found.groupBy("doc", "item").agg(F.max_by(
        F.struct("similarity", "start", "length"), F.struct("similarity", -F.col("start"), "length")).alias("m"))
    return best.select("doc", F.col("doc.id").alias("doc_id"), F.col("item.item_id").alias("item_id"),
                       "m.similarity", F.greatest(F.col("m.start"), F.lit(0)).alias("start"), "m.length")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      **options) -> DataFrame:
    """The input's rows that hold no benchmark passage, with the input's columns."""
    bad = save(benchmark_matches(docs, benchmark, id_col, text_col, **options)
               .select(F.col("doc.id").alias("id"), F.col("doc.hash").alias("hash")).distinct(), "contaminated")
    rows = whole_rows(docs, id=F.col(f"`{id_col}`"), hash=F.xxhash64(F.col(f"`{text_col}`")))
    held, passed = split_listed(rows, bad, ["id", "hash"])
    named = bad.select(F.col("id").alias("bad_id"), F.col("hash").alias("bad_hash"))
    kept = held.join(named, F.col("id").eqNullSafe(F.col("bad_id")) & (F.col("hash") == F.col("bad_hash")), "left_anti")
    return passed.select("row.*").unionByName(kept.select("row.*"))


def op1_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    best = benchmark_matches(docs, items)
    return (best.groupBy("doc_id", "item_id").agg(F.max("similarity").alias("similarity")))


#: Without fingerprints: every diagonal window against every item of its size (items of five words or more).  The query judges
#: the windows between diagonals too, so it can find more than this SQL where an item's parts are reordered.
OP1_SQL = f"""
WITH dw AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS ws FROM documents),
iw AS (SELECT item_id, list_filter(string_split_regex(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS ws FROM benchmark),
ds AS (SELECT doc_id, p - 1 AS pos, array_to_string(ws[p:p + {SHINGLE - 1}], ' ') AS s
       FROM dw, unnest(range(1, len(ws) - {SHINGLE - 2})) AS u(p)),
its AS (SELECT item_id, len(ws) - {SHINGLE - 1} AS length, p - 1 AS off, array_to_string(ws[p:p + {SHINGLE - 1}], ' ') AS s
        FROM iw, unnest(range(1, len(ws) - {SHINGLE - 2})) AS u(p)),
windows AS (SELECT DISTINCT ds.doc_id, ds.pos - its.off AS start, its.length FROM ds JOIN its USING (s)),
cut AS (SELECT w.doc_id, w.start, w.length, ds.s, count(*) AS c FROM windows w JOIN ds
        ON ds.doc_id = w.doc_id AND ds.pos >= w.start AND ds.pos < w.start + w.length GROUP BY ALL),
sizes AS (SELECT doc_id, start, length, sum(c) AS cut FROM cut GROUP BY ALL),
ic AS (SELECT item_id, length, s, count(*) AS c FROM its GROUP BY ALL),
both_ AS (SELECT cut.doc_id, cut.start, cut.length, ic.item_id, sum(least(cut.c, ic.c)) AS n
          FROM cut JOIN ic ON cut.s = ic.s AND cut.length = ic.length GROUP BY ALL)
SELECT doc_id, item_id, max(CAST(n AS DOUBLE) / CAST(cut + length - n AS DOUBLE)) AS similarity
FROM both_ JOIN sizes USING (doc_id, start, length)
WHERE CAST(n AS DOUBLE) / CAST(cut + length - n AS DOUBLE) >= {SIMILARITY} GROUP BY doc_id, item_id
"""
