"""SimHash near-duplicate groups with pigeonring candidate filtering.

Fingerprint: lower-case A-Z, words, word shingles with repeats; bit b is set
if it is set in more than half of the shingles' XXH64 values (seed 42).  A
text without words has fingerprint zero.

Links: fingerprints at ``max_bits`` (t) or fewer differing bits.  The 64 bits
are cut into m = 2t+1 consecutive segments on a ring.  By the pigeonring
principle a pair within t bits has a start segment from which every chain of
l segments differs in at most l*t/m bits.  For the first chains that bound is
below one, so those segments are equal: they are the join key of the start
segment.  Inside a bucket the longer chains prune pairs before the full
Hamming count.

Buckets of up to ``BUCKET`` distinct fingerprints are compared in one task.
Members of larger ones are linked exactly in another way for t = 2: two
fingerprints are within two bits if and only if some value is within one bit
of both, so each member emits its 65 neighbours and is linked to the smallest
member that meets it at one; rows grow in proportion to the members, whatever
the group's size.  For other t a larger bucket is cut into tiles that are
compared tile by tile.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import save, ship, split_listed, whole_rows
from pulse.llm.components import connected_components

ship(__name__)
BITS = 64
BUCKET = 2048


def _fingerprint(text: str | None, size: int) -> int:
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    digest, join = xxhash.xxh64_intdigest, b" ".join
    if len(tokens) <= size:
        return digest(join(tokens), 42)
    grams = zip(*(tokens[i:] for i in range(size)))
    total, counts = len(tokens) - size + 1, np.zeros(BITS, np.int64)
    hashes = np.fromiter((digest(join(g), 42) for g in grams), np.uint64, total)
    for at in range(0, total, 1 << 13):
        bits = np.unpackbits(hashes[at:at + (1 << 13)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * counts > total).tobytes(), "big")


def fingerprint(text_col, size: int = 3):
    """Column: the SimHash as a signed 64-bit integer."""
    @F.pandas_udf("long")
    def simhash(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([_fingerprint(t, size) for t in texts], np.uint64).view(np.int64))

    return simhash(F.col(text_col) if isinstance(text_col, str) else text_col)


def segments(max_bits: int) -> tuple[list[int], int]:
    """Bit masks of the ring's segments, and how many leading segments of a chain must be equal."""
    m = 2 * max_bits + 1
    cuts = [i * BITS // m for i in range(m + 1)]
    masks = [((1 << (cuts[i + 1] - cuts[i])) - 1) << cuts[i] for i in range(m)]
    equal = max(n for n in range(1, m + 1) if n * max_bits < m)
    return masks, equal


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def linked_pairs(fps: np.ndarray, start: int, max_bits: int, tile: int = 512):
    """Index pairs (i > j) of one bucket within max_bits, found by the chains that begin at ``start``."""
    masks, equal = segments(max_bits)
    m = len(masks)
    for at in range(0, len(fps), tile):
        i, j = np.nonzero(np.tri(min(tile, len(fps) - at), len(fps), at - 1, dtype=bool))
        diff = fps[i + at] ^ fps[j]
        mask = 0
        for n in range(1, m + 1):
            mask |= masks[(start + n - 1) % m]
            if n <= equal or n == m:
                continue
            keep = np.bitwise_count(diff & np.uint64(mask)) <= n * max_bits // m
            i, j, diff = i[keep], j[keep], diff[keep]
        keep = np.bitwise_count(diff) <= max_bits
        yield i[keep] + at, j[keep]


def _forest(n: int, pairs) -> list[tuple[int, int]]:
    """Edges (node, smaller root) that connect what the pairs connect."""
    root = np.arange(n)
    pairs = list(pairs)
    changed = True
    while changed:
        before = root.copy()
        for i, j in pairs:
            low = np.minimum(root[i], root[j])
            np.minimum.at(root, i, low)
            np.minimum.at(root, j, low)
        root = root[root]
        changed = bool((root != before).any())
    return [(k, int(r)) for k, r in enumerate(root) if r != k]


def _comparing(max_bits: int):
    def compare(batches):
        for frame in batches:
            a, b = [], []
            for start, members in zip(frame["start"], frame["fps"]):
                own = np.sort(np.asarray(members, np.int64)).view(np.uint64)
                signed = own.view(np.int64)
                for k, r in _forest(len(own), linked_pairs(own, start, max_bits)):
                    a.append(signed[k])
                    b.append(signed[r])
            yield pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    return compare


def fingerprint_links(fps: DataFrame, max_bits: int, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) that connect all
    fingerprints reachable over links of at most max_bits differing bits."""
    masks, equal = segments(max_bits)
    m = len(masks)
    key_masks = []
    for i in range(m):
        mask = 0
        for k in range(equal):
            mask |= masks[(i + k) % m]
        key_masks.append(_signed(mask))
    keyed = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(x)) for x in key_masks]))
                       .alias("start", "key"))
    counted = keyed.groupBy("start", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = save(keyed.join(counted, ["start", "key"]), "buckets")

    few = (shared.filter(F.col("n") <= bucket).groupBy("start", "key")
           .agg(F.collect_list("fp").alias("fps")).select("start", "fps")
           .mapInPandas(_comparing(max_bits), "a long, b long"))
    hot = shared.filter(F.col("n") > bucket)
    if max_bits == 2:
        flips = [0] + [_signed(1 << b) for b in range(BITS)]
        near = hot.select("fp").distinct().select(
            "fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(x)) for x in flips])).alias("near"))
        met = near.groupBy("near").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).filter("n > 1")
        many = near.join(met, "near").filter("fp != b").select(F.col("fp").alias("a"), "b").distinct()
    else:
        many = _tiled(hot, bucket, max_bits)
    return few.unionByName(many)


def _tiled(hot: DataFrame, bucket: int, max_bits: int) -> DataFrame:
    """Large buckets for wide radii: hashed tiles of about half a bucket, every tile against every tile."""
    tiles = F.ceil(F.col("n") * 2 / bucket).cast("int")
    own = hot.withColumn("tiles", tiles).withColumn("t", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))
    spread = own.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    spread = spread.withColumn("lo", F.least("t", "o")).withColumn("hi", F.greatest("t", "o"))

    return (spread.groupBy("start", "key", "lo", "hi").agg(F.collect_set("fp").alias("fps"))
            .select("start", "fps").mapInPandas(_comparing(max_bits), "a long, b long"))


def near_duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          size: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per input row: (id, fp, label, component_id).

    label is the smallest fingerprint of the component, component_id the
    smallest id in it (null ids are ignored; a component of null ids has
    none).  Null and blank texts have fingerprint zero and are linked like any
    other; repeated rows stay repeated; an empty table gives an empty result.
    Other columns are not read, so their names do not matter.
    """
    marked = save(docs.select(F.col(f"`{id_col}`").alias("id"), fingerprint(F.col(f"`{text_col}`"), size).alias("fp")),
                  "simhash")
    return marked.join(_groups(marked, max_bits), "fp").select("id", "fp", "label", "component_id")


def _groups(marked: DataFrame, max_bits: int) -> DataFrame:
    """(fp, label, component_id) of every fingerprint among (id, fp)."""
    distinct = save(marked.groupBy("fp").agg(F.min("id").alias("low")), "fingerprints")
    linked = (connected_components(fingerprint_links(distinct, max_bits))
              .withColumnRenamed("node", "fp")) if max_bits > 0 else None
    if linked is None:
        return distinct.select("fp", F.col("fp").alias("label"), F.col("low").alias("component_id"))
    labelled = distinct.join(linked, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    lowest = labelled.groupBy("label").agg(F.min("low").alias("component_id"))
    return labelled.join(lowest, "label").select("fp", "label", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             size: int = 3, max_bits: int = 2) -> DataFrame:
    """The input's columns, one row per near-duplicate group: the one with the
    smallest id (any one of them where several rows share that id; a null id
    counts as the largest).

    Texts are fingerprinted once.  A row is known by its id and text hash; a
    Bloom filter of the rows that go (and of kept ones that are repeated) lets
    every other row pass where it is, so only what the filter holds is moved."""
    own, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    marked = save(docs.select(own.alias("id"), F.xxhash64(text).alias("hash"), fingerprint(text, size).alias("fp")), "simhash")
    members = (marked.groupBy("id", "hash", "fp").agg(F.count(F.lit(1)).alias("n"))
               .join(_groups(marked, max_bits).select("fp", "label"), "fp"))
    first = members.groupBy("label").agg(F.min(F.struct(F.col("id").isNull(), "id", "hash")).alias("first"))
    stays = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("hash") == F.col("first.hash"))
    listed = save(members.join(first, "label").select("id", "hash", "n", stays.alias("stays"))
                  .filter(~F.col("stays") | (F.col("n") > 1)).select("id", "hash", "stays"), "not-kept-once")
    held, passed = split_listed(whole_rows(docs, id=own, hash=F.xxhash64(text)), listed, ["id", "hash"])
    named = listed.select(F.col("id").alias("gone_id"), F.col("hash").alias("gone_hash"), "stays")
    kept = (held.join(named, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("hash") == F.col("gone_hash")), "left")
            .filter(F.coalesce("stays", F.lit(True))).dropDuplicates(["id", "hash"]))
    return passed.select("row.*").unionByName(kept.select("row.*"))


def op3_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicate_groups(docs, "doc_id", "text", size=3, max_bits=2).select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id")
