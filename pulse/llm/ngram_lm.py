"""Interpolated modified Kneser-Ney bigram model: counted in Spark, kept as
sorted hash arrays, memory-mapped by the workers that score.

Tokens: lower-case A-Z, words, one end mark per text (a counted token); the
first token's context is a start mark, which is never predicted.

Counting.  Every task counts bigrams of its texts in bounded chunks and deals
them by context hash to shards (a power of two that follows the number of
input partitions; a context's words are dealt to two of them).  A shard merges its blocks, writes one file (sorted 64-bit
bigram hashes, counts) and passes on, per context, its total and its numbers
of bigrams seen once, twice, three times or more, and per predicted word its
count and number of contexts.  Those are merged by word hash into vocabulary
files of the same kind.  The driver sees one row of sums.

Model.  p(w|v) = max(c(vw) - D(c), 0) / c(v) + g(v) p(w), with p(w) from the
numbers of contexts, discounted likewise and interpolated with 1 / (V + 1),
which is what an unknown word gets.  The discounts follow from the counts of
counts, separately for both orders.

Scoring.  A worker maps the files it needs (one that is not on a file system
it can map is copied to its temporary folder first), looks up a chunk's
distinct hashes by binary search, shard by shard, and sums log10
probabilities per text.  Texts are never cut; memory is bounded by a chunk
and the longest text.

Files are written under another name and then renamed, so a task that is run
again replaces them by the same content.

Null and blank texts are one end mark; a null id counts as the empty string
in the split; repeated rows are counted and scored each; without training
texts every token is unknown and has probability one; an empty table gives an
empty result.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import save, ship
from pulse.llm.hash_files import HashFiles, blocks, joined, run_starts, shard_of, sum_runs, write_arrays
from pulse.session import shared_dir

ship(__name__)

START, END = np.uint64(1), np.uint64(2)
COUNT_CHUNK, SCORE_CHUNK = 1_000_000, 200_000
GOLD = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)


def token_hashes(text: str | None) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    out = np.empty(len(tokens) + 1, np.uint64)
    out[:-1] = np.fromiter((digest(t) for t in tokens), np.uint64, len(tokens))
    out[-1] = END
    return out


def bigram_key(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    x = (v * GOLD) ^ (w + GOLD + (v << np.uint64(6)) + (v >> np.uint64(2)))
    x = (x ^ (x >> np.uint64(32))) * MIX
    return x ^ (x >> np.uint64(29))


def bigram_shard(v: np.ndarray, w: np.ndarray, bits: int) -> np.ndarray:
    """By context, with a context's words dealt to two shards so that a very frequent one is split."""
    return shard_of((v + (w >> np.uint64(63))) * GOLD, bits)


def _contexts(tokens: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(context, word) of all tokens of some texts."""
    word = np.concatenate(tokens)
    context = np.empty_like(word)
    context[1:] = word[:-1]
    context[np.cumsum([0, *map(len, tokens[:-1])])] = START
    return context, word


#: Sorted hash arrays: bigram hash, count; and word hash, count, contexts, total and n1, n2, n3 as a context.
BIGRAM = (np.uint64, np.uint32)
VOCABULARY = (np.uint64, np.int64, np.int64, np.int64, np.int64, np.int64, np.int64)


def _count_texts(bits: int):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pd.DataFrame:
            v, w = _contexts(held)
            shard = bigram_shard(v, w, bits)
            order = np.lexsort((w, v, shard))
            v, w, shard = v[order], w[order], shard[order]
            at = run_starts(shard, v, w)
            n = np.diff(np.append(at, len(v))).astype(np.uint32)
            v, w, shard = v[at], w[at], shard[at]
            # a context once per run of its bigrams, with the run's length
            firsts = run_starts(shard, v)
            lengths = np.diff(np.append(firsts, len(v))).astype(np.uint32)
            heads = blocks(shard[firsts], {"v": v[firsts], "m": lengths})
            tails = blocks(shard, {"w": w, "c": n})
            return heads.merge(tails, on="shard")

        for frame in batches:
            for text in frame["text"]:
                held.append(token_hashes(text))
                size += len(held[-1])
                if size >= COUNT_CHUNK:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return count


def _merge_contexts(path: str, bits: int):
    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        number = int(frame["shard"].iloc[0])
        v = np.repeat(joined(frame, "v", np.uint64), joined(frame, "m", np.uint32))
        w, c = joined(frame, "w", np.uint64), joined(frame, "c", np.uint32).astype(np.int64)
        order = np.lexsort((w, v))
        v, w, c = v[order], w[order], c[order]
        at = run_starts(v, w)
        v, w, c = v[at], w[at], sum_runs(c, at)
        key = bigram_key(v, w)
        order = np.argsort(key)
        write_arrays(f"{path}/bigram-{number:05d}", key[order], np.minimum(c[order], 2**32 - 1).astype(np.uint32))
        firsts = run_starts(v)
        totals = [sum_runs(c, firsts), *(sum_runs(x.astype(np.int64), firsts) for x in (c == 1, c == 2, c >= 3))]
        zero = np.zeros(len(firsts), np.int64)
        contexts = pd.DataFrame(dict(zip(("h", "c", "k", "t", "n1", "n2", "n3"), (v[firsts], zero, zero, *totals))))
        order = np.argsort(w, kind="stable")
        w, c = w[order], c[order]
        at = run_starts(w)
        zero = np.zeros(len(at), np.int64)
        counts = np.diff(np.append(at, len(w)))
        predicted = pd.DataFrame({"h": w[at], "c": sum_runs(c, at), "k": counts, "t": zero, "n1": zero, "n2": zero,
                                  "n3": zero})
        both = pd.concat([contexts, predicted]).sort_values("h", kind="stable")
        out = blocks(shard_of(both["h"].to_numpy(), bits), {x: both[x].to_numpy() for x in both})
        every = c if len(c) else np.zeros(0, np.int64)
        seen = [int((every == x).sum()) for x in (1, 2, 3, 4)]
        for i, x in enumerate(seen):
            out[f"cc{i + 1}"] = [x] + [0] * (len(out) - 1)
        return out

    return merge


def _merge_words(path: str):
    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        number = int(frame["shard"].iloc[0])
        h = joined(frame, "h", np.uint64)
        order = np.argsort(h, kind="stable")
        h = h[order]
        at = run_starts(h)
        parts = {x: sum_runs(joined(frame, x, np.int64)[order], at) for x in ("c", "k", "t", "n1", "n2", "n3")}
        write_arrays(f"{path}/vocabulary-{number:05d}", h[at], *parts.values())
        k = parts["k"]
        return pd.DataFrame({"words": [int((parts["c"] > 0).sum())], "tokens": [int(parts["c"].sum())],
                             "types": [int(k.sum())], **{f"kk{x}": [int((k == x).sum())] for x in (1, 2, 3, 4)},
                             "k3": [int((k >= 3).sum())]})

    return merge


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from counts of counts; 0.5, 1 and 1.5 where a count is missing."""
    if not (n1 and n2 and n3 and n4):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.01), k + 0.99) for k, d in enumerate(raw))


class Model:
    """A trained model's place and its few global numbers; the arrays stay in their files."""

    def __init__(self, path: str, bits: int, totals: dict):
        self.path, self.bits = path, bits
        self.words, self.tokens, self.types = (int(totals[x] or 0) for x in ("words", "tokens", "types"))
        self.high = np.array([0.0, *discounts(*(int(totals[f"cc{i}"] or 0) for i in (1, 2, 3, 4)))])
        self.low = np.array([0.0, *discounts(*(int(totals[f"kk{i}"] or 0) for i in (1, 2, 3, 4)))])
        k1, k2, k3 = int(totals["kk1"] or 0), int(totals["kk2"] or 0), int(totals["k3"] or 0)
        self.rest = float(self.low[1] * k1 + self.low[2] * k2 + self.low[3] * k3) / self.types if self.types else 1.0


def train(docs: DataFrame, text_col: str = "text") -> Model:
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{text_col}`").alias("text"))
    bits = max(4, 2 + math.ceil(math.log2(max(1, texts.rdd.getNumPartitions()))))
    path = shared_dir(spark, "llm-ngram")
    counted = texts.mapInPandas(_count_texts(bits), "shard int, v binary, m binary, w binary, c binary")
    stats = save(counted.groupBy("shard").applyInPandas(
        _merge_contexts(path, bits), "shard int, h binary, c binary, k binary, t binary, n1 binary, n2 binary, "
        "n3 binary, cc1 long, cc2 long, cc3 long, cc4 long"), "ngram-stats")
    words = stats.drop("cc1", "cc2", "cc3", "cc4").groupBy("shard").applyInPandas(
        _merge_words(path), "words long, tokens long, types long, kk1 long, kk2 long, kk3 long, kk4 long, k3 long")
    low = words.agg(*[F.sum(c).alias(c) for c in words.columns]).first().asDict()
    high = stats.agg(*[F.sum(c).alias(c) for c in ("cc1", "cc2", "cc3", "cc4")]).first().asDict()
    return Model(path, bits, {**low, **high})


class Lookup:
    """A model's mapped files in one worker."""

    def __init__(self, model: Model):
        self.model = model
        self.bigrams = HashFiles(model.path, "bigram", BIGRAM)
        self.vocabulary = HashFiles(model.path, "vocabulary", VOCABULARY)

    def score(self, tokens: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: known tokens, base log10 probability, model log10 probability."""
        m = self.model
        v, w = _contexts(tokens)
        both, place = np.unique(np.concatenate([v, w]), return_inverse=True)
        _, c, k, t, n1, n2, n3 = self.vocabulary.find(shard_of(both, m.bits), both)
        cv, cw = place[:len(v)], place[len(v):]
        base = np.log10((c + 0.5) / (m.tokens + 0.5 * (m.words + 1)))
        lower = np.maximum(k - m.low[np.minimum(k, 3)], 0) / max(m.types, 1) + m.rest / (m.words + 1)
        key, shard = bigram_key(v, w), bigram_shard(v, w, m.bits)
        order = np.lexsort((key, shard))
        _, sorted_n = self.bigrams.find(shard[order], key[order])
        n = np.empty(len(v), np.int64)
        n[order] = sorted_n
        total = np.maximum(t, 1)
        back = np.where(t > 0, (m.high[1] * n1 + m.high[2] * n2 + m.high[3] * n3) / total, 1.0)
        p = np.maximum(n - m.high[np.minimum(n, 3)], 0) / total[cv] + back[cv] * lower[cw]
        starts = np.cumsum([0, *map(len, tokens[:-1])])
        return (np.add.reduceat((c > 0).astype(np.int64)[cw], starts), np.add.reduceat(base[cw], starts),
                np.add.reduceat(np.log10(p), starts))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          flag: str | None = None) -> DataFrame:
    """One row per input row: id, (flag,) n_tokens, n_known, base_score, score."""
    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lookup = Lookup(model)
        for frame in batches:
            parts, held, size = [], [], 0
            tokens_of = []

            def flush() -> None:
                known, base, full = lookup.score(held)
                parts.append(pd.DataFrame({"n_known": known, "base_score": base, "score": full}))

            for text in frame["text"]:
                held.append(token_hashes(text))
                tokens_of.append(len(held[-1]))
                size += len(held[-1])
                if size >= SCORE_CHUNK:
                    flush()
                    held, size = [], 0
            if held:
                flush()
            if parts:
                out = pd.concat(parts, ignore_index=True)
                out.insert(0, "n_tokens", np.array(tokens_of, np.int64))
                yield pd.concat([frame.drop(columns="text").reset_index(drop=True), out], axis=1)

    picked = docs.select(F.col(f"`{id_col}`").alias("id"), *([F.col(f"`{flag}`").alias("flag")] if flag else []),
                         F.col(f"`{text_col}`").alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    return picked.mapInPandas(scored, f"id {kind}, " + ("flag boolean, " if flag else "")
                              + "n_tokens long, n_known long, base_score double, score double")


def op7_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    number = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    split = docs.withColumn("held_out", number % 5 == 1)
    model = train(split.filter(~F.col("held_out")))
    return score(split, model, flag="held_out").select(
        F.col("id").alias("doc_id"), F.col("flag").alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
