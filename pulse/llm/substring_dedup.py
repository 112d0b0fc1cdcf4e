"""Repeated word windows, found by backward search in an FM-index per shard.

A word is removed if it lies in a window of ``WINDOW`` consecutive words of
its document whose sequence also starts earlier: in a document with a smaller
id (then smaller text hash, null ids last), or earlier in the same document.
Windows are judged on the input.

Windows travel to shards by content (see ``windows``).  A shard indexes its
distinct segments (Burrows-Wheeler transform in a wavelet matrix) and streams
them through it: backward search gives every place's matching statistic, and
a window whose statistic reaches ``WINDOW`` is compared with the earliest
place in its interval.  The rows of an interval are places, so no pair of
documents is ever formed.

Words are compared by 64-bit hash, case and punctuation included.  Null and
blank texts have no words.  Rows that repeat a document's id and text are one
document and get the same result; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import ship
from pulse.llm.fm_index import FMIndex
from pulse.llm.windows import FREQUENT, Segments, Verdicts, Windows, chunks, covered, judge_segments, order_of

ship(__name__)

WINDOW = 20
GRAM = 8


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def encode(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    tokens = _words(text)
    out = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    return out, out


def repeats_earlier(own: Segments, how: Windows) -> np.ndarray:
    """For every window of the segments: does an equal one start earlier?"""
    ranks = np.unique(own.symbols, return_inverse=True)[1].astype(np.int64) + 1
    size = len(own.sizes)
    text = np.zeros(len(ranks) + size, np.int64)  # a separator after every segment
    place = np.arange(len(ranks)) + np.repeat(np.arange(size), own.sizes)
    text[place] = ranks
    index = FMIndex(text, int(ranks.max()) + 1, how.length)
    segment, at = own.window_places()
    at = at + segment
    length, low, high = index.matching(text, at + how.length, how.length)
    found = np.nonzero(length == how.length)[0]
    # every place's order among the documents' places
    owner = np.repeat(np.arange(size), own.sizes)
    within = np.arange(len(owner)) - own.begins[owner]
    order = np.lexsort((own.starts[owner] + within, own.texts[owner], own.ids[owner]))
    rank = np.full(len(text), len(text), np.int64)
    rank[place[order]] = np.arange(len(order))
    rows = rank[index.order]
    # all windows with one content share one interval, and intervals do not overlap
    lows, where = np.unique(low[found], return_inverse=True)
    highs = np.zeros(len(lows), np.int64)
    highs[where] = high[found]
    bounds = np.column_stack([lows, highs]).ravel()
    least = np.minimum.reduceat(np.append(rows, len(text)), bounds)[::2] if len(lows) else lows
    out = np.zeros(len(at), bool)
    out[found] = rank[at[found]] > least[where]
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   gram: int = GRAM, frequent: int = FREQUENT) -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept_sha256, spans (maximal
    removed runs as word offsets, end exclusive)."""
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    how = Windows(window, gram, np.uint64, frequent)
    path, bits = judge_segments(texts, how, encode, repeats_earlier)

    def apply(batches):
        verdicts = Verdicts(path, bits, how)
        for rows, codes, symbols, lengths in chunks(batches, encode):
            starts, count, ids, hashes, firsts, _, flags = verdicts.of(codes, symbols, lengths)
            own_ids, own_texts = order_of(rows)
            begins = np.cumsum(lengths) - lengths
            doc = np.searchsorted(begins + lengths, starts, "right")
            first = (ids == own_ids[doc]) & (hashes == own_texts[doc]) & (firsts == starts - begins[doc])
            gone = covered(len(codes), starts, count, flags | ~first[:, None], how.length)
            out = []
            for (row, text), a, n in zip(rows, begins, lengths):
                tokens, cut = _words(text), gone[a:a + n]
                edges = np.flatnonzero(np.diff(np.concatenate([[0], cut.astype(np.int8), [0]])))
                kept = tokens if not len(edges) else [tokens[i] for i in np.flatnonzero(~cut)]
                out.append((row, n, int(cut.sum()), hashlib.sha256(b" ".join(kept)).hexdigest(),
                            edges.reshape(-1, 2).tolist()))
            yield pd.DataFrame(out, columns=["id", "n_words", "n_removed", "kept_sha256", "spans"]).astype(
                {"id": "Int64"})

    return texts.mapInPandas(apply, "id long, n_words long, n_removed long, kept_sha256 string, spans array<array<long>>")


def op10_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeats(docs).select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")
