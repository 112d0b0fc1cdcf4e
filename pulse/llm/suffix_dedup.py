"""Repeated byte strings, found by merging shard Burrows-Wheeler transforms.

A byte is removed if a string of ``LENGTH`` bytes covers it that also starts
anywhere else, in the same document or another one.  Strings do not cross
documents and are judged on the input.

Windows travel to shards by content (see ``windows``).  A shard cuts its
distinct segments into parts, takes each part's transform, and merges the
transforms by interleave refinement (see ``bwt_merge``); rows of the merged
order that share ``LENGTH`` bytes with a neighbour are repeated.

Symbols.  Refinement needs a round per symbol, and byte by byte that is
``LENGTH`` rounds over every byte (figures in the README).  Text is therefore
read in strides: place i carries the ``STRIDE`` bytes from i on as one symbol
and is followed by place i + STRIDE, so a segment becomes ``STRIDE``
interleaved sequences and LENGTH / STRIDE rounds suffice.  A window's suffix
starts with LENGTH / STRIDE symbols exactly if it has LENGTH bytes, so the
result is that of single bytes.

Symbols are compared by 64-bit hash.  Null and blank texts: a null has no
bytes, white space counts as any byte.  Rows that repeat a text are separate
documents, so all their long strings go; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm.bwt_merge import merge, transform
from pulse.llm.common import ship
from pulse.llm.hash_files import mix64
from pulse.llm.windows import FREQUENT, Segments, Verdicts, Windows, chunks, covered, gram_hashes, judge_segments

ship(__name__)

LENGTH = 400
GRAM = 64
STRIDE = 100
PARTS = 4
CODES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def encode(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    return CODES[data], data


def _strided(symbols: np.ndarray, begins: np.ndarray, sizes: np.ndarray, stride: int):
    """Sequences of stride symbols: (text, symbol before, place of every row in symbols or -1).

    A segment of n bytes gives ``stride`` sequences (places r, r + stride, ...
    while a whole symbol fits), each ended by a 0.
    """
    hashes = gram_hashes(CODES[symbols], stride)
    fits = sizes - stride + 1  # places with a whole symbol; every segment has some of each residue
    segment = np.repeat(np.arange(len(sizes)), fits)
    within = np.arange(len(segment)) - np.repeat(np.cumsum(fits) - fits, fits)
    place = begins[segment] + within
    ranks = np.unique(hashes[place], return_inverse=True)[1] + 1
    # sequence r of a segment has one symbol more while r < extra, and a 0 at its end
    steps, extra = np.divmod(fits, stride)
    step, residue = np.divmod(within, stride)
    rows = fits + stride
    at = ((np.cumsum(rows) - rows)[segment] + residue * (steps + 1)[segment]
          + np.minimum(residue, extra[segment]) + step)
    text = np.zeros(int(rows.sum()), np.int64)
    text[at] = ranks
    where = np.full(len(text), -1, np.int64)
    where[at] = place
    before = np.zeros_like(text)
    before[1:] = text[:-1]
    return text, before, where


def repeats_anywhere(own: Segments, how: Windows, stride: int = STRIDE, parts: int = PARTS) -> np.ndarray:
    """For every window of the segments: does an equal one start anywhere else?"""
    depth = how.length // stride
    text, before, where = _strided(own.symbols, own.begins, own.sizes, stride)
    # parts of whole sequences of about equal size
    ends = np.nonzero(text == 0)[0] + 1
    cuts = [0, *np.unique(ends[[len(ends) * k // parts - 1 for k in range(1, parts + 1) if len(ends) * k // parts]])]
    rows, transforms = [], []
    for a, b in zip(cuts, cuts[1:]):
        order, symbols = transform(text[a:b], before[a:b], depth)
        rows.append(where[a:b][order])
        transforms.append(symbols)
    source, common = merge(transforms, depth)
    place = np.empty(len(source), np.int64)
    for number, own_rows in enumerate(rows):
        place[source == number] = own_rows
    same = common >= depth
    shared = same.copy()
    shared[:-1] |= same[1:]
    repeated = np.zeros(len(own.symbols), bool)
    repeated[place[shared & (place >= 0)]] = True
    segment, at = own.window_places()
    return repeated[at] | (own.times[segment] > 1)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   gram: int = GRAM, stride: int = STRIDE, frequent: int = FREQUENT) -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, n_spans, kept_sha256, spans
    (maximal removed runs as byte offsets, end exclusive).  length must be a
    multiple of stride."""
    if length % stride:
        raise ValueError("length must be a multiple of stride")
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    how = Windows(length, gram, np.uint8, frequent)
    path, bits = judge_segments(texts, how, encode, lambda own, how: repeats_anywhere(own, how, stride))

    def apply(batches):
        verdicts = Verdicts(path, bits, how)
        for rows, codes, symbols, lengths in chunks(batches, encode):
            starts, count, _, _, _, times, flags = verdicts.of(codes, symbols, lengths)
            gone = covered(len(codes), starts, count, flags | (times > 1)[:, None], how.length)
            begins = np.cumsum(lengths) - lengths
            out = []
            for (row, _), a, n in zip(rows, begins, lengths):
                cut = gone[a:a + n]
                edges = np.flatnonzero(np.diff(np.concatenate([[0], cut.astype(np.int8), [0]])))
                out.append((row, n, int(cut.sum()), len(edges) // 2,
                            hashlib.sha256(symbols[a:a + n][~cut].tobytes()).hexdigest(),
                            edges.reshape(-1, 2).tolist()))
            yield pd.DataFrame(out, columns=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]).astype(
                {"id": "Int64"})

    return texts.mapInPandas(apply, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                                    "spans array<array<long>>")


def op9_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeats(docs).select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
