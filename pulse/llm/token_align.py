"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

Both tokenizers cut the same byte string (a space and the text) into tokens.
Workers encode a batch of texts, lay both sides' tokens on the batch's bytes
and call ``pandas.merge_asof`` twice, keyed by document: every token start
finds the other side's token that covers it.  The union of both directions is
every overlapping pair of token occurrences (a *link*), as the later start of
two overlapping tokens lies inside the other token.  Where tokens of both
sides end at the same byte, a *group* ends.

Results: ``align`` gives per row the token counts, the groups as text
(``a1,a2|b1;a3|b2,b3``) and the distinct linked id pairs with their number.
``pair_counts`` adds those up over the corpus (Spark aggregation; there are no
more rows than pairs of vocabulary entries).  ``link_strength`` looks the
corpus-wide counts up again for every row: the counts are written once as
sorted arrays, dealt by B id, which the workers map and search; rows are never
shuffled.

The tokenizers are read once by the driver (files of one or two MB, at most
``VOCABULARY_BYTES``) and sent to the workers as bytes.  Side A's vocabulary
and merges come from its JSON file.  If every merge makes the next id, which
is checked, merging by smallest id is merging by that list, so texts of common
characters take the faster of two encoders of the same vocabulary; every other
text takes the file's own encoder.

Memory is bounded by a chunk of ``CHUNK`` bytes or the longest text.
Texts are never cut.  Null and empty texts, and texts that a side's tokens do
not spell byte for byte, have no tokens: zeros and ''.  Rows with a null id
and repeated rows are kept and counted each.  An empty table gives an empty
result.  Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import save, ship, table
from pulse.llm.hash_files import HashFiles, run_starts, write_arrays
from pulse.session import shared_dir

ship(__name__)

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK = 1_000_000
VOCABULARY_BYTES = 64 << 20
#: Pairs a file of counts holds on average.
SHARD_PAIRS = 2_000_000
#: Fixed value: how a byte-level tokenizer of this kind splits text before merging.
PRE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters up to Latin Extended-B, no endless white space: both encoders split these alike.
COMMON = re.compile(r"[\x00-ɏ]*")
LONG_SPACE = re.compile(r"\s{1000}")


def byte_characters() -> dict[str, int]:
    """Byte-level vocabularies write a byte as one character: visible Latin-1
    characters stand for themselves, the other bytes follow from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {**{chr(b): b for b in visible}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


class ByteLevel:
    """Side A: a byte-level BPE from its JSON file."""

    def __init__(self, data: bytes):
        import tokenizers
        text = data.decode("utf-8")
        self.full = tokenizers.Tokenizer.from_str(text)
        self.full.encode_special_tokens = True
        model = json.loads(text)["model"]
        byte_of = byte_characters()
        ids = {token: i for token, i in self.full.get_vocab().items()}
        self.size = max(ids.values()) + 1
        self.bytes = [b""] * self.size
        for token, i in ids.items():
            self.bytes[i] = (bytes(byte_of[c] for c in token) if all(c in byte_of for c in token)
                             else token.encode("utf-8"))
        self.fast = self._ranked(model, byte_of)

    def _ranked(self, model: dict, byte_of: dict[str, int]):
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"].get(a + b, -1) for a, b in pairs]
        if any(y <= x for x, y in zip(made, made[1:])) or (made and made[0] < len(byte_of)):
            return None
        import tiktoken
        ranks = {bytes(byte_of[c] for c in t): i for t, i in model["vocab"].items() if all(c in byte_of for c in t)}
        if len(ranks) < len(byte_of) + len(made):
            return None
        kept = set(made)
        ranks = {t: i for t, i in ranks.items() if len(t) == 1 or i in kept}
        return tiktoken.Encoding("a", pat_str=PRE_SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> tuple[np.ndarray, bool]:
        """Ids of a space and the text, and whether they are known to spell it: merging
        whole bytes, of which each has an id, loses none."""
        text = " " + text
        if self.fast and COMMON.fullmatch(text) and not LONG_SPACE.search(text):
            return self.fast.encode_to_numpy(text, disallowed_special=()), True
        return np.array(self.full.encode(text, add_special_tokens=False).ids, np.int64), False


class Pieces:
    """Side B: a piece BPE with byte fallback, which puts the space before the text itself."""

    def __init__(self, data: bytes):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.size = self.model.get_piece_size()
        self.bytes = []
        for i in range(self.size):
            piece = self.model.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i)
                              else piece.replace("▁", " ").encode("utf-8"))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Side:
    """One tokenizer with what the alignment needs of its vocabulary."""

    def __init__(self, encoder, last: str):
        self.encoder = encoder
        self.length = np.array([len(b) for b in encoder.bytes], np.int64)
        self.inner = np.array([f"{i}," for i in range(encoder.size)], object)
        self.outer = np.array([f"{i}{last}" for i in range(encoder.size)], object)

    def spells(self, ids: list[int], wanted: bytes) -> bool:
        return b"".join(map(self.encoder.bytes.__getitem__, ids)) == wanted

    def lay(self, tokens: list[np.ndarray]) -> pd.DataFrame:
        """The tokens of some documents in order: doc, at (start), id; documents' bytes follow each other."""
        ids = np.concatenate([np.zeros(0, np.int64), *tokens])
        length = self.length[ids]
        return pd.DataFrame({"doc": np.repeat(np.arange(len(tokens)), [len(t) for t in tokens]),
                             "at": np.cumsum(length) - length, "id": ids})


def _covering(side: pd.DataFrame, other: pd.DataFrame) -> np.ndarray:
    """For every token start of a side, the row of the other side's token that covers it."""
    marked = other[["doc", "at"]].assign(k=np.arange(len(other)))
    return pd.merge_asof(side[["doc", "at"]], marked, on="at", by="doc")["k"].to_numpy(np.int64)


class Aligner:
    def __init__(self, byte_level: bytes, pieces: bytes):
        self.a, self.b = Side(ByteLevel(byte_level), "|"), Side(Pieces(pieces), ";")

    def tokens(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both sides for every text, none where a side does not spell the text."""
        none = np.zeros(0, np.int64)
        out = [(none, none)] * len(texts)
        some = [i for i, t in enumerate(texts) if t]
        for i, ids in zip(some, self.b.encoder.encode([texts[i] for i in some])):
            wanted = b" " + texts[i].encode("utf-8")
            if self.b.spells(ids, wanted):
                own, exact = self.a.encoder.encode(texts[i])
                if exact or self.a.spells(own.tolist(), wanted):
                    out[i] = own.astype(np.int64), np.array(ids, np.int64)
        return out

    def align(self, texts: list[str | None]) -> dict:
        both = self.tokens(texts)
        docs = len(texts)
        a, b = self.a.lay([x for x, _ in both]), self.b.lay([y for _, y in both])
        b_at_a, a_at_b = _covering(a, b), _covering(b, a)
        at_a, at_b = a["at"].to_numpy(), b["at"].to_numpy()
        # a group starts where tokens of both sides do; equal starts are found from both sides and linked once
        first_a, first_b = at_b[b_at_a] == at_a, at_a[a_at_b] == at_b
        la, lb = (np.concatenate(x) for x in ((np.arange(len(a)), a_at_b[~first_b]), (b_at_a, np.flatnonzero(~first_b))))
        doc, ia, ib = a["doc"].to_numpy(), a["id"].to_numpy(), b["id"].to_numpy()
        # distinct pairs of a document with their number
        key = np.sort((doc[la] * self.b.encoder.size + ib[lb]) * self.a.encoder.size + ia[la])
        firsts = run_starts(key)
        times = np.diff(np.append(firsts, len(key)))
        key, pair_a = np.divmod(key[firsts], self.a.encoder.size)
        pair_doc, pair_b = np.divmod(key, self.b.encoder.size)
        count = lambda d: np.bincount(d, minlength=docs)
        n_a, n_b = count(doc), count(b["doc"].to_numpy())
        return {"n_a": n_a, "n_b": n_b, "n_links": count(doc[la]), "n_groups": count(doc[first_a]),
                "groups": self._written(ia, ib, np.flatnonzero(first_a), np.flatnonzero(first_b), n_a + n_b),
                "pairs": (np.searchsorted(pair_doc, np.arange(docs + 1)), pair_a, pair_b, times)}

    def _written(self, ia, ib, starts_a, starts_b, sizes) -> list[str]:
        """Every document's groups as text; A tokens of a group stand before its B tokens."""
        parts = np.empty(len(ia) + len(ib), object)
        begin = [starts_a, starts_b]
        for i, (starts, ids, side) in enumerate(((starts_a, ia, self.a), (starts_b, ib, self.b))):
            sizes_of = np.diff(np.append(starts, len(ids)))
            last = np.zeros(len(ids), bool)
            last[(starts + sizes_of - 1)] = True
            # behind as many tokens of the other side as earlier groups (for B: this one too) hold
            ahead = begin[1] if i == 0 else np.append(begin[0][1:], len(ia))
            parts[np.arange(len(ids)) + np.repeat(ahead, sizes_of)] = np.where(last, side.outer[ids], side.inner[ids])
        ends = np.cumsum(sizes).tolist()
        return ["".join(parts[x:y])[:-1] for x, y in zip([0, *ends], ends)]


def _chunks(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows of about CHUNK bytes."""
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        total += size
        if total >= CHUNK:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


PAIR = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int32())])
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _read(spark, path: str) -> bytes:
    """A vocabulary file, from any store Spark can read."""
    (size,) = spark.read.format("binaryFile").load(path).select("length").first()
    if size > VOCABULARY_BYTES:
        raise ValueError(f"{path} has {size} bytes; a vocabulary has {VOCABULARY_BYTES} at most")
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


def align(docs: DataFrame, byte_level: str = BYTE_BPE, pieces: str = PIECE_BPE, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_a, n_b, n_groups, n_links, groups (text) and
    pairs, the distinct linked (a, b) ids with their number n."""
    data = _read(docs.sparkSession, byte_level), _read(docs.sparkSession, pieces)
    picked = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = None
        for batch in batches:
            aligner = aligner or Aligner(*data)
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            for x, y in _chunks(sizes):
                got = aligner.align(batch.column(1).slice(x, y - x).to_pylist())
                bounds, a, b, n = got["pairs"]
                flat = pa.StructArray.from_arrays([pa.array(v, pa.int32()) for v in (a, b, n)], fields=list(PAIR))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(x, y - x), *(pa.array(got[c], pa.int64()) for c in COUNTS),
                     pa.array(got["groups"], pa.string()), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), flat)],
                    names=["id", *COUNTS, "groups", "pairs"])

    kind = picked.schema["id"].dataType.simpleString()
    return picked.mapInArrow(run, f"id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, groups string, "
                                  "pairs array<struct<a:int,b:int,n:int>>")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(a, b, count): how many links of the corpus hold the pair."""
    return (aligned.select(F.inline("pairs")).groupBy("a", "b")
            .agg(F.sum(F.col("n").cast("long")).alias("count")))


def _write_counts(path: str):
    def write(frame: pd.DataFrame) -> pd.DataFrame:
        number = int(frame["shard"].iloc[0])
        b, a, n = (frame[c].to_numpy(np.int64) for c in ("b", "a", "count"))
        order = np.lexsort((a, b))
        a, b, n = a[order], b[order], n[order]
        best = np.maximum.reduceat(n, run_starts(b))
        best = n == np.repeat(best, np.diff(np.append(run_starts(b), len(b))))
        write_arrays(f"{path}/pair-{number:05d}", (b << 32 | a).astype(np.uint64), n, best.astype(np.int64))
        return pd.DataFrame({"shard": [number], "pairs": [len(n)]})

    return write


def link_strength(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """The rows of ``align`` with n_best (links whose pair has the highest count
    of its B id, ties included) and count_sum (counts added over all links)."""
    spark = aligned.sparkSession
    path = shared_dir(spark, "llm-pairs")
    shards = max(1, -(-counts.count() // SHARD_PAIRS))
    written = (counts.withColumn("shard", F.pmod("b", F.lit(shards))).groupBy("shard")
               .applyInPandas(_write_counts(path), "shard int, pairs long"))
    have = {r["shard"] for r in written.collect()}  # a row per file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = HashFiles(path, "pair", (np.uint64, np.int64, np.int64), have)
        for batch in batches:
            pairs = batch.column(batch.schema.get_field_index("pairs"))
            flat = pairs.flatten()
            a, b, n = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3))
            distinct = np.sort(b << 32 | a)
            distinct = distinct[run_starts(distinct)]
            shard = (distinct >> 32) % shards
            order = np.argsort(shard, kind="stable")
            found, count, best = files.find(shard[order], distinct[order].astype(np.uint64))
            if not found.all():
                raise ValueError("a linked pair has no count: counts belong to other rows")
            value, top = np.empty_like(count), np.empty_like(best)
            value[order], top[order] = count, best
            place = np.searchsorted(distinct, b << 32 | a)
            sums = [np.append(0, np.cumsum(n * x[place])) for x in (top, value)]
            bounds = np.append(0, np.cumsum(pairs.value_lengths().to_numpy(zero_copy_only=False)))
            keep = [i for i, name in enumerate(batch.schema.names) if name != "pairs"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in keep), *(pa.array(s[bounds[1:]] - s[bounds[:-1]], pa.int64()) for s in sums)],
                names=[*(batch.schema.names[i] for i in keep), "n_best", "count_sum"])

    fields = [f for f in aligned.schema.fields if f.name != "pairs"]
    return aligned.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
                              + ", n_best long, count_sum long")


def op11_query(spark, sf_dir: str) -> DataFrame:
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    aligned = save(align(table(spark, sf_dir, "documents")).withColumn("groups_sha256", digest).drop("groups"),
                   "aligned")
    counts = save(pair_counts(aligned), "pair-counts")
    return link_strength(aligned, counts).select(
        F.col("id").cast("long").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
        "groups_sha256")
