"""Fixed-length windows over symbol sequences, dealt to shards by content.

The substring operators compare all windows of ``length`` symbols of all
documents.  A window's key is the smallest hash of the ``gram``-symbol grams
in it, so equal windows have equal keys, wherever they stand; consecutive
windows with the same smallest gram form a run, and a run's symbols (its
segment) are all that its windows need.  Segments are dealt to shards by key,
so one shard sees every place at which a window can repeat, and no document
is compared with another shard.

Three passes read the documents, none shuffles whole texts:

1. The keys that occur at least twice are written as sorted hash arrays.  A
   window whose key occurs once occurs once itself.
2. Runs with a repeated key go to their shards.  Equal segments are merged in
   every task before the shuffle (a passage that stands in a third of all
   documents travels once per task) and again in the shard, where an index
   over the distinct segments judges every window.  The verdicts are written
   as hash arrays by segment content.
3. The caller's pass over the documents looks its runs' verdicts up.

Frequent keys.  A short passage that many documents hold in different contexts
would bring all those contexts to one key.  Where a key occurs ``frequent``
times or more, its windows are keyed anew: the grams of such runs are counted,
and those that occur as often give way to all others when the smallest is
taken.  A window that holds any rarer gram is then keyed by that one, so the
contexts spread over the shards, or occur once and are done.  Whether a gram
is frequent depends on its content only, so equal windows still have equal
keys and nothing is lost, whatever the limit.  The frequent grams are sorted
hash arrays too.  This takes two more passes, and only if there is such a key.

What one shard holds at once is bounded by ``BLOCK`` symbols or the distinct
segments of a single key, whichever is more.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import save, ship
from pulse.llm.hash_files import HashFiles, blocks, joined, mix64, run_starts, shard_of, write_arrays
from pulse.session import shared_dir

ship(__name__)

CHUNK = 400_000
BLOCK = 400_000
FREQUENT = 4096
LAST = np.iinfo(np.int64).max
BASE = 0x9E3779B97F4A7C15 | 1
_base = np.uint64(BASE)
_inverse = np.uint64(pow(BASE, -1, 1 << 64))


class Windows:
    """How a sequence is windowed: window length, gram length, symbol type, and from how many runs on a key is frequent."""

    def __init__(self, length: int, gram: int, symbol, frequent: int = FREQUENT):
        self.length, self.gram, self.symbol, self.frequent = length, gram, np.dtype(symbol), frequent
        self.span = length - gram + 1  # grams in a window, and the most windows in a run
        self.mask = (self.span + 7) // 8  # bytes of a verdict


_tables: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept for the next chunk."""
    if not _tables or len(_tables[0]) < n:
        both = np.empty((2, max(n, 2 * CHUNK)), np.uint64)
        both[0], both[1], both[:, 0] = _base, _inverse, 1
        _tables[:] = list(np.cumprod(both, axis=1))
    return _tables[0][:n], _tables[1][:n]


def gram_hashes(codes: np.ndarray, gram: int) -> np.ndarray:
    """Hash of every run of ``gram`` codes: a polynomial in 64-bit arithmetic, from prefix sums."""
    n = len(codes)
    if n < gram:
        return np.zeros(0, np.uint64)
    up, down = _powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(codes * down, out=sums[1:])
    x = sums[gram:] - sums[:-gram]
    x *= up[:n - gram + 1]
    x ^= x >> np.uint64(32)
    x *= _base
    return x


def sliding_min(values: np.ndarray, span: int) -> np.ndarray:
    """Smallest of every ``span`` consecutive values."""
    width = 1
    while 2 * width <= span:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    rest = span - width
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


def runs_of(codes: np.ndarray, lengths: np.ndarray, how: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, windows, key) of every run in some documents' concatenated codes."""
    empty = np.zeros(0, np.int64)
    if len(codes) < how.length:
        return empty, empty, np.zeros(0, np.uint64)
    grams = gram_hashes(codes, how.gram)
    least = sliding_min(grams, how.span)
    ends = np.cumsum(lengths)
    # windows that begin at or after end - length + 1 would leave their document
    crossing = np.zeros(len(codes) + 1, np.int32)
    np.add.at(crossing, np.maximum(ends - how.length + 1, ends - lengths), 1)
    np.add.at(crossing, ends, -1)
    starts, count = _cut(grams, least, np.cumsum(crossing[:len(least)]) == 0)
    return starts, count, mix64(least[starts] + np.uint64(1))


def _cut(values: np.ndarray, least: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, windows) of the runs of the windows ``inside``."""
    new = np.ones(len(least), bool)
    # a run ends where the smallest gram changes or its leftmost place leaves the window
    new[1:] = (least[1:] != least[:-1]) | (values[:len(least) - 1] == least[:-1]) | ~inside[:-1]
    starts = np.nonzero(new & inside)[0]
    stops = np.append(np.nonzero(new | ~inside)[0], len(least))
    return starts, stops[np.searchsorted(stops, starts, "right")] - starts


def _spans(size: int, starts: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Which of ``size`` places lie in start .. start + count."""
    edges = np.zeros(size + 1, np.int32)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + count, -1)
    return np.cumsum(edges[:size]) > 0


def finer_runs(codes: np.ndarray, starts: np.ndarray, count: np.ndarray, how: Windows,
               frequent: Callable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, windows, key) of the same windows, keyed by their smallest gram
    that is not frequent, or by their smallest gram if all are."""
    grams = gram_hashes(codes, how.gram)
    ranked = grams >> np.uint64(1)
    at = np.flatnonzero(_spans(len(grams), starts, count + how.span - 1))
    ranked[at] |= frequent(grams[at]).astype(np.uint64) << np.uint64(63)
    least = sliding_min(ranked, how.span)
    starts, count = _cut(ranked, least, _spans(len(least), starts, count))
    return starts, count, mix64(least[starts] + np.uint64(2))


def chunks(batches: Iterator[pd.DataFrame], encode: Callable) -> Iterator[tuple]:
    """(rows, codes, symbols, lengths) of documents in bounded chunks; rows are (id, text)."""
    held, size = [], 0
    for frame in batches:
        for row, text in zip(frame["id"], frame["text"]):
            held.append((row, text, *encode(text)))
            size += len(held[-1][2])
            if size >= CHUNK:
                yield _pack(held)
                held, size = [], 0
    if held:
        yield _pack(held)


def _pack(held: list) -> tuple:
    return ([(h[0], h[1]) for h in held], np.concatenate([h[2] for h in held]),
            np.concatenate([h[3] for h in held]), np.array([len(h[2]) for h in held], np.int64))


def _counted(keys: np.ndarray, bits: int) -> pd.DataFrame:
    """One row per shard: distinct keys and how often each occurs, counted up to 65,535 a chunk."""
    keys = np.sort(keys)
    at = run_starts(keys)
    n = np.minimum(np.diff(np.append(at, len(keys))), 65_535).astype(np.uint16)
    return blocks(shard_of(keys[at], bits), {"keys": keys[at], "n": n})


COUNTED = "shard int, keys binary, n binary"


def _count(how: Windows, encode: Callable, bits: int, pick: Callable):
    """Counts what ``pick()(codes, lengths)`` finds in every chunk."""
    def collect(batches):
        find = pick()
        for _, codes, _, lengths in chunks(batches, encode):
            keys = find(codes, lengths)
            if len(keys):
                yield _counted(keys, bits)

    return collect


def _write_keys(path: str, kind: str, least: int, frequent: int):
    """Writes the keys that occur ``least`` times, each with whether it is frequent."""
    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        keys, n = joined(frame, "keys", np.uint64), joined(frame, "n", np.uint16)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        at = run_starts(keys)
        n = np.add.reduceat(n[order], at, dtype=np.int64)
        often = n >= frequent
        write_arrays(f"{path}/{kind}-{int(frame['shard'].iloc[0]):05d}", keys[at][n >= least],
                     often[n >= least].astype(np.uint8))
        return pd.DataFrame({"frequent": [int(often.sum())]})

    return merge


def _same(starts: np.ndarray, count: np.ndarray, symbols: np.ndarray, how: Windows) -> np.ndarray:
    """Content hash of every run's segment."""
    data, item = symbols.tobytes(), how.symbol.itemsize
    digest, rest = xxhash.xxh3_64_intdigest, how.length - 1
    return np.fromiter((digest(data[a * item:(a + n + rest) * item], 7) for a, n in
                        zip(starts.tolist(), count.tolist())), np.uint64, len(starts))


class Repeats:
    """The runs of a chunk that have a repeated key."""

    def __init__(self, path: str, bits: int):
        self.bits = bits
        self.coarse, self.grams, self.fine = (HashFiles(path, kind, (np.uint64, np.uint8))
                                              for kind in ("keys", "frequent", "finer"))

    def _find(self, files: HashFiles, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each key is in the files, and whether it is frequent."""
        distinct, back = np.unique(key, return_inverse=True)
        hit, often = files.find(shard_of(distinct, self.bits), distinct)
        return hit[back], often[back].astype(bool)

    def split(self, codes: np.ndarray, lengths: np.ndarray, how: Windows) -> tuple[tuple, tuple]:
        """(start, windows, key) of the runs with a repeated key: those that stay, those with a frequent key."""
        runs = runs_of(codes, lengths, how)
        hit, often = self._find(self.coarse, runs[2])
        return tuple(x[hit & ~often] for x in runs), tuple(x[often] for x in runs)

    def frequent_grams(self, codes: np.ndarray, lengths: np.ndarray, how: Windows) -> np.ndarray:
        """All grams of the runs with a frequent key."""
        _, (starts, count, _) = self.split(codes, lengths, how)
        if not len(starts):
            return np.zeros(0, np.uint64)
        grams = gram_hashes(codes, how.gram)
        return grams[_spans(len(grams), starts, count + how.span - 1)]

    def finer(self, codes: np.ndarray, often: tuple, how: Windows) -> tuple:
        """The runs with a frequent key, keyed anew."""
        return finer_runs(codes, *often[:2], how, lambda grams: self._find(self.grams, grams)[0])

    def of(self, codes: np.ndarray, lengths: np.ndarray, how: Windows):
        kept, often = self.split(codes, lengths, how)
        if not len(often[0]):
            return kept
        finer = self.finer(codes, often, how)
        hit = self._find(self.fine, finer[2])[0]
        return tuple(np.concatenate([a, b[hit]]) for a, b in zip(kept, finer))


def text_hash(text: str | None) -> int:
    return xxhash.xxh3_64_intdigest((text or "").encode("utf-8", "surrogatepass"), 11) >> 1


def order_of(rows: list) -> tuple[np.ndarray, np.ndarray]:
    """Documents' order: id (null last), then text hash."""
    return (np.array([LAST if pd.isna(row) else int(row) for row, _ in rows], np.int64),
            np.array([text_hash(text) for _, text in rows], np.int64))


def _deal(how: Windows, encode: Callable, path: str, bits: int):
    def deal(batches):
        repeats = Repeats(path, bits)
        for rows, codes, symbols, lengths in chunks(batches, encode):
            starts, count, key = repeats.of(codes, lengths, how)
            if not len(starts):
                continue
            same = _same(starts, count, symbols, how)
            ids, texts = order_of(rows)
            begins = np.cumsum(lengths) - lengths
            doc = np.searchsorted(begins + lengths, starts, "right")
            order = np.lexsort((starts - begins[doc], texts[doc], ids[doc], same))
            first = run_starts(same[order])
            times = np.diff(np.append(first, len(order)))
            pick = order[first]
            item, rest = how.symbol.itemsize, how.length - 1
            data = symbols.tobytes()
            yield pd.DataFrame({
                "shard": shard_of(key[pick], bits).astype(np.int32), "key": key[pick].view(np.int64),
                "same": same[pick].view(np.int64), "id": ids[doc[pick]], "text": texts[doc[pick]],
                "start": starts[pick] - begins[doc[pick]], "windows": count[pick].astype(np.int32),
                "times": times,
                "segment": [data[a * item:(a + n + rest) * item] for a, n in zip(starts[pick].tolist(),
                                                                                count[pick].tolist())]})

    return deal


DEALT = "shard int, key long, same long, id long, text long, start long, windows int, times long, segment binary"


class Segments:
    """Distinct segments of some keys: first place, how often, concatenated symbols."""

    def __init__(self, frame: pd.DataFrame, how: Windows):
        self.ids, self.texts = frame["id"].to_numpy(np.int64), frame["text"].to_numpy(np.int64)
        self.starts, self.windows = frame["start"].to_numpy(np.int64), frame["windows"].to_numpy(np.int64)
        self.times = frame["times"].to_numpy(np.int64)
        self.sizes = self.windows + how.length - 1
        self.symbols = np.frombuffer(b"".join(frame["segment"]), how.symbol)
        self.begins = np.cumsum(self.sizes) - self.sizes

    def window_places(self) -> tuple[np.ndarray, np.ndarray]:
        """(segment, place in symbols) of every window."""
        segment = np.repeat(np.arange(len(self.windows)), self.windows)
        within = np.arange(len(segment)) - np.repeat(np.cumsum(self.windows) - self.windows, self.windows)
        return segment, self.begins[segment] + within


def pack_masks(flags: np.ndarray, windows: np.ndarray, how: Windows) -> np.ndarray:
    """One bit per window, ``how.mask`` bytes per segment."""
    wide = np.zeros((len(windows), how.mask * 8), bool)
    segment = np.repeat(np.arange(len(windows)), windows)
    wide[segment, np.arange(len(segment)) - np.repeat(np.cumsum(windows) - windows, windows)] = flags
    return np.packbits(wide, axis=1)


def _judge(how: Windows, path: str, judge: Callable):
    def shard(frame: pd.DataFrame) -> pd.DataFrame:
        number = int(frame["shard"].iloc[0])
        frame = frame.sort_values(["key", "same", "id", "text", "start"], kind="stable", ignore_index=True)
        total = frame.groupby("same", sort=False)["times"].transform("sum")
        frame = frame.assign(times=total)[~frame["same"].duplicated()].reset_index(drop=True)
        masks = np.zeros((len(frame), how.mask), np.uint8)
        # a key with one segment needs no index: two equal windows of one run cannot be, as each
        # holds its smallest gram at the same offset, and a run is the windows of one such place
        firsts = run_starts(frame["key"].to_numpy())
        members = np.diff(np.append(firsts, len(frame)))
        chosen = np.nonzero(np.repeat(members > 1, members))[0]
        several = frame.iloc[chosen]
        if len(several):
            sizes, key = (several["windows"] + how.length - 1).to_numpy(), several["key"].to_numpy()
            firsts = run_starts(key)
            cost = np.add.reduceat(sizes, firsts)
            block = np.repeat((np.cumsum(cost) - cost) // BLOCK, np.diff(np.append(firsts, len(key))))
            at = run_starts(block)
            for a, b in zip(at, [*at[1:], len(several)]):
                own = Segments(several.iloc[a:b], how)
                masks[chosen[a:b]] = pack_masks(judge(own, how), own.windows, how)
        same = frame["same"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(same)
        write_arrays(f"{path}/verdict-{number:05d}", same[order],
                     *(frame[c].to_numpy(np.int64)[order] for c in ("id", "text", "start", "times")), masks[order])
        return pd.DataFrame({"segments": [len(frame)]})

    return shard


def verdict_type(how: Windows) -> tuple:
    return (np.uint64, np.int64, np.int64, np.int64, np.int64, np.dtype((np.uint8, how.mask)))


def judge_segments(texts: DataFrame, how: Windows, encode: Callable, judge: Callable) -> tuple[str, int]:
    """Runs passes 1 and 2 over (id, text); returns where the files are and the number of shard bits."""
    path = shared_dir(texts.sparkSession, "llm-windows")
    bits = max(5, 1 + math.ceil(math.log2(max(1, texts.rdd.getNumPartitions()))))

    def write(kind: str, least: int, pick: Callable) -> int:
        counted = texts.mapInPandas(_count(how, encode, bits, pick), COUNTED)
        written = counted.groupBy("shard").applyInPandas(_write_keys(path, kind, least, how.frequent), "frequent long")
        return written.agg(F.sum("frequent")).first()[0] or 0

    def grams():
        repeats = Repeats(path, bits)
        return lambda codes, lengths: repeats.frequent_grams(codes, lengths, how)

    def finer():
        repeats = Repeats(path, bits)

        def keys(codes, lengths):
            _, often = repeats.split(codes, lengths, how)
            return repeats.finer(codes, often, how)[2] if len(often[0]) else often[2]

        return keys

    if write("keys", 2, lambda: lambda codes, lengths: runs_of(codes, lengths, how)[2]):
        write("frequent", how.frequent, grams)
        write("finer", 2, finer)
    dealt = texts.mapInPandas(_deal(how, encode, path, bits), DEALT)
    dealt.groupBy("shard").applyInPandas(_judge(how, path, judge), "segments long").agg(F.sum("segments")).first()
    return path, bits


class Verdicts:
    """Pass 3: for a chunk, its repeated runs with their verdicts."""

    def __init__(self, path: str, bits: int, how: Windows):
        self.how, self.bits = how, bits
        self.repeats, self.files = Repeats(path, bits), HashFiles(path, "verdict", verdict_type(how))

    def of(self, codes: np.ndarray, symbols: np.ndarray, lengths: np.ndarray):
        """(start, windows, first id, text, start, times, window flags) of the runs with a repeated key."""
        starts, count, key = self.repeats.of(codes, lengths, self.how)
        same = _same(starts, count, symbols, self.how)
        shard = shard_of(key, self.bits)
        order = np.lexsort((same, shard))
        _, *columns = self.files.find(shard[order], same[order])
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        ids, texts, firsts, times, masks = (c[back] for c in columns)
        flags = np.unpackbits(masks, axis=1)[:, :self.how.span].astype(bool)
        return starts, count, ids, texts, firsts, times, flags


def covered(size: int, starts: np.ndarray, count: np.ndarray, removed: np.ndarray, length: int) -> np.ndarray:
    """Which of ``size`` symbols lie in a removed window; removed has a row of window flags per run."""
    removed = removed & (np.arange(removed.shape[1]) < count[:, None])
    edges = np.zeros(size + 1, np.int32)
    begin = removed.copy()
    begin[:, 1:] &= ~removed[:, :-1]
    run, within = np.nonzero(begin)
    np.add.at(edges, starts[run] + within, 1)
    removed[:, :-1] &= ~removed[:, 1:]  # the last of each stretch of windows
    run, within = np.nonzero(removed)
    np.add.at(edges, starts[run] + within + length, -1)
    return np.cumsum(edges[:size]) > 0
