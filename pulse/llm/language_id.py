"""Language identification by interpolated Kneser-Ney character models.

Characters.  A text is lower-cased; letters and marks stand for themselves,
every run of other characters is one space, one space ends the text, and
``ORDER - 1`` start marks stand before it.  Every character but the start
marks is predicted from the ``ORDER - 1`` before it.

Counting.  Tasks count the n-grams of their labelled texts per language and
pass on every distinct one with its number; Spark adds them up.  All other
tables follow from that one by aggregation and joins on n-grams: lower orders
count the distinct characters before an n-gram, contexts count their total
and their distinct followers, and every order has the discount n1 / (n1 + 2
n2).  p(c | h) = max(count - D, 0) / total(h) + D types(h) / total(h) *
p(c | shorter h), down to 1 / (alphabet + 1), which an unknown character gets.

Model.  Per language, sorted 64-bit n-gram hashes with two columns, the log
probability and the log weight that is passed on to the shorter context.
Files lie in the shared folder, dealt by hash; workers map them and search
only n-grams their task has not met before.

Decision.  The language with the lowest cross-entropy per character wins (the
smaller name of equals).  One learning text in ``FOLDS`` (by text hash, so that
copies stay together) calibrates: a second model without those texts scores
them.  From the result come the temperature at which the languages' likelihoods
fit best as probabilities, which gives ``score``, and per language the usual
entropy, its spread by length and the ``REJECT`` quantile of the standardised
excess; a text above that is ``rejected`` as not being in its language.

Null texts and texts without a letter are ``und`` with score 0; so is every
text if nothing was learned.  Rows without language or text teach nothing;
repeated rows count each; texts are never cut (memory is bounded by a chunk
of ``CHUNK`` characters or the longest text); empty tables give empty results.
Other columns are not read.  The driver sees a few numbers per language.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import save, ship, table
from pulse.llm.hash_files import HashFiles, mix64, run_starts, sum_runs, write_arrays
from pulse.session import shared_dir

ship(__name__)

ORDER = 5
FOLDS = 8
REJECT = 0.999
CHUNK = 1_000_000
#: Distinct n-grams a counting task holds, and n-grams a scoring task remembers.
HELD, KNOWN = 4_000_000, 1_000_000
FILE_ROWS = 2_000_000
START, SPACE = 2, 32
TEMPERATURES = [2.0 ** k for k in range(11)]
ENTRY = (np.uint64, np.float64, np.float64)


def character_kinds() -> np.ndarray:
    """By code point: 2 letter, 1 mark, 0 other."""
    kind = {"L": 2, "M": 1}
    return np.array([kind.get(unicodedata.category(chr(c))[0], 0) for c in range(sys.maxunicode + 1)], np.uint8)


class Characters:
    """Texts as arrays of code points, made once per task."""

    def __init__(self):
        self.kinds = character_kinds()

    def read(self, texts: list[str | None], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(codes, predicted characters per text, whether a text has a letter)."""
        head = np.full(order - 1, START, np.uint32)
        parts, tail = [], np.array([SPACE], np.uint32)
        for text in texts:
            parts += [head, np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32), tail]
        codes = np.concatenate(parts)
        lengths = np.array([len(p) for p in parts]).reshape(-1, 3)
        edges = np.cumsum(lengths.sum(axis=1))
        first = np.repeat(edges - lengths.sum(axis=1), order - 1) + np.tile(np.arange(order - 1), len(texts))
        kind = self.kinds[codes]
        lettered = np.add.reduceat(kind == 2, np.append(0, edges[:-1])) > 0
        mark = np.zeros(len(codes), bool)
        mark[first] = True
        space = (kind == 0) & ~mark
        codes = np.where(space, np.uint32(SPACE), codes)
        keep = np.ones(len(codes), bool)
        keep[1:] = ~(space[1:] & (space[:-1] | mark[:-1]))
        kept = np.add.reduceat(keep, np.append(0, edges[:-1]), dtype=np.int64) - (order - 1)
        return codes[keep], kept, lettered


def hashed(codes: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of rows of n codes; n may be 0."""
    h = np.full(len(codes), n + 1, np.uint64)
    for k in range(n):
        h = h * np.uint64(0x9E3779B97F4A7C15) + codes[:, k] + np.uint64(1)
    return mix64(h)


def grams(codes: np.ndarray, sizes: np.ndarray, order: int) -> np.ndarray:
    """A view with one row of ``order`` codes per predicted character, text by text."""
    every = np.lib.stride_tricks.sliding_window_view(codes, order) if len(codes) >= order else np.zeros((0, order), np.uint32)
    ends = np.cumsum(sizes + order - 1)
    at = np.arange(sizes.sum()) + np.repeat(ends - sizes - (order - 1) - (np.cumsum(sizes) - sizes), sizes)
    return every[at]


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= CHUNK:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _count(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        characters, groups, held = Characters(), {}, []

        def merged() -> tuple:
            key, number, n, rows = (np.concatenate(x) for x in zip(*held))
            at = np.argsort(key, kind="stable")
            firsts = run_starts(key[at])
            pick = at[firsts]
            return key[pick], number[pick], sum_runs(n[at], firsts), rows[pick]

        def out(key, number, n, rows) -> pa.RecordBatch:
            names = list(groups)
            text = np.ascontiguousarray(rows).view(f"<U{order}").ravel().astype(object)
            return pa.RecordBatch.from_arrays(
                [pa.array([names[g][0] for g in number.tolist()], pa.string()),
                 pa.array([names[g][1] for g in number.tolist()], pa.bool_()), pa.array(text, pa.string()),
                 pa.array(n, pa.int64())], names=["lang", "trial", "gram", "n"])

        for batch in batches:
            texts, labels = batch.column(0).to_pylist(), zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            number = np.array([groups.setdefault(x, len(groups)) for x in labels], np.int64)
            for x, y in _chunks(texts):
                codes, sizes, _ = characters.read(texts[x:y], order)
                rows = grams(codes, sizes, order)
                group = np.repeat(number[x:y], sizes)
                key = hashed(rows, order) ^ mix64(group.astype(np.uint64))
                place, distinct = pd.factorize(key)
                first = np.empty(len(distinct), np.int64)
                first[place[::-1]] = np.arange(len(key))[::-1]
                held.append((distinct, group[first], np.bincount(place, minlength=len(distinct)), rows[first]))
                if sum(len(h[0]) for h in held) > HELD:
                    held = [merged()]
                    if len(held[0][0]) > HELD // 2:
                        yield out(*held[0])
                        held = []
        if held:
            yield out(*merged())

    return run


def _tables(counted: DataFrame, order: int) -> tuple[DataFrame, DataFrame]:
    """((model, lang, gram, logp, logw) entries, (model, lang, letters)); model 0
    is learned from everything, model 1 without the calibration texts."""
    own = ["model", "lang"]
    models = F.when(F.col("trial"), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))
    top = save(counted.withColumn("model", F.explode(models)).groupBy(*own, "gram").agg(F.sum("n").alias("c")), "grams")
    levels = [top]
    for n in range(order, 1, -1):
        # every row is a distinct n-gram, so rows per ending are distinct characters before it
        levels.append(save(levels[-1].groupBy(*own, F.substring("gram", 2, n - 1).alias("gram"))
                           .agg(F.count(F.lit(1)).alias("c")), "grams"))
    letters = levels[-1].groupBy(*own).agg(F.count(F.lit(1)).alias("letters"))
    below = letters.select(*own, F.lit("").alias("ending"), (1 / (F.col("letters") + 1)).alias("q"))
    entries = None
    for n, level in enumerate(reversed(levels), start=1):
        once, twice = (F.sum((F.col("c") == k).cast("long")) for k in (1, 2))
        discount = level.groupBy(*own).agg((F.when((once > 0) & (twice > 0), once / (once + 2 * twice))
                                            .otherwise(0.5)).alias("d"))
        cut = level.select(*own, "gram", "c", F.substring("gram", 1, n - 1).alias("context"),
                           F.substring("gram", 2, n - 1).alias("ending"))
        contexts = cut.groupBy(*own, "context").agg(F.sum("c").alias("total"), F.count(F.lit(1)).alias("types"))
        passed = contexts.join(discount, own).withColumn("w", F.col("d") * F.col("types") / F.col("total"))
        known = save(cut.join(passed, [*own, "context"]).join(below, [*own, "ending"]).select(
            *own, "gram", (F.greatest(F.col("c") - F.col("d"), F.lit(0.0)) / F.col("total")
                           + F.col("w") * F.col("q")).alias("q")), "gram-probabilities")
        below = known.withColumnRenamed("gram", "ending")
        none = F.lit(None).cast("double")
        rows = known.select(*own, "gram", F.log("q").alias("logp"), none.alias("logw")).unionByName(
            passed.select(*own, F.col("context").alias("gram"), none.alias("logp"), F.log("w").alias("logw")))
        entries = rows if entries is None else entries.unionByName(rows)
    return entries.groupBy(*own, "gram").agg(F.max("logp").alias("logp"), F.max("logw").alias("logw")), letters


def _codes(text: pd.Series) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length: places of the n-grams and their codes as rows."""
    length = text.str.len().to_numpy()
    return {int(n): (at, np.array(text.iloc[at].tolist(), f"<U{max(int(n), 1)}").view(np.uint32).reshape(len(at), -1)
                     if n else np.zeros((len(at), 0), np.uint32))
            for n in np.unique(length) for at in [np.nonzero(length == n)[0]]}


def _with_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in batches:
        key = np.zeros(len(frame), np.uint64)
        for n, (at, codes) in _codes(frame["gram"]).items():
            key[at] = hashed(codes, n)
        yield frame.drop(columns="gram").assign(key=key.view(np.int64))


def _write(path: str, numbers: dict):
    def write(frame: pd.DataFrame) -> pd.DataFrame:
        head = frame.iloc[0]
        key = frame["key"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(key)
        kind, shard = f"{head['model']}-{numbers[head['lang']]}", int(head["shard"])
        write_arrays(f"{path}/{kind}-{shard:05d}", key[order], frame["logp"].to_numpy(np.float64)[order],
                     frame["logw"].to_numpy(np.float64)[order])
        return pd.DataFrame({"kind": [kind], "shard": [shard]})

    return write


@dataclass
class Model:
    """A trained model's place and its few numbers; the arrays stay in their files."""

    path: str
    order: int
    shards: int
    langs: list[str]
    letters: dict  # (model, lang) -> distinct characters
    files: dict  # kind -> shard numbers
    temperature: float = 1.0
    usual: dict = None  # lang -> (entropy, spread, cut)


def _fit(counted: DataFrame, order: int) -> Model:
    spark = counted.sparkSession
    entries, letters = _tables(counted, order)
    entries = save(entries, "gram-entries")
    letters = {(r["model"], r["lang"]): r["letters"] for r in letters.collect()}  # a row per language and model
    langs = sorted({lang for _, lang in letters})
    path = shared_dir(spark, "llm-language")
    shards = 1 << max(0, (entries.count() // FILE_ROWS).bit_length())
    keyed = entries.mapInPandas(_with_keys, "model int, lang string, logp double, logw double, key long")
    written = (keyed.withColumn("shard", F.pmod("key", F.lit(shards))).groupBy("model", "lang", "shard")
               .applyInPandas(_write(path, {lang: i for i, lang in enumerate(langs)}), "kind string, shard int"))
    files: dict[str, set] = {}
    for row in written.collect():  # a row per file
        files.setdefault(row["kind"], set()).add(row["shard"])
    return Model(path, order, shards, langs, letters, files)


class Scorer:
    """Log likelihoods of n-grams in all languages, remembered per task."""

    def __init__(self, model: Model, number: int):
        self.model, self.characters = model, Characters()
        self.langs = [lang for lang in model.langs if (number, lang) in model.letters]
        self.files = [HashFiles(model.path, kind, ENTRY, model.files.get(kind, set()))
                      for kind in (f"{number}-{model.langs.index(lang)}" for lang in self.langs)]
        self.unknown = [-np.log(model.letters[number, lang] + 1) for lang in self.langs]
        self._forget()

    def _forget(self) -> None:
        self.index, self.values = pd.Index(np.zeros(0, np.uint64)), [np.zeros(0) for _ in self.langs]

    def _find(self, files: HashFiles, key: np.ndarray) -> list[np.ndarray]:
        shard = (key % np.uint64(self.model.shards)).astype(np.int64)
        order = np.lexsort((key, shard))
        out = []
        for x in files.find(shard[order], key[order]):
            back = np.empty_like(x)
            back[order] = x
            out.append(back)
        return out

    def _likelihood(self, rows: np.ndarray, which: int) -> np.ndarray:
        value, left = np.zeros(len(rows)), np.arange(len(rows))
        for n in range(self.model.order, 0, -1):
            found, logp, _ = self._find(self.files[which], hashed(rows[left, self.model.order - n:], n))
            found &= ~np.isnan(logp)  # a context that is never predicted itself
            value[left[found]] += logp[found]
            left = left[~found]
            held, _, weight = self._find(self.files[which], hashed(rows[left, self.model.order - n:-1], n - 1))
            value[left] += np.where(held, np.nan_to_num(weight), 0.0)
        value[left] += self.unknown[which]
        return value

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(predicted characters, has a letter, negative log likelihood by language and text)."""
        codes, sizes, lettered = self.characters.read(texts, self.model.order)
        rows = grams(codes, sizes, self.model.order)
        key = hashed(rows, self.model.order)
        if len(self.index) > KNOWN:
            self._forget()
        at = self.index.get_indexer(key)
        new = np.nonzero(at < 0)[0]
        if len(new):
            place, distinct = pd.factorize(key[new])
            first = np.empty(len(distinct), np.int64)
            first[place[::-1]] = new[::-1]
            at[new] = len(self.index) + place
            self.values = [np.append(v, self._likelihood(rows[first], i)) for i, v in enumerate(self.values)]
            self.index = self.index.append(pd.Index(distinct))
        used = np.nonzero(sizes)[0]
        starts = (np.cumsum(sizes) - sizes)[used]
        total = np.zeros((len(self.langs), len(texts)))
        for i, value in enumerate(self.values):
            if len(used):
                total[i, used] = -np.add.reduceat(value[at], starts)
        return sizes, lettered, total


def _entropies(model: Model):
    """Calibration texts under the model that does not know them."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = None
        for frame in batches:
            scorer = scorer or Scorer(model, 1)
            texts = frame["text"].tolist()
            for x, y in _chunks(texts):
                n, lettered, total = scorer.score(texts[x:y])
                own = np.array([scorer.langs.index(v) if v in scorer.langs else -1 for v in frame["lang"].iloc[x:y]])
                use = np.nonzero(lettered & (own >= 0))[0]
                total, own, n = total[:, use], own[use], n[use]
                mine = total[own, np.arange(len(use))] if len(use) else np.zeros(0)
                least = total.min(axis=0) if len(use) else mine
                out = {"lang": frame["lang"].iloc[x:y].to_numpy()[use], "n": n, "h": mine / n}
                for i, t in enumerate(TEMPERATURES):
                    out[f"t{i}"] = (mine - least) / t + np.log(np.exp((least - total) / t).sum(axis=0))
                yield pd.DataFrame(out)

    return run


def _calibrate(model: Model, texts: DataFrame) -> None:
    fits = ", ".join(f"t{i} double" for i in range(len(TEMPERATURES)))
    seen = save(texts.select("lang", "text").mapInPandas(_entropies(model), f"lang string, n long, h double, {fits}"),
                "calibration")
    losses = seen.agg(*[F.avg(f"t{i}") for i in range(len(TEMPERATURES))]).first()
    if losses[0] is not None:
        model.temperature = TEMPERATURES[int(np.argmin(losses))]
    mean = seen.groupBy("lang").agg((F.sum(F.col("h") * F.col("n")) / F.sum("n")).alias("m"))
    off = F.col("h") - F.col("m")
    spread = seen.join(mean, "lang").groupBy("lang", "m").agg(F.sqrt(F.avg(F.col("n") * off * off)).alias("s"))
    excess = off * F.sqrt("n") / F.greatest(F.col("s"), F.lit(1e-9))
    cut = seen.join(spread, "lang").groupBy("lang", "m", "s").agg(F.percentile_approx(excess, REJECT, 10_000).alias("cut"))
    model.usual = {r["lang"]: (r["m"], max(r["s"], 1e-9), r["cut"]) for r in cut.collect()}  # a row per language


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", order: int = ORDER) -> Model:
    """Learns from the rows that have a text and a language."""
    text, lang = F.col(f"`{text_col}`"), F.col(f"`{lang_col}`").cast("string")
    trial: Column = F.pmod(F.xxhash64(text), F.lit(FOLDS)) == 0
    taught = docs.select(text.alias("text"), lang.alias("lang"), trial.alias("trial")).filter(
        F.col("text").isNotNull() & F.col("lang").isNotNull())
    counted = taught.mapInArrow(_count(order), "lang string, trial boolean, gram string, n long")
    model = _fit(counted, order)
    model.usual = {}
    if model.langs:
        _calibrate(model, taught.filter("trial"))
    return model


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
             flag: str | None = None) -> DataFrame:
    """One row per input row: id, (flag,) lang_pred, score, entropy (nats a character), rejected."""
    picked = docs.select(F.col(f"`{id_col}`").alias("id"), *([F.col(f"`{flag}`").alias("flag")] if flag else []),
                         F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = None
        for frame in batches:
            scorer = scorer or Scorer(model, 0)
            texts = frame["text"].tolist()
            for x, y in _chunks(texts):
                out = frame.iloc[x:y].drop(columns="text")
                n, lettered, total = scorer.score(texts[x:y])
                if not scorer.langs:
                    yield out.assign(lang_pred="und", score=0.0, entropy=None, rejected=False)
                    continue
                best = total.argmin(axis=0)
                least = total[best, np.arange(y - x)]
                sure = 1 / np.exp((least - total) / model.temperature).sum(axis=0)
                h = least / np.maximum(n, 1)
                m, s, cut = (np.array([model.usual.get(lang, (0.0, 1.0, np.inf))[i] for lang in scorer.langs])[best]
                             for i in range(3))
                yield out.assign(lang_pred=np.where(lettered, np.array(scorer.langs, object)[best], "und"),
                                 score=np.where(lettered, sure, 0.0), entropy=np.where(lettered, h, np.nan),
                                 rejected=lettered & ((h - m) * np.sqrt(n) / s > cut))

    kind = picked.schema["id"].dataType.simpleString()
    return picked.mapInPandas(run, f"id {kind}, " + ("flag boolean, " if flag else "")
                              + "lang_pred string, score double, entropy double, rejected boolean")


def op12_query(spark, sf_dir: str) -> DataFrame:
    number = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", (number % 4 == 2).alias("held_out"))
    model = train(docs.filter(~F.col("held_out")))
    return identify(docs, model, flag="held_out").select(
        F.col("id").alias("doc_id"), F.col("flag").alias("held_out"), "lang_pred", "score", "rejected")
