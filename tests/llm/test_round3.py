"""Alignment, language identification and clustering against plain versions."""

import collections
import hashlib
import math
import random
import unicodedata

import numpy as np
import pytest

from pulse.llm import hadamard_kmeans, language_id, token_align

VECTORS = "vec_id long, embedding array<float>, id string, v int, cluster string, distance string"


def plain_clusters(rows, k=16, rounds=3):
    kept = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    centroids = [v for _, v in start[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        members = collections.defaultdict(list)
        for _, v in kept:
            members[near(v)[1]].append(v)
        centroids = [[sum(x) // len(members[j]) for x in zip(*members[j])] if members[j] else c
                     for j, c in enumerate(centroids)]
    return sorted(((i, near(v)[1], near(v)[0]) for i, v in kept), key=str), centroids


def vectors():
    rng = random.Random(3)
    f32 = lambda x: float(np.float32(x))
    rows = [(i, [f32(rng.gauss(rng.choice((-1, 0, 1)) * (i % 5), 0.4)) for _ in range(64)]) for i in range(300)]
    rows += [rows[7], rows[7], (7, rows[8][1]), (None, rows[9][1]), (None, rows[9][1])]
    rows += [(400, None), (401, []), (402, [1.0] * 63), (403, [1.0] * 65), (404, [1.0] * 63 + [None]),
             (405, [1.0] * 63 + [float("nan")]), (406, [1.0] * 63 + [float("-inf")]), (407, [0.0] * 64), (408, [-0.0] * 64),
             (409, [1000.0, -1000.0] * 32)]
    return rows


def test_clusters_equal_full_search(spark):
    rows = vectors()
    df = spark.createDataFrame([(*r, "x", 1, "c", "d") for r in rows], VECTORS).repartition(5)
    got, centroids = hadamard_kmeans.cluster(df)
    want, expected = plain_clusters(rows)
    assert centroids.tolist() == expected
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_few_or_no_vectors(spark):
    df = spark.createDataFrame([(*r, "x", 1, "c", "d") for r in vectors()], VECTORS)
    got, centroids = hadamard_kmeans.cluster(df.filter("vec_id between 3 and 7 or vec_id > 399"))
    assert sorted(r["distance"] for r in got.collect()) == [0] * got.count() and len(centroids) <= got.count()
    none, centroids = hadamard_kmeans.cluster(df.filter("vec_id between 400 and 406"))
    assert none.count() == 0 and len(centroids) == 0


@pytest.mark.parametrize("spread", [1, 4, 300, hadamard_kmeans.LIMIT])
def test_progressive_search_is_exact(spread):
    rng = np.random.default_rng(spread)
    v, c = (rng.integers(-spread, spread + 1, (n, 64)) for n in (400, 16))
    c[5], c[9] = c[2], v[3]
    number, distance = hadamard_kmeans.nearest(hadamard_kmeans.transform(v), hadamard_kmeans.transform(c))
    full = ((v[:, None] - c[None]) ** 2).sum(axis=2)
    assert (number == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()


def test_clustering_query_covers_the_table(spark):
    path = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    want, centroids = plain_clusters(rows)
    got = hadamard_kmeans.op13_query(spark, path).collect()
    assert sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in got), key=str) == want
    inertia = collections.Counter()
    for _, c, d in want:
        inertia[c] += d
    for r in got:
        assert (r["cluster_inertia"], r["inertia"]) == (inertia[r["cluster"]], sum(inertia.values()))
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centroids[r["cluster"]])).encode()).hexdigest()


@pytest.fixture(scope="module")
def sides():
    import sentencepiece
    import tokenizers
    a = tokenizers.Tokenizer.from_file(token_align.BYTE_BPE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=token_align.PIECE_BPE)


def spans(sides, text):
    """[(id, start, end)] of both sides, or two empty lists."""
    a, b = sides
    of = token_align.byte_characters()
    left = [(i, bytes(of[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    piece = lambda i: (bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
                       else b.id_to_piece(i).replace("▁", " ").encode())
    right = [(i, piece(i)) for i in b.encode(text)]
    whole = (" " + text).encode()
    if b"".join(x for _, x in left) != whole or b"".join(x for _, x in right) != whole:
        return [], []
    out = []
    for side in (left, right):
        at, placed = 0, []
        for i, x in side:
            placed.append((i, at, at + len(x)))
            at += len(x)
        out.append(placed)
    return tuple(out)


def plain_alignment(sides, texts):
    rows, count = [], collections.Counter()
    for text in texts:
        a, b = spans(sides, text) if text else ([], [])
        links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        count.update(links)
        cuts = sorted({x[2] for x in a} & {y[2] for y in b})
        groups = [""] * len(cuts)
        begin = 0
        for k, cut in enumerate(cuts):
            inside = lambda side: ",".join(str(x[0]) for x in side if begin <= x[1] and x[2] <= cut)
            groups[k] = f"{inside(a)}|{inside(b)}"
            begin = cut
        rows.append((len(a), len(b), len(cuts), links, ";".join(groups)))
    best = {}
    for (_, y), n in count.items():
        best[y] = max(best.get(y, 0), n)
    return [(n, m, g, len(links), groups, sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links))
            for n, m, g, links, groups in rows]


TEXTS = [None, "", " ", "a", "\n\n\n", "Hello world, hello World!", "naïve café — “quotes” … 1234567", "x\x00y", "tab\tand\r\nline",
         "two  spaces   three", " leading and trailing ", "日本語のテキスト と English", "😀😀 emoji👩‍👩‍👧 family", "▁ the mark itself ▁▁", "<|endoftext|> <s> </s> <unk> <0x41>",
         "ǅ ɏ ɐ ʰ ① ½ ² Ⅷ", "a" * 3000, " " * 2500 + "end", "can't we'll I'm they'VE", " nbsp em　ideographic", "café combining",
         "ﬁ ligature", "Hello world, hello World!", "‮right​zero", "العربية والعبرية עברית हिन्दी ไทย"]


def test_alignment(spark, sides):
    df = spark.createDataFrame([(i % 20, t, "g", 1) for i, t in enumerate(TEXTS)], "doc_id int, text string, groups string, n_a int").repartition(3)
    aligned = token_align.save(token_align.align(df), "test-aligned")
    got = token_align.link_strength(aligned, token_align.pair_counts(aligned))
    want = plain_alignment(sides, TEXTS)
    columns = ["id", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]
    assert sorted(tuple(r[c] for c in columns) for r in got.collect()) == sorted((i % 20, *w) for i, w in enumerate(want))
    assert sum(1 for w in want if w[0]) > 10
    empty = token_align.align(df.limit(0))
    assert empty.count() == 0
    assert token_align.link_strength(empty, token_align.pair_counts(empty)).count() == 0


def test_common_characters_take_either_encoder(sides):
    a, _ = sides
    own = token_align.ByteLevel(open(token_align.BYTE_BPE, "rb").read())
    assert own.fast is not None
    rng = random.Random(1)
    every = [chr(c) for c in range(0x250)]
    texts = ["".join(f"a{c} {c}{c}1{c}x" for c in every[i:i + 37]) for i in range(0, len(every), 37)]
    texts += ["".join(rng.choices(every, k=60)) for _ in range(200)]
    for text in texts:
        assert token_align.COMMON.fullmatch(text)
        assert own.encode(text)[0].tolist() == a.encode(" " + text, add_special_tokens=False).ids


def test_alignment_query_covers_the_table(spark, sides):
    path = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    few = sorted(docs, key=lambda d: len(d[1] or ""))[:150]
    frame = spark.createDataFrame(few, "doc_id long, text string")
    aligned = token_align.save(token_align.align(frame), "test-aligned")
    got = {r["id"]: r for r in token_align.link_strength(aligned, token_align.pair_counts(aligned)).collect()}
    for (d, _), w in zip(few, plain_alignment(sides, [t for _, t in few])):
        assert tuple(got[d][c] for c in ("n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum")) == w
    whole = token_align.op11_query(spark, path).collect()
    assert sorted(r["doc_id"] for r in whole) == sorted(d for d, _ in docs)
    for r in whole:
        if r["doc_id"] in got:
            text = got[r["doc_id"]]["groups"]
            assert r["groups_sha256"] == (hashlib.sha256(text.encode()).hexdigest() if text else "")
            assert r["n_links"] == got[r["doc_id"]]["n_links"]


def test_missing_file_of_counts_is_an_error(tmp_path):
    from pulse.llm.hash_files import HashFiles
    one = np.zeros(1, np.int64)
    assert not HashFiles(str(tmp_path), "pair", (np.uint64, np.int64), set()).find(one, one.astype(np.uint64))[0][0]
    with pytest.raises(FileNotFoundError):
        HashFiles(str(tmp_path), "pair", (np.uint64, np.int64), {0}).find(one, one.astype(np.uint64))


def characters(text):
    """(start marks and characters, whether there is a letter)."""
    kinds = [(c, unicodedata.category(c)[0]) for c in (text or "").lower()]
    words = "".join(c if k in "LM" else " " for c, k in kinds).split(" ")
    body = " ".join(w for w in words if w)
    return "\x02" * 4 + (body + " " if body else ""), any(k == "L" for _, k in kinds)


class PlainModel:
    def __init__(self, texts):
        count = collections.Counter()
        for t in texts:
            chars, _ = characters(t)
            count.update(chars[i - 4:i + 1] for i in range(4, len(chars)))
        self.levels = {5: count}
        for n in (4, 3, 2, 1):
            self.levels[n] = collections.Counter(g[1:] for g in self.levels[n + 1])
        self.contexts = {n: collections.defaultdict(list) for n in self.levels}
        self.d = {}
        for n, level in self.levels.items():
            for g, c in level.items():
                self.contexts[n][g[:-1]].append(c)
            once, twice = (sum(c == k for c in level.values()) for k in (1, 2))
            self.d[n] = once / (once + 2 * twice) if once and twice else 0.5

    def p(self, g):
        if not g:
            return 1 / (len(self.levels[1]) + 1)
        n, lower = len(g), self.p(g[1:])
        seen = self.contexts[n].get(g[:-1])
        if not seen:
            return lower
        return (max(self.levels[n].get(g, 0) - self.d[n], 0) + self.d[n] * len(seen) * lower) / sum(seen)

    def loss(self, text):
        chars, _ = characters(text)
        return -sum(math.log(self.p(chars[i - 4:i + 1])) for i in range(4, len(chars)))


LANGUAGES = "doc_id int, text string, lang string, n int, gram string, score string"


def labelled():
    rng = random.Random(11)
    stock = {"xx": "ab aba baab ébé aab bba".split(), "yy": "kol loki klo òk ilo lo".split(), "zz": "abk lob kéa oba".split()}
    say = lambda lang, n: " ".join(rng.choices(stock[lang], k=n)).capitalize() + rng.choice([".", "!", " 12", "\n\n", ""])
    rows = [(i, say(lang, rng.randint(1, 30)), lang) for i, lang in enumerate(list(stock) * 30)]
    rows += [(200, say("xx", 5), None), (201, None, "xx"), (202, "", "yy"), (203, " \t\n", "zz"), (204, "123 -- !", "xx"),
             (205, "日本 語", None), (206, "́", "zz"), (207, "İSTANBUL ß", None), (None, say("yy", 20), None),
             (3, rows[3][1], rows[3][2]), (208, say("zz", 4000), "zz"), (209, "\x02a\x02", None)]
    return rows


def test_language_models_equal_plain_ones(spark):
    rows = labelled()
    df = spark.createDataFrame([(*r, 1, "g", "s") for r in rows], LANGUAGES).repartition(4)
    model = language_id.train(df)
    plain = {lang: PlainModel([t for _, t, la in rows if la == lang and t is not None]) for lang in ("xx", "yy", "zz")}
    got = language_id.identify(df, model).collect()
    assert len(got) == len(rows)
    want = {}
    for i, text, _ in rows:
        chars, lettered = characters(text)
        loss = {lang: m.loss(text) for lang, m in plain.items()}
        best = min(sorted(loss), key=lambda k: loss[k])
        want[i] = (best, loss[best] / (len(chars) - 4)) if lettered else ("und", None)
    for r in got:
        lang, entropy = want[r["id"]]
        assert r["lang_pred"] == lang and 0 <= r["score"] <= 1
        assert entropy is None or r["entropy"] == pytest.approx(entropy, rel=1e-9)
        assert lang != "und" or (r["score"] == 0 and not r["rejected"])
    assert {r["id"] for r in got if r["rejected"]} >= {205}


def test_language_without_learning_or_texts(spark):
    df = spark.createDataFrame([(*r, 1, "g", "s") for r in labelled()], LANGUAGES)
    none = language_id.train(df.filter("lang is null"))
    assert {(r["lang_pred"], r["score"]) for r in language_id.identify(df, none).collect()} == {("und", 0.0)}
    one = language_id.train(df.filter("doc_id = 0"))
    assert {r["lang_pred"] for r in language_id.identify(df, one).collect()} == {"xx", "und"}
    assert language_id.identify(df.limit(0), one).count() == 0
    assert language_id.train(df.limit(0)).langs == []


def test_language_query_on_held_out_documents(spark):
    path = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    got = language_id.op12_query(spark, path).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(truth)
    held = [r for r in got if r["held_out"] and r["lang_pred"] != "und"]
    right = sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held)
    assert right > 0.97, right
    assert sum(r["rejected"] for r in got) < 0.05 * len(got)
