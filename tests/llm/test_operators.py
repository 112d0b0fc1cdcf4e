"""Every operator against its plain version, on rows with nulls, blanks, repeats, ties and clashing columns."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulse.llm import (bwt_merge, decontaminate, fm_index, license_scan, line_dedup, mixing, ngram_lm, quality_rules,
                       simhash_dedup, substring_dedup, suffix_dedup, windows)
from pulse.llm.components import connected_components
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, label long, site string"


def corpus():
    rng = random.Random(7)
    vocabulary = ["".join(rng.choices("abcdefghé", k=rng.randint(2, 7))) for _ in range(300)]
    say = lambda n: " ".join(rng.choices(vocabulary, k=n))
    passage = say(60)
    rows = [(i, say(rng.randint(1, 90)).capitalize() + ".\n" + say(rng.randint(0, 40)), "en", f"s{i % 3}") for i in range(40)]
    long = say(150)
    rows += [(100 + i, long, "en", "s1") for i in range(4)]
    for i in range(4):
        w = long.split()
        w[rng.randrange(150)] = "edited"
        rows.append((110 + i, " ".join(w), "fr", None))
    rows += [(120 + i, f"{say(30)} {passage}\n{say(10)}", None, "s2") for i in range(3)]
    rows += [(130, " ".join(["same words here"] * 40), "en", "s0"), (131, "a " * 300, "en", "s0"),
             (140, None, "en", "s0"), (141, "", None, None), (142, " \t\n\x0b\x0c\r ", "en", "s0"), (143, "one", "en", "s0"),
             (None, say(50), "en", "s0"), (None, None, None, None), (150, "x y ZÉ z", "en", "s0"),
             (5, rows[5][1], "en", "s2"), (6, "other text of the same id", "en", "s0")]
    return [(*r, len(r[1] or ""), "clash", 1, "site") for r in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def rows():
    return corpus()


def test_simhash_groups(docs, rows):
    got = simhash_dedup.near_duplicate_groups(docs).collect()
    marked = [(r[0], brute.simhash(r[1])) for r in rows]
    least = brute.components(marked)
    want = collections.Counter((d, f - (1 << 64) if f >> 63 else f, least[f]) for d, f in marked)
    assert collections.Counter((r["id"], r["fp"], r["component_id"]) for r in got) == want
    kept = simhash_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({least[f] for _, f in marked} | {f for _, f in marked if least[f] is None})
    assert simhash_dedup.near_duplicate_groups(docs.limit(0)).count() == 0
    assert simhash_dedup.keep_one(docs.limit(0)).count() == 0


@pytest.mark.parametrize("bits, bucket", [(1, 2048), (2, 2048), (2, 3), (3, 4)])
def test_links_connect_what_is_near(spark, bits, bucket):
    rng = random.Random(bits * 10 + bucket)
    fps = set()
    for _ in range(12):
        f = rng.getrandbits(64)
        for _ in range(12):
            fps.add(f)
            f ^= 1 << rng.randrange(64)
            if rng.random() < 0.3:
                f ^= 1 << rng.randrange(64)
    signed = {f: f - (1 << 64) if f >> 63 else f for f in fps}
    df = spark.createDataFrame([(x,) for x in signed.values()], "fp long")
    found = {r["node"]: r["label"] for r in connected_components(simhash_dedup.fingerprint_links(df, bits, bucket)).collect()}
    want = brute.components([(signed[f], f) for f in fps], bits)
    assert {f: found.get(signed[f], signed[f]) for f in fps} == want


def test_quality_base_counts_and_verdicts(docs, rows):
    got = quality_rules.judge(docs, carry=(F.col("doc_id"), F.col("text"))).collect()
    assert len(got) == len(rows)
    for r in got:
        base = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
        assert base == brute.base_counts(r["_c1"])
        assert not (r["kept"] and r["base_failed"])
    assert quality_rules.keep_good(docs).columns == docs.columns
    assert quality_rules.judge(docs.limit(0)).count() == 0


def test_quality_rejects_outliers_and_keeps_the_usual(spark):
    rng = random.Random(3)
    text = lambda end="": " ".join("".join(rng.choices("abcdef", k=rng.randint(2, 8))) + end for _ in range(80))
    usual = [(i, text(), "en", "hot") for i in range(300)]
    copies = [(1000 + i, usual[0][1], "en", "hot") for i in range(150)]
    odd = [(2000 + i, text("###"), "en", "hot") for i in range(20)]
    few = [(3000 + i, text(), "de", "rare") for i in range(3)]
    df = spark.createDataFrame(usual + copies + odd + few, "doc_id long, text string, lang string, source string")
    got = {r["_c0"]: r["kept"] for r in quality_rules.judge(df.repartition(5), carry=(F.col("doc_id"),)).collect()}
    assert all(got[i] for i in got if i < 2000 or i >= 3000)
    assert not any(got[2000 + i] for i in range(20))


def test_estimate_matches_numpy(spark):
    rng = np.random.default_rng(5)
    data = np.round(rng.multivariate_normal([1, 2, 0, 1], np.diag([.2, .5, .3, .4]) + .1, 400) * 1000).astype(int)
    data[:60] += 9000
    df = spark.createDataFrame([("g", *map(int, x)) for x in data], "g string, q0 long, q1 long, q2 long, q3 long")
    row = quality_rules.estimates(df).first()
    x = data / 1000
    floor = np.array(quality_rules.FLOOR) ** 2

    def fit(part):
        return part.mean(0), np.cov(part.T, bias=True) + np.diag(floor)

    def dist(m, c):
        d = x - m
        return np.einsum("ij,jk,ik->i", d, np.linalg.inv(c), d)

    q = np.percentile(data, [25, 50, 75], axis=0)
    m, c = q[1] / 1000, np.diag(np.maximum((q[2] - q[0]) / 1349, np.sqrt(floor)) ** 2)
    bins = lambda d: np.floor(64 * np.log1p(d))
    for _ in range(quality_rules.STEPS):
        b = bins(dist(m, c))
        m, c = fit(x[b <= np.ceil(np.percentile(b, 60))])
    d = dist(m, c)
    spread = max((np.exp((np.percentile(bins(d), 50) + .5) / 64) - 1) / quality_rules.CHI_HALF, 1)
    m, c = fit(x[d <= quality_rules.CHI_TRIM * spread])
    assert np.allclose([row[f"m{i}"] for i in range(4)], m, atol=1e-6)
    factor = np.linalg.cholesky(c)
    assert np.allclose([row[f"l{i}{j}"] for i in range(4) for j in range(i + 1)],
                       [factor[i, j] for i in range(4) for j in range(i + 1)], atol=1e-6)


def test_line_dedup_rules(spark):
    rows = [(i, f"menu  \nbody {i}\n\n menu\nfoot", "a", "x") for i in range(8)] + [(20, "menu\nfoot\nx", "b", "x")]
    rows += [(30, None, "a", "x"), (31, "", None, "x"), (32, " menu", "a", "x")] + [(40 + i, "menu", None, "x") for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lines string").repartition(3)
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in line_dedup.drop_boilerplate(df, counts=True).collect()}
    assert got[3] == ("body 3\n", 4, 3)
    assert got[20] == ("menu\nfoot\nx", 3, 0)  # a site of one page keeps its lines
    assert got[30] == (None, 0, 0) and got[31] == ("", 0, 0) and got[32] == ("", 1, 1) and got[41] == ("", 1, 1)
    assert line_dedup.drop_boilerplate(df).columns == df.columns
    assert line_dedup.drop_boilerplate(df.limit(0)).count() == 0


def test_mixing(docs, rows):
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    sizes, taken, target = collections.Counter(), collections.Counter(), {}
    for r in rows:
        sizes[r[3]] += len(brute.WORD.findall(r[1] or ""))
    want = brute.targets(sizes)
    for r in got:
        taken[r["source"]] += r["size"] * r["copies"]
        target[r["source"]] = r["target"]
        assert r["source_size"] == sizes[r["source"]] and 0 <= r["copies"] <= 3
    assert target == pytest.approx(want)
    # the null source has four texts of 150 words and a target of 617
    assert all(abs(taken[s] - target[s]) <= (20 if s is None else 5) for s in target)
    again = mixing.mix(docs.repartition(7)).collect()
    key = lambda r: (r["id"], r["size"], r["copies"], r["source"])
    assert collections.Counter(map(key, got)) == collections.Counter(map(key, again))
    assert mixing.mix(docs.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_fit_reaches_the_budget(seed):
    rng = np.random.default_rng(seed)
    lengths = np.unique(rng.integers(0 if seed else 1, 400, 40))
    counts = rng.integers(1, 30, len(lengths))
    total = int((lengths * counts).sum())
    for budget in (0, 1, total // 3, total // 2, total - 1):
        take = mixing.fit(lengths, counts, budget)
        assert (take >= 0).all() and (take <= counts).all()
        used = int((take * lengths).sum())
        assert abs(used - budget) <= (lengths[lengths > 0].min() if min(budget, total - budget) < 1000 else 2)


def test_language_model(spark, docs, rows):
    number = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    split = docs.withColumn("held", number % 5 == 1)
    model = ngram_lm.train(split.filter("not held"))
    got = ngram_lm.score(split, model, flag="held").collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[2], x[6])
    mine = sorted(((r["id"], r["flag"], r["n_tokens"], r["n_known"], model.tokens, r["base_score"], r["score"]) for r in got), key=key)
    want = sorted(brute.lm_scores([(r[0], r[1]) for r in rows]), key=key)
    assert [x[:5] for x in mine] == [x[:5] for x in want]
    assert np.allclose([x[5:] for x in mine], [x[5:] for x in want])
    empty = ngram_lm.train(docs.limit(0))
    assert all(r["score"] == 0 and r["n_known"] == 0 for r in ngram_lm.score(docs, empty).collect())
    assert ngram_lm.score(docs.limit(0), empty).count() == 0


def test_held_out_text_is_less_surprising_than_by_single_words(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    number = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    model = ngram_lm.train(df.filter(~number))
    base, full = ngram_lm.score(df.filter(number), model).agg(F.sum("base_score"), F.sum("score")).first()
    assert full > base


def test_licences(spark):
    apache = ("Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in "
              "compliance with the License.\nYou may obtain a copy of the License at\n\n")
    rows = [(1, "Text.\nReleased under the MIT License."), (2, "x\n" + apache), (3, None), (4, ""), (5, "no notice here"),
            (6, "All rights\nreserved. Licensed under CC BY-NC 4.0."), (6, "licensed under cc by 4.0!"),
            (7, "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                "that the following conditions are met:\nRedistributions of source code must retain the above copyright "
                "notice, this list of conditions and the following disclaimer.\nRedistributions in binary form must "
                "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
                "documentation and/or other materials provided with the distribution.")]
    df = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, licenses string")
    got = sorted((r["id"], r["licenses"]) for r in license_scan.scan_licenses(df).collect())
    assert got == [(1, "MIT"), (2, ""), (3, ""), (4, ""), (5, ""), (6, "All-Rights-Reserved,CC-BY-NC-4.0"), (6, "CC-BY-4.0"),
                   (7, "BSD-2-Clause")]
    for sentence in license_scan.SENTENCES.values():
        assert any(t in sentence for t in license_scan.TRIGGERS)
    assert license_scan.scan_licenses(df.limit(0)).count() == 0


APACHE = """Copyright [yyyy] [name of copyright owner]

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
GPL = """{who} is free software; you can redistribute it and/or
modify it under the terms of the GNU {less}General Public License
as published by the Free Software Foundation; either version {v}
of the License, or (at your option) any later version.

{who} is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU {less}General Public License for more details.

You should have received a copy of the GNU {less}General Public License
along with this program; if not, write to the Free Software Foundation, Inc.,
51 Franklin Street, Fifth Floor, Boston, MA  02110-1301, USA.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/.
"""


def test_official_notices(spark):
    gpl2 = GPL.format(who="This program", less="", v="2")
    in_marks = lambda mark, text: "".join(f"{mark} {line}".rstrip() + "\n" for line in text.splitlines())
    cases = [(f"code\n\n{text}" if not mark else f"/*\n{in_marks(mark, text)} */\nint x = 0;\n", licence)
             for text, licence in [(APACHE, "Apache-2.0"), (APACHE.replace("http:", "https:"), "Apache-2.0"),
                                   (gpl2, "GPL-2.0-or-later"), (MPL, "MPL-2.0"),
                                   (GPL.format(who="This library", less="Lesser ", v="2.1"), "LGPL-2.1-or-later")]
             for mark in ("", "#", " *", "//", ";;", "!", "dnl", "REM")]
    cases += [(APACHE.replace("\n", "\r\n"), "Apache-2.0"),
              ("// SPDX-License-Identifier: Apache-2.0\nint x;", "Apache-2.0"), ("/* SPDX-License-Identifier: mit */", "MIT"),
              ("# SPDX-License-Identifier: GPL-2.0 WITH Linux-syscall-note", "GPL-2.0-only"),
              ("SPDX-License-Identifier: (GPL-2.0+ OR BSD-3-Clause)\nx", "BSD-3-Clause,GPL-2.0-or-later"),
              ("<!-- SPDX-License-Identifier: EUPL-1.2 -->", "EUPL-1.2"), ("SPDX-License-Identifier: NONE", ""),
              ("x; // SPDX-License-Identifier: 0BSD AND (MIT OR Zlib). Text", "0BSD,MIT,Zlib")]
    df = spark.createDataFrame([(k, text) for k, (text, _) in enumerate(cases)], "doc_id long, text string")
    got = {r["id"]: r["licenses"] for r in license_scan.scan_licenses(df).collect()}
    assert [(text, got[k]) for k, (text, _) in enumerate(cases)] == cases
    for sentence in license_scan.NOTICES:
        assert any(t in sentence for t in license_scan.TRIGGERS)


def test_decontamination(spark):
    rng = random.Random(11)
    say = lambda n: [f"w{rng.randrange(400)}" for _ in range(n)]
    items = [say(n) for n in (12, 30, 30, 55)] + [["only", "three", "words"]]
    bench = [(i, " ".join(w)) for i, w in enumerate(items)] + [(0, " ".join(items[0])), (8, None), (9, " ")]
    near = list(items[3])
    near[27] = "changed"
    far = list(items[1])
    far[5], far[15], far[25] = "a", "b", "c"
    docs = [(1, " ".join(say(50) + items[0] + say(9))), (2, "; ".join(x.upper() for x in items[1])), (3, " ".join(say(20) + near)),
            (4, " ".join(far + say(30))), (5, " ".join(say(80))), (6, None), (7, ""), (8, "Only three... words"),
            (1, " ".join(say(50))), (2, "; ".join(x.upper() for x in items[1])), (None, " ".join(items[2]))]
    d = spark.createDataFrame([(*r, "x", 5) for r in docs], "doc_id long, text string, start string, doc long").repartition(3)
    b = spark.createDataFrame(bench, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontaminate.benchmark_matches(d, b).collect()}
    assert set(got) == {(1, 0), (2, 1), (3, 3), (8, 4), (None, 2)}
    assert got[1, 0] == 1 and got[3, 3] == pytest.approx(46 / 56)
    left = decontaminate.drop_contaminated(d, b)
    assert left.columns == d.columns
    assert sorted((r["doc_id"] for r in left.collect())) == [1, 4, 5, 6, 7]
    assert decontaminate.benchmark_matches(d.limit(0), b).count() == 0
    assert decontaminate.benchmark_matches(d, b.limit(0)).count() == 0


def test_decontamination_judges_every_window(spark):
    rng = random.Random(5)
    say = lambda n, kinds=400: [f"w{rng.randrange(kinds)}" for _ in range(n)]
    items = [say(100), say(60), ["a", "b"] * 20, say(70), say(9)]
    swapped = items[0][50:] + items[0][:50]
    thirds = items[3][45:] + items[3][20:45] + items[3][:20]
    docs = [say(30) + swapped + say(40), swapped, say(12) + items[1][3:30] + ["x"] + items[1][30:] + say(8),
            items[1][4:] + say(30), say(20) + items[1][:-4], ["a", "b"] * 50 + say(5), say(40) + ["b", "a"] * 17, say(9) + thirds,
            say(8) + thirds[:60], say(200), items[2][:30], items[4] + say(3) + items[4], say(7) + items[3][35:] + items[3][:35]]
    want = {pair: x for pair, x in brute.window_matches(docs, items).items() if x >= 0.8}
    assert (0, 0) in want and (1, 0) in want  # no diagonal window of these reaches 0.8
    d = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(docs)], "doc_id long, text string")
    b = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    found = decontaminate.benchmark_matches(d, b).collect()
    assert {(r["doc_id"], r["item_id"]): r["similarity"] for r in found} == pytest.approx(want)
    left = {r["doc_id"] for r in decontaminate.drop_contaminated(d, b).collect()}
    assert left == set(range(len(docs))) - {k for k, _ in want}


@pytest.mark.parametrize("frequent", [windows.FREQUENT, 3])
def test_repeated_bytes(docs, rows, frequent):
    got = suffix_dedup.remove_repeats(docs, length=40, gram=8, stride=10, frequent=frequent).collect()
    mine = collections.Counter((r["id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got)
    want = collections.Counter((r[0], *x) for r, x in zip(rows, brute.bytes_removed([r[1] for r in rows], 40)))
    assert mine == want
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_contexts_of_a_frequent_passage_spread():
    rng, how = np.random.default_rng(3), windows.Windows(20, 4, np.uint64)
    say = lambda n: rng.integers(1, 1 << 62, n, dtype=np.uint64)
    passage = say(12)
    lengths = np.full(300, 72)
    codes = np.concatenate([np.concatenate([say(30), passage, say(30)]) for _ in lengths])
    starts, count, key = windows.runs_of(codes, lengths, how)
    assert np.unique(key, return_counts=True)[1].max() > 100
    known = np.unique(windows.gram_hashes(passage, how.gram))
    _, again, finer = windows.finer_runs(codes, starts, count, how, lambda grams: np.isin(grams, known))
    assert np.unique(finer, return_counts=True)[1].max() == 1
    assert again.sum() == count.sum()


@pytest.mark.parametrize("frequent", [windows.FREQUENT, 3])
def test_repeated_word_windows(docs, rows, frequent):
    got = substring_dedup.remove_repeats(docs, window=8, gram=4, frequent=frequent).collect()
    mine = collections.Counter((r["id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got)
    want = brute.words_removed([(r[0], r[1]) for r in rows], 8)
    assert mine == collections.Counter((r[0], *want[r[0], r[1]]) for r in rows)
    assert substring_dedup.remove_repeats(docs.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_backward_search(seed):
    rng = np.random.default_rng(seed)
    text = np.append(rng.integers(0, 3 + 40 * seed, 300), 0)
    index = fm_index.FMIndex(text, int(text.max()) + 1, 6)
    for _ in range(50):
        at = int(rng.integers(0, 290))
        n = int(rng.integers(1, 6))
        pattern = text[at:at + n]
        if (pattern == 0).any():
            continue
        low, high = np.array([0]), np.array([len(text)])
        for symbol in pattern[::-1]:
            low, high = index.extend(np.array([symbol]), low, high)
        places = sorted(i for i in range(len(text) - n + 1) if (text[i:i + n] == pattern).all())
        assert sorted(index.order[low[0]:high[0]]) == places


@pytest.mark.parametrize("seed", range(5))
def test_merged_transforms(seed):
    rng = np.random.default_rng(seed)
    parts, depth = [], 5
    for _ in range(4):
        parts.append(np.concatenate([np.append(rng.integers(1, 3 + seed, rng.integers(1, 30)), 0) for _ in range(6)]))
    orders, transforms = [], []
    for text in parts:
        before = np.zeros_like(text)
        before[1:] = text[:-1]
        order, rows = bwt_merge.transform(text, before, depth)
        orders.append(order)
        transforms.append(rows)
    source, common = bwt_merge.merge(transforms, depth)
    at = [0] * 4
    heads = []
    for k in source:
        i = orders[k][at[k]]
        at[k] += 1
        head = parts[k][i:i + depth]
        heads.append(tuple(head[:list(head).index(0)]) if 0 in head else tuple(head))
    full = [i for i, h in enumerate(heads) if len(h) == depth]
    assert [heads[i] for i in full] == sorted(heads[i] for i in full)
    for i in full:
        if i and len(heads[i - 1]) == depth:
            shared = next((k for k in range(depth) if heads[i][k] != heads[i - 1][k]), depth)
            assert common[i] == shared
