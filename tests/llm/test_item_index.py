"""The index of benchmark items: who meets whom, and where it is joined."""

import random
import re

from pulse.llm import decontaminate


def test_fingerprints_within_the_radius_meet(spark):
    rng = random.Random(8)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    flip = lambda x, n: x ^ sum(1 << b for b in rng.sample(range(64), n))
    items = [(k, rng.choice((20, 30)), rng.getrandbits(64)) for k in range(20)]
    items += [(20, *items[3][1:]), (None, *items[4][1:])]
    windows = [(d, rng.choice((20, 30)), d % 3, 25, flip(rng.choice(items)[2], rng.randrange(0, 22))) for d in range(150)]
    windows += [(200 + k, *windows[5][1:]) for k in range(40)] + [(None, *windows[6][1:])]
    w = spark.createDataFrame([(*r[:4], signed(r[4])) for r in windows], "doc long, length int, start int, cut long, fp long")
    i = spark.createDataFrame([(*r[:2], signed(r[2])) for r in items], "item long, length int, fp long")
    got = decontaminate._near(w, i, ["doc", "start", "length"], 15).collect()
    want = [(d, s, n, c, k) for d, n, s, c, f in windows for k, m, g in items if m == n and (f ^ g).bit_count() <= 15]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_the_index_is_not_held_by_the_driver(spark, capsys, monkeypatch):
    rng = random.Random(9)
    texts = [" ".join(f"w{rng.randrange(300)}" for _ in range(40)) for _ in range(6)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame([(k, t[20:120]) for k, t in enumerate(texts[:3])], "item_id long, text string")
    capsys.readouterr()

    def explained(df, name, store=decontaminate.save):
        df.explain(mode="extended")
        return store(df, name)

    monkeypatch.setattr(decontaminate, "save", explained)
    decontaminate.benchmark_matches(docs, items).explain(mode="extended")
    plans = capsys.readouterr().out
    assert re.search(r"SortMergeJoin \[length#\d+, block#", plans)
    assert not re.search(r"BroadcastHashJoin \[length#\d+, block#", plans)
