"""Cosine channels against brute force, and fusion by hand."""

import math
import random

from pairloom.operators import fusion


def grams_of(title):
    words = [f" {w} " for w in title.split(" ") if w]
    return [w[i : i + n] for w in words for n in (3, 4, 5) for i in range(len(w) - n + 1)]


def brute(a, b, top, least):
    """cosine_channel over lists of (key, title), by measuring all pairs."""
    a, b = ({x for x in rows if x[1] is not None} for rows in (a, b))
    df = {}
    for _, t in b:
        for g in set(grams_of(t)):
            df[g] = df.get(g, 0) + 1

    def vector(title):
        got = {}
        for g in grams_of(title):
            if df.get(g, 0) >= fusion.MIN_DF:
                got[g] = got.get(g, 0) + 1
        got = {g: (1 + math.log(n)) * (math.log((len(b) + 1) / (df[g] + 1)) + 1) for g, n in got.items()}
        norm = math.sqrt(sum(w * w for w in got.values())) or 1
        return {g: w / norm for g, w in got.items()}

    of_b = [(k, vector(t)) for k, t in b]
    out = []
    for key, title in a:
        v = vector(title)
        near = sorted((-round(sum(w * u.get(g, 0) for g, w in v.items()), 9), k) for k, u in of_b)
        out += [(key, k, -c, n) for n, (c, k) in enumerate([x for x in near if -x[0] >= least][:top], 1)]
    return sorted(out)


def test_channel_equals_brute_force(spark):
    rng = random.Random(5)
    words = ["tomato", "tomatoes", "sauce", "saucy", "tea", "green", "grean", "organic", "a", "oz"]
    title = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(1, 5)))
    a = [(i, title()) for i in range(40)] + [(100, None), (101, ""), (102, "zzz"), (0, "green tea")]
    b = [(i, title()) for i in range(60)] + [(200 + i, "green tea") for i in range(9)] + [(300, None), (301, ""), (302, None)]
    a, b = a + a[:3], b + b[:3]
    frames = spark.createDataFrame(a, "row_key long, title string"), spark.createDataFrame(b, "b_index long, title string")
    for top, least in ((5, 0.7), (200, 0.3)):
        got = sorted((r.row_key, r.b_index, r.cosine, r.rank) for r in fusion.cosine_channel(*frames, fusion.character_grams, top, least).collect())
        want = brute(a, b, top, least)
        assert [x[:2] + x[3:] for x in got] == [x[:2] + x[3:] for x in want] and all(abs(x[2] - y[2]) < 1e-8 for x, y in zip(got, want, strict=True))
    none = frames[1].where("false")
    assert fusion.cosine_channel(frames[0], none, fusion.character_grams, 5).collect() == []


def test_fusion_keeps_protected_pairs_and_breaks_ties(spark):
    kind = "row_key long, b_index long, rank int"
    words = spark.createDataFrame([(1, i, i) for i in range(1, 71)] + [(2, 9, 1), (2, 9, 4), (2, 8, 2)], kind)
    core = spark.createDataFrame([(2, 8, 1), (2, 9, 2)], kind)
    exact = spark.createDataFrame([(1, i, 400 + i) for i in range(100, 120)], kind)
    got = {}
    for r in fusion.fused({"words": words, "core": core, "exact": exact}, {"words": 1.0, "core": 1.0, "exact": 0.1}).collect():
        got.setdefault(r.row_key, []).append((r.rank, r.b_index, r.channels, r.protected, r.score))
    assert [x[1] for x in sorted(got[2])] == [8, 9] and {x[4] for x in got[2]} == {round((1 / 61 + 1 / 62) * 1e12) / 1e12}
    kept = sorted(got[1])
    assert len(kept) == fusion.KEPT_WITH_PROTECTED and [x[1] for x in kept[:60]] == list(range(1, 61)) and [x[1] for x in kept[60:]] == list(range(100, 115)) and all(x[3] for x in kept[60:])
