import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from pairloom.llm import passages as P

from .conftest import words


def found(df):
    """Rows of documents with passages, by id; all rows of df are there."""
    rows = P.passage_classes(df).collect()
    assert sorted(map(str, (r.doc_id for r in rows))) == sorted(str(r[0]) for r in df.select("doc_id").collect())
    assert all((r.class_id, r.n_links, r.n_words, r.passages) == (r.doc_id, 0, 0, "") for r in rows if not r.n_passages)
    return {r.doc_id: r for r in rows if r.n_passages}


def test_windows_hold_every_long_passage_once():
    rng = np.random.default_rng(2)
    for sizes in ([90], [3, 40, 5, 1, 60], [4], [5]):
        h = np.concatenate([[0], *([*rng.integers(1, 50, n), 0] for n in sizes)]).astype(np.uint64)
        got = P.windows(h, 5).tolist()
        assert all(r - a >= 4 and 0 not in h[a : r + 1] for a, _, r in got)
        for i in range(len(h)):
            for j in range(i + 4, len(h)):
                if h[i : j + 1].min() > 0:
                    c = i + int(h[i : j + 1].argmin())
                    assert sum(a <= i and j <= r and k == c for a, k, r in got) == 1


def test_every_exact_repeat_is_found(docs, rows):
    texts = {r[0]: (r[1] or "").encode().lower().split() for r in rows if r[0] is not None}
    own = defaultdict(set)
    for d, w in texts.items():
        for i in range(len(w) - P.WORDS + 1):
            own[tuple(w[i : i + P.WORDS])].add(d)
    got = found(docs)
    want = defaultdict(set)
    for d, w in texts.items():
        for i in range(len(w) - P.WORDS + 1):
            if len(own[tuple(w[i : i + P.WORDS])]) > 1:
                want[d] |= set(range(i, i + P.WORDS))
    assert set(want) <= set(got)
    for d, places in want.items():
        spans = [tuple(map(int, s.split(":"))) for s in got[d].passages.split(",")]
        assert places <= {x for a, b in spans for x in range(a, b)}
    assert not set(got) & set(range(2, 30))
    assert {got[d].class_id for d in (30, 31, 32)} == {30} and {got[d].class_id for d in range(33, 45)} == {33}


def test_near_passages_and_clean_texts(spark):
    rng = random.Random(8)
    base = words(rng, 150)
    near = list(base)
    near[20], near[70] = "changed", "altered"
    far = [w if i % 6 else "other" for i, w in enumerate(base)]
    rows = [(1, " ".join(words(rng, 60) + base)), (2, " ".join(near)), (3, " ".join(far)), (4, " ".join(words(rng, 400)))]
    got = found(spark.createDataFrame(rows, "doc_id long, text string"))
    assert set(got) == {1, 2} and got[2].class_id == 1
    assert got[1].passages.startswith("60:")


def test_repetitive_texts_and_empty_table(spark, no_docs):
    text = "the same few words again and again " * 30
    rows = [(5, text), (6, text), (7, None), (8, ""), (None, text)]
    got = {d: (r.class_id, r.passages) for d, r in found(spark.createDataFrame(rows, "doc_id long, text string")).items()}
    assert got == {5: (5, "0:210"), 6: (5, "0:210")}
    assert P.passage_classes(no_docs).collect() == []


def test_stretches_are_merged():
    assert P.merged([(0, 0, 99), (1, 50, 149), (1, 60, 70), (0, 300, 310)]) == [(0, 150), (300, 311)]


def test_bands_hold_every_passage_once():
    """Each passage of LEAST tokens has its two least hashes in exactly one stretch of a band, whose key stands for them."""
    rng = np.random.default_rng(4)
    joined = np.concatenate([[0], *([*rng.integers(1, 2**62, n), 0] for n in (46, 90, 200))]).astype(np.uint64)
    borders = np.flatnonzero(joined == 0)
    for key, left, _, right, band in P._bands(joined, borders):
        h = [np.maximum(P.remixed(joined, fn + 1), 1) for fn in (2 * band, 2 * band + 1)]
        least_of = {}
        for i in range(len(joined) - P.LEAST + 1):
            if (joined[i : i + P.LEAST] > 0).all():
                least = tuple(int(x[i : i + P.LEAST].min()) for x in h)
                at = tuple(i + int(x[i : i + P.LEAST].argmin()) for x in h)
                held = [k for k, a, r in zip(key.tolist(), left.tolist(), right.tolist(), strict=True) if a <= i and i + P.LEAST - 1 <= r and all(a <= c <= r and x[a : r + 1].min() == v for x, c, v in zip(h, at, least, strict=True))]
                assert len(set(held)) == 1 and least_of.setdefault(least, held[0]) == held[0]


def test_group_of_ten(spark):
    """Two documents share 50 words; others, with smaller and larger ids, share one five-word stretch of it with them for each function."""
    rng = random.Random(77)
    passage = words(rng, 50)
    tokens = P.tokens_of(" ".join(passage))
    rows = [(d, " ".join([*words(rng, 100), *passage, *words(rng, 50)])) for d in (50, 60)]
    for fn in range(2 * P.BANDS):
        at = int(np.maximum(P.remixed(tokens, fn + 1), 1).argmin())
        rows += [(d, " ".join([*words(rng, 80), *passage[at : at + 5], *words(rng, 80)])) for d in (10 + fn, 90 + fn)]
    got = found(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {d: (r.class_id, r.passages, r.n_links) for d, r in got.items()} == {50: (50, "100:150", 1), 60: (50, "100:150", 1)}


@pytest.mark.parametrize("batch", [3, 512])
def test_common_keys_are_split(spark, monkeypatch, batch):
    """Parts of common keys and small batches change no class."""
    monkeypatch.setattr(P, "SAMPLE", 1)
    monkeypatch.setattr(P, "HOT_ROWS", 4)
    monkeypatch.setattr(P, "HOT_LINKS", 2)
    monkeypatch.setattr(P, "small_batches", lambda spark: spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch)))
    rng = random.Random(9)
    passage, other = words(rng, 80), words(rng, 60)
    rows = [(d, " ".join([*words(rng, 20), *passage, *words(rng, 20)])) for d in range(40)] + [(100 + d, " ".join([*words(rng, 60), *other])) for d in range(3)] + [(200 + d, " ".join(words(rng, 90))) for d in range(20)]
    got = found(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {d: r.class_id for d, r in got.items()} == {d: 0 for d in range(40)} | {d: 100 for d in range(100, 103)}
    for r in got.values():  # neighbours may be equal by chance
        a, b = map(int, r.passages.split(":"))
        assert (18 <= a <= 20 and 100 <= b <= 102) if r.doc_id < 100 else (58 <= a <= 60 and b == 120)


def test_recall_against_brute_force(spark):
    """Near passages, over whole texts of all pairs that share any shingles to speak of."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: P.tokens_of(r.text) for r in docs.select("doc_id", "text").collect()}
    own, seen, shared = defaultdict(list), set(), Counter()
    for d, t in sorted(texts.items()):
        if len(t) >= P.LEAST and t.tobytes() not in seen:
            seen.add(t.tobytes())
            for h in np.unique(t).tolist():
                own[h].append(d)
    for ids in own.values():
        shared.update(itertools.combinations(ids, 2))
    want = [(a, b, s) for (a, b), n in shared.items() if n >= 30 for s in P.verified(texts[a], texts[b], [(0, len(texts[a]))])]
    got = found(docs)
    assert len(want) > 100
    same = [a in got and b in got and got[a].class_id == got[b].class_id for a, b, _ in want]
    assert sum(same) >= 0.98 * len(want)
    covered = []
    for a, b, (a0, a1, b0, b1) in want:
        for d, x, y in ((a, a0, a1 + P.SHINGLE - 1), (b, b0, b1 + P.SHINGLE - 1)):
            spans = [tuple(map(int, s.split(":"))) for s in got[d].passages.split(",")] if d in got else []
            covered.append(sum(max(0, min(y, q) - max(x, p)) for p, q in spans) >= 0.9 * (y - x))
    assert sum(covered) >= 0.9 * len(covered)


def test_passage_of_pieces_that_are_common_elsewhere(spark):
    """Two documents in the middle of the id range share 60 words; both halves stand in many documents on either side."""
    rng = random.Random(21)
    rows, want = [], {}
    for g in range(12):
        one, two = words(rng, 30), words(rng, 30)
        inside = 5000 + 2 * g
        own = [(inside, one + two), (inside + 1, one + two), *((100 * g + k + side, piece) for side in (0, 9000) for k, piece in enumerate([one, two] * 4))]
        rows += [(d, " ".join([*words(rng, 70), *piece, *words(rng, 70)])) for d, piece in own]
        want |= {inside: inside, inside + 1: inside}
    got = found(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {d: r.class_id for d, r in got.items()} == want
    assert all(any(int(a) <= 70 and 130 <= int(b) for a, b in (s.split(":") for s in r.passages.split(","))) for r in got.values())


@pytest.mark.parametrize("turned", [False, True])
def test_an_id_with_several_texts_is_its_least(spark, turned):
    """Classes, links and spans of an id come from one text: here the least of 7's is a near copy of 2's, or one of 1's."""
    rng = random.Random(11)
    x, y = (" ".join(words(rng, 120)) for _ in range(2))
    rows = [(1, f"m {x}"), (7, f"z {x}"), (7, f"a0 {y}"), (2, f"n {y}")] if not turned else [(1, f"m {x}"), (7, f"a0 {x}"), (7, f"z {y}"), (2, f"n {y}")]
    got = {r.doc_id: r.class_id for r in P.passage_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == ({1: 1, 2: 2, 7: 2} if not turned else {1: 1, 2: 2, 7: 1})


@pytest.mark.parametrize("bucket", [16, 3])
def test_pairs_in_the_middle_of_a_group(spark, monkeypatch, bucket):
    """Eight texts share a line, so they have keys in common; only two of them, neither first nor next to each other, share a passage.  In a small group all pairs meet, in a larger one those that share more than the line."""
    monkeypatch.setattr(P, "BUCKET", bucket)
    rng = random.Random(0)
    w = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    line, x, y = w(32), w(12), w(12)
    rows = []
    for k in range(8):
        a, b = (x, y) if k in (2, 5) else (w(12), w(12))
        if k == 5:
            a = [*a[:8], "changed", *a[9:]]
        rows.append((k, " ".join(w(30) + a + line + b + w(30))))
    tokens = [P.tokens_of(t) for _, t in rows]
    keys = [{k for key, *_ in P._bands(np.concatenate([[np.uint64(0)], t, [np.uint64(0)]]).astype(np.uint64), np.array([0, len(t) + 1])) for k in key.tolist()} for t in tokens]
    groups = [[d for d in range(8) if k in keys[d]] for k in keys[2] & keys[5]]
    assert groups and all(g[0] != 2 and g[g.index(5) - 1] != 2 for g in groups)
    got = found(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {d: r.class_id for d, r in got.items()} == {2: 2, 5: 2}


def test_pairs_apart_share_as_much_as_a_passage(spark):
    """Texts of a key that differ in about five of eight places, with words that others have as well: only those meet whose stretches hold enough in common."""
    rng = random.Random(4)
    base, texts = [f"b{k}" for k in range(60)], []
    for _ in range(100):
        own = list(base)
        for place in range(3, 60, 7):
            own[place] = f"x{place}_{rng.randrange(3)}"
        texts.append(" ".join(own))
    tokens = [P.tokens_of(t) for t in texts]
    true = {(a, b) for a in range(100) for b in range(a) if P.verified(tokens[a], tokens[b], [(0, len(tokens[a]))])}
    rows = spark.createDataFrame(list(enumerate(texts)), "doc long, text string")
    crowds = spark.createDataFrame([(1, d, len(tokens[d]) - 1 << 4) for d in range(100)], "key long, doc long, place long")
    got = {(r.doc, r.other) for r in P._apart(rows, crowds, spark.createDataFrame([], "node long, component long")).collect()}
    assert true and true <= got and len(got) <= 100 * 99 // 2 // 2


def test_least_number_of_different_tokens():
    rng = np.random.default_rng(0)
    for _ in range(200):
        t = rng.integers(0, rng.integers(1, 200), rng.integers(1, 150)).astype(np.uint64)
        assert P._distinct(t) == min(len(set(t[i : i + P.LEAST].tolist())) for i in range(max(1, len(t) - P.LEAST + 1)))
