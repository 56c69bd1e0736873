import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pairloom.llm import common, simhash
from pairloom.llm.common import connected_components, counted, written


def brute_fingerprint(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return 0
    got = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    count = [0] * 64
    for s in got:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            count[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * count[b] > len(got))


def brute_components(fps):
    """fps: list of (id, fingerprint); smallest id by single linkage at two bits."""
    part = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i][1] ^ fps[j][1]).count("1") <= 2 and part[i] != part[j]:
                a, b = part[i], part[j]
                part = [b if x == a else x for x in part]
    least = {}
    for (doc, _), p in zip(fps, part, strict=True):
        if doc is not None:
            least[p] = min(doc, least.get(p, doc))
    return [least.get(p) for p in part]


def test_equals_brute_force(docs, rows):
    fps = [(r[0], brute_fingerprint(r[1])) for r in rows]
    want = sorted((str(d), f"{f:016x}", str(c)) for (d, f), c in zip(fps, brute_components(fps), strict=True))
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash.simhash_components(docs).collect())
    assert got == want


def test_empty_table(no_docs):
    assert simhash.simhash_components(no_docs).collect() == []
    assert simhash.near_copies(no_docs).collect() == []


@pytest.mark.parametrize("bucket", [0, 2, 1000])
def test_links_connect_what_is_near(spark, monkeypatch, bucket):
    """Paired and dense buckets give the same components as brute force, in a dense group and in noise."""
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = np.random.default_rng(bucket)
    fps = {int(x) for x in rng.integers(-(2**63), 2**63 - 1, 60)} | {-1, 0, 1, -(2**63)}
    centre = int(rng.integers(0, 2**62))
    for _ in range(60):
        x = centre
        for b in rng.integers(0, 62, 3):
            x ^= 1 << int(b)
        fps.add(x)
    pairs = [(i, f) for i, f in enumerate(sorted(fps))]
    nodes = spark.createDataFrame([(f, i) for i, f in pairs], "fp long, root long")
    comp = {r.node: r.component for r in connected_components(simhash.links(nodes)).collect()}
    assert [comp.get(i, i) for i, _ in pairs] == brute_components([(i, f & (2**64 - 1)) for i, f in pairs])


def test_chain_of_links_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (5, 5)], "a long, b long")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_near_copies_keep_one_of_each_group(docs, rows):
    got = {r.doc_id: r.component_id for r in simhash.near_copies(docs).distinct().collect()}
    assert {got[i] for i in range(33, 45)} == {33}
    assert got[45] == got[46] == 0 and got[47] == got[48] == 1
    assert [got[i] for i in range(2, 33)] == list(range(2, 33))
    assert None not in got


def test_shingle_words_parameter(docs):
    one = {r.id: r.fps for r in simhash.fingerprints(docs.where("doc_id < 5"), shingle_words=1, families=3).collect()}
    assert all(len(set(v)) == 3 for v in one.values())
    assert simhash.fingerprints(docs.select("doc_id", F.lit(None).cast("string").alias("text"))).select("fps").distinct().collect()[0].fps == [0]


def test_texts_of_one_common_word_dont_hide_near_copies(spark):
    """Over half of the tokens are one word, so all texts have one fingerprint; the smallest id is like none of the pairs."""
    rng = np.random.default_rng(4)
    made = []
    for _ in range(21):
        text = [w for x in rng.integers(0, 10**6, 60) for w in ("the", f"w{x}", "the")]
        near = list(text)
        near[1] = "changed"
        made += [text, near]
    rows = [(i, " ".join(t)) for i, t in enumerate(made)]
    got = {r.doc_id: r.component_id for r in simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i // 2 * 2 for i in range(42)}


def test_dense_buckets_are_grouped_again(spark):
    """Texts that share over half of their shingles meet in dense buckets; each near pair among them is a candidate."""
    rng = np.random.default_rng(5)
    common = set(rng.integers(0, 2**31, 300).tolist())
    sets = []
    for _ in range(150):
        own = common | set(rng.integers(0, 2**31, 200).tolist())
        sets += [own, {*sorted(own)[:-10], *rng.integers(0, 2**31, 10).tolist()}]
    texts = spark.createDataFrame([(i, simhash.signature(x)) for i, x in enumerate(sets)], "root long, sig array<int>")
    got = {(r.a, r.b) for r in simhash.band_links(texts).collect()}
    assert sum((2 * i + 1, 2 * i) in got for i in range(150)) >= 149


def test_copies_with_a_block_added_are_found(spark):
    """A block at the end leaves 0.82 of the shingles in common, but moves many bits of the single words' fingerprints."""
    rng = np.random.default_rng(6)
    rows = []
    for k in range(30):
        text = [f"w{x}" for x in rng.integers(0, 5000, 300)]
        rows += [(2 * k, " ".join(text)), (2 * k + 1, " ".join(text + [f"w{x}" for x in rng.integers(0, 5000, 64)]))]
    got = {r.doc_id: r.component_id for r in simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(got[2 * k + 1] == 2 * k for k in range(30)) >= 29


def test_pairs_of_dense_buckets_meet(spark, monkeypatch):
    """Forty texts share one band and no longer part: links go to the first of them, all other pairs of what is apart have their own way."""
    monkeypatch.setattr(simhash, "BLOCK", 7)
    rng = np.random.default_rng(8)
    texts = spark.createDataFrame([(i, [1, 2, 3, *rng.integers(10, 2**31, 27).tolist()], [i // 2]) for i in range(40)], "root long, sig array<int>, held array<int>")
    links = {(r.a, r.b) for r in simhash.band_links(texts.select("root", "sig")).collect()}
    assert links == {(i, 0) for i in range(1, 40)}
    rows = simhash.dense_buckets(texts).join(texts.select("root", "held"), "root")
    comp = lambda n: spark.createDataFrame([(i, 0) for i in range(n)], "node long, component long")
    got = lambda n, near: sorted((r.a, r.b) for r in simhash.dense_pairs(rows, comp(n), near).collect())
    assert got(0, lambda x, y: x == y) == [(2 * i + 1, 2 * i) for i in range(20)]
    assert got(37, lambda x, y: F.size(x) == F.size(y)) == sorted((a, b) for a in range(40) for b in range(a) if a >= 37)
    assert got(40, lambda x, y: x == y) == []


def test_dense_texts_meet_by_rare_shingles(spark):
    """Of texts that share most shingles but each hold many of their own only the pairs at 0.8 meet, not all pairs."""
    rng = np.random.default_rng(9)
    base, texts = [f"b{x}" for x in range(400)], []
    for k in range(120):
        own = [w for i in range(0, 400, 40) for w in [*base[i : i + 40], *(f"o{x}" for x in rng.integers(0, 10**9, 6 if k % 3 else 12))]]
        texts.append(own)
        if k % 10 == 0:
            texts.append([*own[:200], "changed", *own[201:]])
        if k % 10 == 5:
            texts.append(own[: int(len(own) * 0.85)])
    sets = [set(simhash.shingles([w.encode() for w in t], 5)) for t in texts]
    true = {(a, b) for a in range(len(sets)) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    rows = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "root long, text string")
    dense = rows.select(F.lit(1).cast("long").alias("key"), F.lit(len(texts)).cast("long").alias("n"), "root")
    none = spark.createDataFrame([], "node long, component long")
    got = {(r.a, r.b) for r in simhash.dense_links(dense, rows, none, 0.8, 5).collect()}
    assert len(true) >= 24 and true <= got and len(got) <= 4 * len(true)
    one = rows.select(F.col("root").alias("node"), F.lit(0).cast("long").alias("component"))
    assert simhash.dense_links(dense, rows, one, 0.8, 5).collect() == []


def test_dense_short_texts_below_the_similarity_stay_apart(spark):
    """Texts of 24 words, each with one of a few words in two places, share shingles at every place but most pairs are below 0.8: their marks tell."""
    texts = []
    for k in range(144):
        words = [f"b{x}" for x in range(24)]
        words[8], words[15] = f"x{k % 12}", f"y{k // 12}"
        texts.append([*words, "end"] if k % 12 == 0 else words)
    texts += [[*t, "more"] for t in texts[:20]]
    sets = [set(simhash.shingles([w.encode() for w in t], 5)) for t in texts]
    true = {(a, b) for a in range(len(sets)) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    rows = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "root long, text string")
    dense = rows.select(F.lit(1).cast("long").alias("key"), F.lit(len(texts)).cast("long").alias("n"), "root")
    got = {(r.a, r.b) for r in simhash.dense_links(dense, rows, spark.createDataFrame([], "node long, component long"), 0.8, 5).collect()}
    assert true and true <= got and len(got) <= 3 * len(true)


def test_spark_guesses_no_broadcast(spark):
    # Files of these tables are a few KB, and Spark takes an explode to add no rows: left to itself it broadcasts all that fits its threshold by that guess.
    plans = []

    def kept(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df)

    nodes = written(spark.createDataFrame([(0, i ^ (1 << k), 100 * i + k) for i in range(9) for k in range(40)], "fam int, fp long, root long"))
    texts = written(spark.createDataFrame([(i, [7] * 29 + [i % 3]) for i in range(40)], "root long, sig array<int>"))
    for df in (simhash.links(nodes, kept), simhash.band_links(texts, kept), simhash.dense_buckets(texts)):
        kept(df)
    assert len(plans) >= 7 and all("Join" in p for p in plans)
    assert not [p for p in plans if "Broadcast" in p]


def test_tables_of_many_rows_are_not_broadcast(spark, monkeypatch):
    rows = written(spark.range(20).withColumnRenamed("id", "u"))
    plan = lambda: spark.range(99).withColumnRenamed("id", "u").join(counted(rows), "u")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan()
    monkeypatch.setattr(common, "BROADCAST_ROWS", 19)
    assert "BroadcastHashJoin" not in plan()
