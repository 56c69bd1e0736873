import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.llm import ranked as M

from ..conftest import DATA


def plain_terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, k=50):
    """Scores of all documents for all items, straight from the formulas; docs: (id, text) rows."""
    counts = [(i, Counter(plain_terms(t))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n_docs, length = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(plain_terms(t))
    out = []
    for item, terms in asked.items():
        scored = []
        for i, c, n in counts:
            m = 100 - 50 + (50 * n * n_docs) // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in terms if c[t])
            if i is not None and s > 0:
                scored.append((-s, i))
        out += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("shard", [M.SHARD, 500])
def test_whole_tables(spark, shard):
    docs, items = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "benchmark"))
    got = M.ranked_search(docs, items, shard=shard)
    assert sorted(map(tuple, got.collect())) == brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])


def test_blocks_of_items(spark, monkeypatch):
    docs, items = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "benchmark"))
    want = sorted(map(tuple, M.ranked_search(docs, items, k=7).collect()))
    monkeypatch.setattr(M, "ITEM_BYTES", 20_000)
    assert sorted(map(tuple, M.ranked_search(docs, items, k=7).collect())) == want


def test_odd_rows(spark, docs, rows, no_docs):
    texts = {r[0]: r[1] for r in rows}
    asked = [(1, texts[0]), (2, None), (3, " .,- "), (None, texts[3]), (4, "two words"), (4, "ONE"), (5, "nowhere-at-all"), (6, texts[33])]
    items = spark.createDataFrame(asked, "item_id long, text string").withColumn("score", F.lit("x"))
    got = sorted(map(tuple, M.ranked_search(docs, items, k=3).collect()))
    want = brute([(r[0], r[1]) for r in rows], asked, 3)
    assert [(g[0], g[1], g[3]) for g in got] == [(w[0], w[1], w[3]) for w in want] and [g[2] for g in got] == [w[2] for w in want]
    assert M.ranked_search(no_docs, items).collect() == [] and M.ranked_search(docs, items.limit(0)).collect() == []


@pytest.mark.parametrize("docs", [1, 2, 3, 37, 128])
def test_tree_finds_the_best(docs):
    rng = random.Random(docs)
    rows = [(t, d, rng.choice([5, 5, 7, 90, 1000])) for t in range(9) for d in range(docs) if rng.random() < (t + 1) / 10]
    if not rows:
        rows = [(0, 0, 5)]
    term, doc, imp = (np.array(c, dtype=np.int64) for c in zip(*rows, strict=True))
    ids = np.arange(docs) * 3 - 20
    tree = M.Tree(ids, term, doc, imp, 9)
    weights = np.array([1, 4, 9, 1, 7, 2, 3, 8, 1], dtype=np.int64)
    total = Counter()
    for t, d, i in rows:
        total[int(ids[d])] += int(weights[t]) * i
    best = M.Best(5)
    M.search(tree, np.arange(9), weights, best)
    assert list(zip(best.scores.tolist(), best.ids.tolist(), strict=True)) == [(s, i) for i, s in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:5]]


def test_a_search_leaves_most_of_a_shard_alone():
    rng = np.random.default_rng(1)
    n = 4096
    rows = [(0, d, 100) for d in range(n)] + [(1, int(d), 900) for d in rng.integers(0, n, 8)]
    term, doc, imp = (np.array(c, dtype=np.int64) for c in zip(*sorted(set(rows)), strict=True))
    tree = M.Tree(np.arange(n), term, doc, imp, 2)
    assert M.search(tree, np.arange(2), np.array([1, 1000]), M.Best(3)) < 2 * n / 4
