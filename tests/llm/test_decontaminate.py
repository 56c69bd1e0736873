import random
import re

import pytest

from pairloom.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items, window=13):
    windows = {}
    for item, text in items:
        w = split(text)
        k = min(window, len(w))
        if item is not None and k:
            for a in range(len(w) - k + 1):
                windows.setdefault(tuple(w[a : a + k]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w, hit, found = split(text), set(), set()
        for k in sizes:
            for a in range(len(w) - k + 1):
                got = windows.get(tuple(w[a : a + k]))
                if got:
                    found |= got
                    hit |= set(range(a, a + k))
        out.append((doc, len(w), len(hit), tuple(sorted(found)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def made():
    rng = random.Random(9)
    small = ["alpha", "beta", "Gamma", "née", "7"]
    items = [(i, " ".join(rng.choice(small) for _ in range(rng.choice([1, 3, 12, 13, 14, 40])))) for i in range(25)]
    items += [(30, items[0][1]), (31, None), (32, "..."), (None, "alpha beta"), (33, "unique " * 20), (34, "long tail of thirteen or more words in one item that goes on and on")]
    docs = []
    for i in range(60):
        parts = [" ".join(rng.choice([*small, "zeta"]) for _ in range(rng.randint(0, 40)))]
        if i % 4 == 0:
            parts.insert(rng.randint(0, 1), rng.choice([t for _, t in items if t]))
        docs.append((i, ", ".join(parts)))
    return [*docs, (60, None), (61, ""), (62, "unique " * 30), (63, "word " * 9000 + items[-1][1]), docs[0], (None, items[-1][1])], items


@pytest.mark.parametrize(("window", "block"), [(13, 500_000), (13, 60), (3, 100)])
def test_equals_brute_force(spark, window, block):
    docs, items = made()
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as n_words", "2 as items", "3 as __x")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = D.find_contamination(df, bench, window=window, block_words=block)
    got = got.select("doc_id", "n_words", D.n_hit().alias("n_hit"), "items", D.contaminated().alias("bad")).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, tuple(sorted(r["items"])), r.bad) for r in got), key=str) == brute(docs, items, window)


def test_empty_tables(spark, docs, no_docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    got = D.find_contamination(docs, bench, keep=("text", "lang"))
    assert got.where("size(hits) > 0 or size(items) > 0").count() == 0 and got.columns == ["doc_id", "text", "lang", "n_words", "hits", "items"]
    assert D.find_contamination(no_docs, bench).collect() == []


def test_spans_are_cut_from_texts(spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    own = "Ünïque words here. "
    rows = [(1, own * 10 + item.upper() + "! end"), (2, item), (3, own), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in D.remove_hits(D.find_contamination(df, bench, keep=("text",))).collect()}
    assert got == {1: own * 10 + "! end", 2: None, 3: own, 4: None}


def test_one_worker_scans_and_cuts(spark):
    items = [(i, " ".join(f"w{i}x{k}" for k in range(15))) for i in range(6)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    own = " ".join(f"own{k}" for k in range(40))
    rows = [(i, f"{own} {t} {own} {items[0][1]}") for i, t in items] + [(10, items[1][1]), (11, own), (12, None), (13, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    apart = D.remove_hits(D.find_contamination(df, bench, keep=("text",), block_words=30))
    both = D.find_contamination(df, bench, keep=("text",), block_words=30, left=D.own_text)
    assert sorted(both.collect(), key=str) == sorted(apart.collect(), key=str)
    assert both._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
