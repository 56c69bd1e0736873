import random
import tracemalloc

import numpy as np

from pairloom.llm import language as L

from .conftest import DOCS


def brute_phrases(sample: list[int], text: list[int]) -> int:
    """Greedy phrases of text that occur in sample; an unknown symbol is a phrase of its own."""
    joined, whole = "".join(map(chr, sample)), "".join(map(chr, text))
    count, i = 0, 0
    while i < len(whole):
        n = 1
        while i + n < len(whole) and whole[i : i + n + 1] in joined:
            n += 1
        i += n
        count += 1
    return count


def test_cross_parse_equals_brute_force():
    rng = random.Random(4)
    samples = {"x": ["".join(rng.choice("abc ") for _ in range(600))], "y": ["".join(rng.choice("bcd ") for _ in range(600))]}
    model = L.Model(samples)
    texts = ["".join(rng.choice("abcdz ") for _ in range(n)) for n in (1, 5, 255, 256, 257, 900, 5000)]
    texts += [samples["x"][0], samples["x"][0][7:590] * 5, "ab" * 2000, "z" * 1000, ""]
    got, scores = model.score(texts)
    for text, lang, score in zip(texts, got, scores, strict=True):
        sym = model.symbols(text)[0]
        keep = sym != L.SPACE
        keep[1:] |= sym[:-1] != L.SPACE
        sym = sym[keep].tolist()
        cost = []
        for k, name in enumerate(model.langs):
            sample = L.squeezed(model.symbols(samples[name][0])[0]).tolist()
            cost.append(brute_phrases(sample, sym) * model.bits[k])
        assert [n * b for n, b in zip(model.parsed([text, "bc"])[1][:, 0], model.bits, strict=True)] == cost
        if any(c.isalpha() for c in text):
            assert lang == model.langs[int(np.argmin(cost))]
            assert abs(score - (1 - min(cost) / max(cost))) < 1e-12


def test_held_out_accuracy_and_odd_texts(spark):
    rng = random.Random(6)
    pools = {"aa": ["ka", "mi", "to"], "bb": ["sch", "ung", "eit"], "cc": ["été", "eau", "oux"]}
    rows = []
    for i in range(300):
        lang = list(pools)[i % 3]
        rows.append((i, " ".join("".join(rng.choices(pools[lang], k=3)) for _ in range(15)), lang if i % 7 else None, "s", None, 1, 1, "k", 1, 0.5))
    odd = [(1000, None), (1001, ""), (1002, "123 !!"), (1003, "\U00020000"), (None, "kamito")]
    rows += [(i, t, "aa", None, None, 1, 1, "k", 1, 0.5) for i, t in odd] + [rows[0]]
    docs = spark.createDataFrame(rows, DOCS)
    model = L.fit(docs.where("doc_id % 2 = 0 or doc_id is null"))
    got = L.identify(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r.lang_pred for r in got}
    assert all(by_id[i] == list(pools)[i % 3] for i in range(300))
    assert [by_id[i] for i in (1000, 1001, 1002)] == ["und"] * 3 and by_id[1003] != "und" and by_id[None] == "aa"


def test_nothing_learned_and_empty(docs, no_docs):
    model = L.fit(no_docs)
    assert {r.lang_pred for r in L.identify(docs, model).collect()} == {"und"}
    assert L.identify(no_docs, L.fit(docs)).collect() == []


def test_keeps_all_columns(docs, rows):
    out = L.identify(docs.drop("score"), L.fit(docs), keep=tuple(c for c in docs.columns if c != "score"))
    assert out.columns == [*[c for c in docs.columns if c != "score"], "lang_pred", "score"]
    assert out.count() == len(rows)


def test_letters_of_wide_scripts_count(spark):
    """Four languages of a few thousand letters each, most of them shared and rare; one has letters beyond 16 bits."""
    rng = random.Random(2)
    pools = {f"l{k}": ["".join(chr(base + rng.randint(0, 4000)) for _ in range(2)) for _ in range(300)] for k, base in enumerate((0x4E00, 0x4E00, 0xAC00, 0x20000))}
    rows = [(i, " ".join(rng.choices(pools[f"l{i % 4}"], k=40)), f"l{i % 4}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = L.identify(docs, L.fit(docs.where("doc_id < 300"))).where("doc_id >= 300").collect()
    assert sum(r.lang_pred == f"l{r.doc_id % 4}" for r in got) >= 98


def test_memory_of_a_batch_follows_its_longest_text():
    """A batch of many texts is parsed in slices, with the results of each text alone."""
    rng = random.Random(7)
    model = L.Model({k: [" ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(400))] for k, letters in (("x", "abcdef"), ("y", "efghij"))})
    texts = [None, "", *(" ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n)) for n in [3000] * 150)]
    tracemalloc.start()
    got = model.score(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == tuple(map(list, zip(*((a[0], b[0]) for a, b in (model.score([t]) for t in texts)), strict=True)))
    assert peak < 60 * L.TOGETHER
