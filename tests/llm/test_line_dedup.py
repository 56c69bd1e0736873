from collections import defaultdict

from pairloom.llm import line_dedup as L

from .conftest import DOCS


def brute(rows, min_sites, min_texts):
    sites, texts, first, n = defaultdict(set), defaultdict(set), {}, defaultdict(int)
    low = lambda d: (-1, 0) if d is None else (0, d)
    for doc, text, site in rows:
        for pos, line in enumerate((text or "").split("\n")):
            key = line.strip(" \t\r")
            if key:
                sites[key].add(site or "")
                texts[key].add(text)
                n[key] += 1
                first[key] = min(first.get(key, (low(doc), pos)), (low(doc), pos))
    bad = {k for k in sites if len(sites[k]) >= min_sites and len(texts[k]) >= min_texts}
    out = []
    for doc, text, _ in rows:
        if text is None:
            out.append((str(doc), None))
            continue
        kept = [x for pos, x in enumerate(text.split("\n")) if x.strip(" \t\r") not in bad or first[x.strip(" \t\r")] == (low(doc), pos)]
        out.append((str(doc), "\n".join(kept)))
    return sorted(out, key=str)


def made():
    rows = []
    for i in range(120):
        lines = [f"own line {i}"]
        if i % 5:
            lines += [" Subscribe now\t", "Subscribe now"]
        if i % 3 == 0:
            lines.append("few sites" if i % 4 == 0 else f"pair {i // 6}")
        if i < 24:
            lines.append("near the threshold")
        rows.append((i, "\n".join(lines), f"s{i % 12}" if i % 11 else None))
    rows += [(200 + i, "whole page\ncopied", f"s{i}") for i in range(12)]
    return [*rows, (300, None, "s1"), (301, "", "s2"), (302, "\n\n", None), rows[1], (None, "Subscribe now\nother", "s3"), (303, "Subscribe now\n" * 3000, "s4")]


def test_equals_brute_force(spark):
    rows = made()
    df = spark.createDataFrame([(d, t, None, s, None, 1, 1, "k", 1, 0.5) for d, t, s in rows], DOCS)
    got = L.drop_boilerplate(df, min_sites=10, min_texts=20)
    assert got.columns == [*df.columns, "n_lines", "n_dropped"]
    found = got.collect()
    assert sorted(((str(r.doc_id), r.text) for r in found), key=str) == brute(rows, 10, 20)
    assert sum(r.n_dropped for r in found) > 100
    assert all(r.text == "whole page\ncopied" for r in found if r.doc_id is not None and 200 <= r.doc_id < 212)


def test_empty_table(no_docs):
    assert L.drop_boilerplate(no_docs).collect() == []
