import hashlib
import itertools

import pytest

from pairloom.llm import fingerprints as M
from pairloom.llm.simhash import shingles, words_of

from ..conftest import DATA
from .conftest import words


def brute(rows):
    """Fields of the contract for rows (doc_id, text) in order."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: r[0])
    out = {}
    for k, (i, t) in enumerate(rows):
        other = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        changed = t[: len(t) - half] + other[:half]
        out[i] = (len(t), hashlib.sha256(changed.encode()).hexdigest(), t, changed, other)
    return out


def of(text):
    return M.fingerprint(M.least_values(M.hashes_of(words_of(text))))


def jaccard(x, y):
    x, y = set(shingles(words_of(x), 5)), set(shingles(words_of(y), 5))
    return len(x & y) / max(1, len(x | y)) if x or y else 1.0


def test_contract_on_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    got = {r.doc_id: r for r in M.document_fingerprints(docs).collect()}
    assert got.keys() == want.keys()
    for i, (n, sha, text, changed, other) in want.items():
        r = got[i]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (n, sha, of(text).hex(), of(changed).hex())
        assert r.near_edited == M.likeness(of(text), of(changed)) and r.near_next == M.likeness(of(text), of(other))
        assert abs(r.near_edited - jaccard(text, changed)) < 0.2
    # Classes by brute force over all pairs.
    root = {i: i for i in want}
    for i, j in itertools.combinations(sorted(want), 2):
        if jaccard(want[i][2], want[j][2]) >= 0.8:
            a, b = sorted((root[i], root[j]))
            root = {k: a if v == b else v for k, v in root.items()}
    assert {i: r.class_id for i, r in got.items()} == root


def test_odd_rows(spark, docs, rows, no_docs):
    got = M.document_fingerprints(docs).collect()
    assert len(got) == len(rows)
    assert M.document_fingerprints(no_docs).collect() == []
    by_text = {}
    for r in got:
        assert (r.class_id is None) == (r.doc_id is None)
    texts = {r[0]: r[1] for r in rows if r[0] is not None}
    for r in got:
        if r.doc_id is not None:
            assert r.n_chars == len(texts[r.doc_id] or "") and r.fingerprint == of(texts[r.doc_id]).hex()
            by_text.setdefault(tuple(words_of(texts[r.doc_id])), set()).add(r.class_id)
    assert all(len(c) == 1 for c in by_text.values())
    near = {r.class_id for r in got if r.doc_id is not None and 33 <= r.doc_id < 45}
    assert len(near) == 1


def test_ids_with_several_texts_and_one_row(spark):
    x, y = (" ".join(words(__import__("random").Random(k), 80)) for k in (1, 2))
    rows = [(5, x), (7, x), (7, "a0 " + y), (9, y)]
    got = M.document_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 4 and {r.class_id for r in got} == {5}
    one = M.document_fingerprints(spark.createDataFrame(rows[:1], "doc_id long, text string")).first()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256((x[: len(x) - len(x) // 2] + x[: len(x) // 2]).encode()).hexdigest()


@pytest.mark.parametrize("n", [0, 1, 4, 5, 5000])
def test_least_values(n):
    h = M.hashes_of([b"%d" % k for k in range(n)])
    assert len(h) == (0 if not n else max(1, n - 4))
    a, b = M._functions(M.HASHES)
    want = [min(((int(f) * int(x) + int(o)) % 2**64 for x in h), default=0) for f, o in zip(a[:3], b[:3], strict=True)]
    assert M.least_values(h)[:3].tolist() == want
