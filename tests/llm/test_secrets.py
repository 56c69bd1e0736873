import hashlib
import random
import re

from pairloom.llm import secrets

from .conftest import DOCS

PATTERNS = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 32),
)


def brute(text):
    spans = []
    for rank, (kind, pattern, group, least) in enumerate(PATTERNS):
        spans += [(m.start(), rank, m.end(), kind) for m in pattern.finditer(text or "") if len(m.group(group)) >= least]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))


def texts():
    rng = random.Random(5)
    parts = ["password=", "Secret : ", "token", "=", ":", " ", '"', "api_key='", "APIKEY=", "abcdefgh", "short", "AKIA", "ABCDEF0123456789", "AKIAAKIA", "0123456789abcdef" * 2, "f" * 31, "é", "\U0001f600", "\n", "x", "ſecret=abcdefghi"]
    out = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(300)]
    return [*out, None, "", "token: secret: abcdefgh1", "password=12345678" * 300]


def made(spark):
    rows = [(i, t, None, f"s{i % 3}", None, 1, 1, "k", 1, 0.5) for i, t in enumerate(texts())]
    return spark.createDataFrame([*rows, rows[0], rows[0], (None, "token=abcdefgh9", None, None, None, 1, 1, "k", 1, 0.5)], DOCS), rows


def test_base_spans_equal_brute_force(spark):
    docs, rows = made(spark)
    got = secrets.secrets_digest(secrets.find_secrets(docs)).collect()
    assert len(got) == docs.count()
    by_id = {r.doc_id: r for r in got}
    for doc, text, *_ in rows:
        want = brute(text)
        r = by_id[doc]
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest(), text
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(want.count(k + ":") for k in ("assign", "access", "hex"))
    assert by_id[None].n_assign == 1


def test_ownership_separates_examples_from_live_values(spark):
    live, example, own = "token=live0000aaaa", "token=example11111", "Zz9Zz8Zz7Zz6Zz5Zz4Zz3Zz2"
    rows = [(1, live, None, "a"), (2, live, None, "a"), *((10 + i, example, None, f"o{i}") for i in range(5)), (3, f"see {own} here", None, "a"), (4, "x" * 30, None, "a")]
    rows += [(20 + i, "Shared12345Shared12345Shared", None, f"o{i}") for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in secrets.secrets_digest(secrets.find_secrets(docs)).collect()}
    assert (got[1].n_live, got[1].n_example) == (1, 0)
    assert (got[10].n_live, got[10].n_example) == (0, 1)
    assert got[3].spans == f"owned:4:{4 + len(own)}"
    assert got[4].spans == "" and got[20].spans == ""


def test_one_owner_many_repositories(spark, monkeypatch):
    monkeypatch.setattr(secrets, "HOT_ROWS", 8)
    few, many, generic = "token=few0000aaaa", "token=many1111bbbb", "Zz9Zz8Zz7Zz6Zz5Zz4Zz3Zz2"
    rows = [(i, few, "a") for i in range(9)] + [(100 + i, f"{many} {generic}", "a") for i in range(10)]
    rows += [(300, f"{few}x {generic}y", "b"), (300, f"{few}x {generic}y", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in secrets.secrets_digest(secrets.find_secrets(docs)).collect()}
    assert (got[0].n_live, got[0].n_example, got[0].n_repos) == (1, 0, 9)
    assert (got[100].n_live, got[100].n_example, got[100].n_repos) == (0, 1, 10) and "owned" not in got[100].spans
    assert (got[300].n_live, got[300].n_example, got[300].n_repos) == (2, 0, 1) and "owned" in got[300].spans


def test_very_many_matches(spark):
    text = "token=abcdefgh1 q " * 40_000 + " Zz9Zz8Zz7Zz6Zz5Zz4Zz3Zz2"
    r = secrets.secrets_digest(secrets.find_secrets(spark.createDataFrame([(1, text, "a")], "doc_id long, text string, source string"))).first()
    assert r.base_sha256 == hashlib.sha256(brute(text).encode()).hexdigest() and r.n_assign == 40_000
    assert r.spans.endswith(f"owned:{len(text) - 24}:{len(text)}")


def test_empty_table(no_docs):
    assert secrets.secrets_digest(secrets.find_secrets(no_docs)).collect() == []
