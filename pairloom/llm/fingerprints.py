"""MinHash fingerprints of texts, of their edited forms, and near-duplicate classes.

A text's shingles are its runs of five words (a shorter text is one shingle, a wordless one has none).  ``HASHES`` universal hash functions
x -> a x + b (mod 2^64) each give the least value over the shingles; a fingerprint keeps 16 bits of each, so the share of
equal places of two fingerprints estimates the Jaccard similarity of the shingle sets, and equal texts have equal fingerprints.

Signature bands are joined in Spark; what their buckets propose is held against the fingerprints, and what is left is verified on the shingle sets.

An edited text takes its second half from the next document.  Documents are cut into ranges of (id, hash of the text); each range also gets
the first row of the next one, so a task meets every pair of neighbours while it streams through its sorted rows, and no task sees all.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, connected_components, freed, small_batches, written
from .simhash import BANDS, BROADCAST_IDS, ROWS, band_links, dense_buckets, dense_links, remixed, shingles, words_of

SHINGLE = 5
HASHES = 128
SIMILARITY = 0.8
#: How far below the similarity the fingerprints of a verified pair may lie: over four standard errors of 128 places.
SLACK = 0.17
#: Ranges of documents for each shuffle partition of the session.
RANGES = 16
#: Shingles hashed at once: a tile of values stays in a core's cache.
_TILE = 2048
_BASE = np.uint64(0x100000001B3)
_LEAST_ID = -(2**63)


def _functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors (odd) and offsets of n hash functions, from a fixed seed."""
    with np.errstate(over="ignore"):
        x = remixed(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), 3)
    return x[:n] | np.uint64(1), x[n:]


def hashes_of(words: list[bytes], n: int = SHINGLE) -> np.ndarray:
    """64-bit hashes of the shingles of n words: all words, if there are fewer."""
    n = min(n, len(words))
    if not n:
        return np.zeros(0, dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    h = np.fromiter(map(digest, words), dtype=np.uint64, count=len(words))
    out = np.zeros(len(h) - n + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            out = out * _BASE + h[k : k + len(out)]
    return remixed(out, 1)


def least_values(hashes: np.ndarray, count: int = HASHES) -> np.ndarray:
    """The least value of each hash function over the shingles; zeros without any."""
    a, b = _functions(count)
    if not len(hashes):
        return np.zeros(count, dtype=np.uint64)
    out = np.full(count, 2**64 - 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(hashes), _TILE):
            values = a[:, None] * hashes[None, at : at + _TILE]
            values += b[:, None]
            np.minimum(out, values.min(axis=1), out=out)
    return out


def fingerprint(values: np.ndarray) -> bytes:
    """16 bits of each least value."""
    return (remixed(values, 2) >> np.uint64(48)).astype("<u2").tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """Share of equal places of two fingerprints."""
    return float((np.frombuffer(a, "<u2") == np.frombuffer(b, "<u2")).mean())


def edited(text: str, following: str) -> str:
    """text with its last half (rounded down) replaced by as many first characters of the following text, or all of them."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_next(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(block, extra, id, h, packed), sorted within partitions: each block's rows in order, then as extra the row that follows its last one.

    Rows without an id come before all others; rows with equal ids go by a hash of their text; the first row of all follows the last.
    packed is the compressed text, so that texts take less room on their way.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("h"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = F.coalesce("id", F.lit(_LEAST_ID))
    blocks = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The least place of each range, a row for each range: as many as the session's setting says, not as the data have.
    ranged = rows.select(order.alias("id"), "h").repartitionByRange(blocks, "id", "h")
    firsts = sorted((r["f"]["id"], r["f"]["h"]) for r in ranged.groupBy(F.spark_partition_id()).agg(F.min(F.struct("id", "h")).alias("f")).collect())
    sent = spark.sparkContext.broadcast(firsts)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, pack = sent.value, zstandard.ZstdCompressor().compress
        for b in batches:
            out: list[tuple] = []
            for i, h, text in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                place = (_LEAST_ID if i is None else i, h)
                k = bisect.bisect_right(starts, place) - 1
                packed = pack(text.encode("utf-8", "surrogatepass"))
                out.append((k, 0, i, h, packed))
                if starts[k] == place:
                    out.append(((k - 1) % len(starts), 1, i, h, packed))
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in enumerate([pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()])], ["block", "extra", "id", "h", "packed"])

    each = rows.mapInArrow(placed, "block int, extra int, id long, h long, packed binary")
    return each.repartition("block").sortWithinPartitions("block", "extra", "id", "h")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, h, n_chars, edited_sha256, fp, edited_fp, near_edited, near_next, same), a row for each row of df.

    fp and edited_fp are fingerprints and edited_sha256 a digest as bytes; same is a digest of the words, null of a wordless text.
    A null text is an empty one.  Wordless texts are alike, and unlike all others.  Order and null ids: see with_next.
    """
    small_batches(df.sparkSession)
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.binary()]
    names = ["id", "h", "n_chars", "edited_sha256", "fp", "edited_fp", "near_edited", "near_next", "same"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, unpack = None, zstandard.ZstdDecompressor().decompress
        for b in batches:
            out: list[list] = [[] for _ in names]
            for block, extra, i, h, packed in zip(*(b.column(k).to_pylist() for k in range(5)), strict=True):
                if extra and last is None:
                    continue
                text = unpack(packed).decode("utf-8", "surrogatepass")
                words = words_of(text)
                values = least_values(hashes_of(words))
                fp = fingerprint(values)
                if last is not None:
                    at, was_fp, was_text, row = last
                    if at == block:
                        changed = edited(was_text, text)
                        new_fp = fingerprint(least_values(hashes_of(words_of(changed))))
                        sha = hashlib.sha256(changed.encode("utf-8", "replace")).digest()
                        for held, v in zip(out, [*row[:3], sha, was_fp, new_fp, likeness(was_fp, new_fp), likeness(was_fp, fp), *row[3:]], strict=True):
                            held.append(v)
                last = None if extra else (block, fp, text, (i, h, len(text), xxhash.xxh3_128_digest(b" ".join(words)) if words else None))
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, kinds, strict=True)], names)

    return with_next(df, id_col, text_col).mapInArrow(run, "id long, h long, n_chars long, edited_sha256 binary, fp binary, edited_fp binary, near_edited double, near_next double, same binary")


def near_pairs(pairs: DataFrame, side_a: DataFrame, side_b: DataFrame, test, columns: str) -> DataFrame:
    """The rows (a, b) of pairs for which test(x, y) holds; side_a and side_b: (id, column) of what is held against each other."""
    joined = pairs.join(side_b.select(F.col("id").alias("b"), F.col(columns).alias("y")), "b").join(side_a.select(F.col("id").alias("a"), F.col(columns).alias("x")), "a").select("a", "b", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [test(x, y) for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return joined.mapInArrow(run, "a long, b long")


def banded(nodes: DataFrame) -> DataFrame:
    """(root, sig) of nodes (node, fp) with words: the first BANDS * ROWS places of their fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sig = [np.frombuffer(fp, "<u2")[: BANDS * ROWS].tolist() for fp in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sig, pa.list_(pa.int32()))], ["root", "sig"])

    return nodes.mapInArrow(run, "root long, sig array<int>")


def near_classes(found: DataFrame, df: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """(id, class_id), a row for each id: the smallest id reachable over pairs of texts with a shingle-set similarity of that much.

    found: fingerprints(df).  Texts with the same words are one node; rows with equal ids join the classes of all their texts; null ids take no part.
    A pair at 0.8 shares a band with probability 0.9992; see simhash.band_links and dense_links for what large buckets do.
    """
    spark = df.sparkSession
    scratch = Scratch(spark)
    ids = found.where("id is not null").select("id", "h", F.xxhash64("same").alias("node"), "same", "fp")
    # A node is a sequence of words; the text of its least id is the one that is compared.
    roots = ids.groupBy("node").agg(F.min(F.struct("id", "h")).alias("r"), F.first("fp").alias("fp"), F.first("same").alias("same"))
    nodes = scratch.written(roots.select("node", F.col("r.id").alias("id"), F.col("r.h").alias("h"), "fp", "same"))
    freed(spark)
    bands = scratch.written(banded(nodes.where("same is not null").select("node", "fp")))
    edges = band_links(bands, scratch.written)
    edges = scratch.written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    freed(spark)
    fps = nodes.select(F.col("node").alias("id"), "fp")
    edges = scratch.written(near_pairs(edges, fps, fps, lambda x, y: likeness(x, y) >= similarity - SLACK, "fp"))
    dense = scratch.written(dense_buckets(bands))
    ends = edges.select(F.explode(F.array("a", "b")).alias("node")).union(dense.select("root")).distinct()
    wanted = scratch.written(nodes.join(ends, "node", "left_semi").select("node", F.col("id").alias("doc"), "h"))
    freed(spark)
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    texts = df.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text_col).alias("h"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = scratch.written(texts.join(wanted, ["doc", "h"]).groupBy("node").agg(F.min("text").alias("text")).select(F.col("node").alias("id"), "text"))

    def alike(x: str, y: str) -> bool:
        one, two = frozenset(shingles(words_of(x), SHINGLE)), frozenset(shingles(words_of(y), SHINGLE))
        both = len(one & two)
        return both >= similarity * (len(one) + len(two) - both)

    # Texts travel with few pairs: one of each text first, then only those between what isn't connected yet.
    first = scratch.written(edges.groupBy("a").agg(F.min("b").alias("b")))
    good = scratch.written(near_pairs(first, texts, texts, alike, "text"))
    comp = scratch.written(connected_components(good))
    part = lambda x: comp.select(F.col("node").alias(x), F.col("component").alias(f"part_{x}"))
    rest = edges.join(first, ["a", "b"], "left_anti").join(part("a"), "a", "left").join(part("b"), "b", "left")
    rest = rest.where(F.coalesce("part_a", "a") != F.coalesce("part_b", "b")).select("a", "b")
    more = scratch.written(near_pairs(rest, texts, texts, alike, "text"))
    good = good.union(more)
    comp = scratch.written(connected_components(good))
    # Pairs of dense buckets that no link has met.
    left = scratch.written(dense_links(dense, texts.select(F.col("id").alias("root"), "text"), comp, similarity, SHINGLE))
    if not left.isEmpty():
        more = scratch.written(near_pairs(left, texts, texts, alike, "text"))
        comp = scratch.written(connected_components(good.union(more)))
    # From components of texts to classes of ids: an id with texts in several components joins them.
    freed(spark)
    held = ids.select("id", "node").distinct().join(comp, "node", "left").select("id", F.coalesce("component", "node").alias("part"))
    held = scratch.written(held.distinct())
    least = held.groupBy("part").agg(F.min("id").alias("least"))
    links = held.join(least, "part").select(F.col("id").alias("a"), F.col("least").alias("b"))
    own = connected_components(links.where("a <> b"))
    every = held.select("id").distinct()
    out = written(every.join(own, every["id"] == own["node"], "left").select("id", F.coalesce("component", "id").alias("class_id")))
    scratch.drop()
    return out


def document_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of df: (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, class_id).

    fingerprint: 512 hex digits, four for each hash function.  near_edited and near_next: likeness of it to the edited text's and to the
    next document's, see fingerprints.  class_id: see near_classes; null for rows without an id.  Repeated rows stay; other columns of df take no part; an empty table gives no rows.
    """
    found = written(fingerprints(df, id_col, text_col))
    freed(df.sparkSession)
    classes = near_classes(found, df, id_col, text_col)
    digits = lambda c: F.lower(F.hex(c))
    out = found.join(classes, "id", "left")
    return out.select(F.col("id").alias("doc_id"), "n_chars", digits("edited_sha256").alias("edited_sha256"), digits("fp").alias("fingerprint"), digits("edited_fp").alias("edited_fingerprint"), "near_edited", "near_next", "class_id")
