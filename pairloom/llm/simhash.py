"""SimHash near-duplicates with pigeonring candidate filtering.

A fingerprint's 64 bits form a ring of ``SEGMENTS`` segments.  If two fingerprints differ in at most
``tau`` bits, some segment starts a chain whose first l segments hold at most l * tau / SEGMENTS
differences, for every l.  The first floor((SEGMENTS - 1) / tau) segments of that chain are therefore equal: they are
the join key.  The longer prefixes are tested on the joined pair before its full distance.

With tau = 2 and 9 segments a key has 28 bits, so a bucket of unrelated fingerprints stays small.
A bucket above ``BUCKET`` fingerprints is dense with near copies and isn't paired: each of its
fingerprints is sent to the 65 points within one bit of it, and all that meet at a point link to the smallest
there.  Two fingerprints are at most two bits apart exactly when they meet at a point, so this is exact
and linear in the bucket's size.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, connected_components, counted, freed, shuffled, small_batches, written

TAU = 2
SEGMENTS = 9
BUCKET = 16
_EDGE = [i * 64 // SEGMENTS for i in range(SEGMENTS + 1)]
_SEED = 42
#: Smallest shingle hashes kept of each text, and how far below the similarity their estimate may lie (four standard errors).
SKETCH, SLACK = 32, 0.3
#: Min-hash bands of so many values: a pair at similarity 0.8 has a band in common with probability 0.9992.
BANDS, ROWS = 10, 3
#: Values, counted on from the band's first around the signature, by which texts of a dense bucket are told apart, step by step.
DEPTHS = (ROWS, 4, 5, 6, 8, 10, 13, 16, 20, 25, 30)
#: Texts of a dense bucket that meet as many in one block.
BLOCK = 1024
#: So many document numbers are broadcast at most; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: One of so many texts is looked at for common shingles; so many of these are broadcast.  They only decide the order of shingles, and any order is right.
SAMPLE, COMMON = 16, 1_000_000
#: Longs of 64 bits that a set is marked in, see marks.
MARKS = 4


def _chain(start: int, length: int) -> int:
    """Bit mask, as a signed long, of so many segments from start on around the ring."""
    mask = 0
    for k in range(start, start + length):
        a, b = _EDGE[k % SEGMENTS], _EDGE[k % SEGMENTS + 1]
        mask |= (1 << b) - (1 << a)
    return mask - (1 << 64) if mask >> 63 else mask


def words_of(text: str | None) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ of the text with A-Z lower-cased (bytes.split knows exactly these spaces)."""
    return (text or "").encode("utf-8", "replace").lower().split()


def shingles(words: list[bytes], n: int) -> list[bytes]:
    if len(words) <= n:
        return [b" ".join(words)] if words else []
    if n == 1:
        return words
    return [b" ".join(x) for x in zip(*(words[i:] for i in range(n)), strict=False)]


def majority(h: np.ndarray) -> int:
    """64 bits as a signed long; a bit is set if over half of the hashes have it."""
    count = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), 1 << 14):
        bits = np.unpackbits(h[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        full = len(bits) // 255 * 255
        if full:
            count += np.add.reduce(bits[:full].reshape(-1, 255, 64), axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        count += bits[full:].sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > len(h), bitorder="little").view(np.int64)[0])


def remixed(h: np.ndarray, k: int) -> np.ndarray:
    """The k-th family of hashes made from the first."""
    if not k:
        return h
    with np.errstate(over="ignore"):
        x = h * np.uint64(0x9E3779B97F4A7C15 * (2 * k + 1) & 0xFFFFFFFFFFFFFFFF)
        x ^= x >> np.uint64(31)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(29))


def fingerprint(text: str | None, n: int = 3, families: int = 1) -> list[int]:
    digest = xxhash.xxh64_intdigest
    got = shingles(words_of(text), n)
    if not got:
        return [0] * families
    h = np.fromiter((digest(s, _SEED) for s in got), dtype=np.uint64, count=len(got))
    return [majority(remixed(h, k)) for k in range(families)]


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3, families: int = 1) -> DataFrame:
    """(id, fps): the fingerprint of each row, for each family of hashes.  Null and wordless texts: zero.

    Rows keep their count; a null id stays null.  Other columns of df take no part.
    """
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [fingerprint(t, shingle_words, families) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.list_(pa.int64()))], ["id", "fps"])

    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, fps array<long>")


def links(nodes: DataFrame, written: Callable[[DataFrame], DataFrame] = written) -> DataFrame:
    """Edges (a, b) between roots whose fingerprints differ in 1 to TAU bits; all pairs are connected, not all emitted.

    nodes: (fp, root), each fp once (or once in a family, column fam, if there is one).
    """
    fam = F.col("fam") if "fam" in nodes.columns else F.lit(0)
    zero = (SEGMENTS - 1) // TAU
    rows = nodes.select(fam.cast("int").alias("fam"), "fp", "root", F.posexplode(F.array(*[F.col("fp").bitwiseAND(_chain(i, zero)) for i in range(SEGMENTS)])).alias("i", "key"))
    rows = rows.select(F.xxhash64("fam", "i", "key").alias("key"), "fp", "root", (F.col("fam") * SEGMENTS + F.col("i")).alias("slot"))
    full = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    found = written(rows.join(shuffled(full), "key"))
    cold = found.where(F.col("n") <= BUCKET)
    a, b = (cold.select("slot", "key", F.col("fp").alias(f"fp_{x}"), F.col("root").alias(x)) for x in "ab")
    apart = F.col("fp_a").bitwiseXOR(F.col("fp_b"))
    meets = F.bit_count(apart) <= TAU
    for length in range(zero + 1, SEGMENTS):
        mask = F.element_at(F.array(*[F.lit(_chain(i, length)) for i in range(SEGMENTS)]), F.col("slot") % SEGMENTS + 1)
        meets = (F.bit_count(apart.bitwiseAND(mask)) <= length * TAU // SEGMENTS) & meets
    pairs = a.join(shuffled(b), ["slot", "key"]).where((F.col("fp_a") < F.col("fp_b")) & meets).select("a", "b")
    hot = found.where(F.col("n") > BUCKET).select(F.floor(F.col("slot") / SEGMENTS).alias("fam"), "fp", "root").distinct()
    one = [0, *((1 << k) - (1 << 64 if k == 63 else 0) for k in range(64))]
    points = hot.select("fam", "root", F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(x)) for x in one])).alias("point"))
    centre = points.groupBy("fam", "point").agg(F.min("root").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    stars = points.join(shuffled(centre), ["fam", "point"]).where("root <> b").select(F.col("root").alias("a"), "b")
    return pairs.union(stars).distinct()


def signature(hashes: set[int]) -> list[int]:
    """Min-hashes of a set of 31-bit hashes, BANDS * ROWS of them; none of an empty set."""
    if not hashes:
        return []
    h = np.fromiter(hashes, dtype=np.uint64, count=len(hashes))
    return [int(remixed(h, 100 + k).min() >> np.uint64(33)) for k in range(BANDS * ROWS)]


def _in_bands(texts: DataFrame) -> DataFrame:
    """(root, band, key): the bands of each signature; texts: (root, sig)."""
    key = F.xxhash64("band", F.slice(F.col("sig"), F.col("band") * ROWS + 1, ROWS))
    return texts.where(F.size("sig") > 0).select("root", "sig", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band")).select("root", "band", key.alias("key"))


def _paired(rows: DataFrame) -> DataFrame:
    """Edges (a, b), a > b, between all roots of a key; rows: (key, root)."""
    return rows.select("key", F.col("root").alias("a")).join(shuffled(rows.select("key", F.col("root").alias("b"))), "key").where("a > b").select("a", "b")


def band_links(texts: DataFrame, written: Callable[[DataFrame], DataFrame] = written) -> DataFrame:
    """Candidate edges (a, b), a > b, between roots whose signatures share a band; texts: (root, sig).

    All of a bucket of at most BUCKET texts are paired.  A larger one links to its smallest root and, as such a link may prove
    false, its texts are grouped again by longer and longer parts of the signature, with a smallest root of their own in each group.
    What such links leave apart is for dense_links.
    """
    rows = _in_bands(texts)
    full = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("root").alias("least")).where("n > 1")
    found = written(rows.join(shuffled(full), "key"))
    stars = lambda groups: groups.where((F.col("n") > BUCKET) & (F.col("root") != F.col("least"))).select(F.col("root").alias("a"), F.col("least").alias("b"))
    out = _paired(found.where(F.col("n") <= BUCKET)).union(stars(found))
    hot = found.where(F.col("n") > BUCKET).select("root", "band")
    if hot.isEmpty():
        return out.distinct()
    around = texts.select("root", F.concat("sig", "sig").alias("sig"))
    keys = F.array(*[F.xxhash64(F.lit(depth), "band", F.slice(F.col("sig"), F.col("band") * ROWS + 1, depth)) for depth in DEPTHS[1:]])
    deep = written(hot.join(shuffled(around), "root").select("root", "band", F.posexplode(keys).alias("depth", "key")))
    deep = written(deep.join(shuffled(deep.groupBy("key").agg(F.count("*").alias("n"), F.min("root").alias("least"))), "key"))
    # All of a group have the same groups before it, so they come to a small one at the same depth.
    small = deep.where(F.col("n") <= BUCKET).groupBy("root", "band").agg(F.min("depth").alias("depth"))
    return out.union(stars(deep)).union(_paired(deep.where("n > 1").join(shuffled(small), ["root", "band", "depth"]))).distinct()


def dense_buckets(texts: DataFrame) -> DataFrame:
    """(key, n, root): the texts of buckets of more than BUCKET; texts: (root, sig)."""
    rows = _in_bands(texts).select("key", "root")
    return rows.join(shuffled(rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > BUCKET)), "key")


def dense_pairs(rows: DataFrame, comp: DataFrame, near: Callable[[Column, Column], Column]) -> DataFrame:
    """(a, b), a > b, each once: all pairs of a bucket that comp (node, component) leaves apart and for whose held columns near holds.

    rows: see dense_buckets, with held; if they have lead, only pairs of which one leads.  A bucket that is one component already has none.  Others are quadratic in what is apart: they are dealt over tasks in blocks of BLOCK by BLOCK texts.
    """
    lead = F.col("lead") if "lead" in rows.columns else F.lit(True)
    part = rows.select("root").distinct().join(shuffled(comp), F.col("root") == F.col("node"), "left").select("root", F.coalesce("component", "root").alias("part"))
    rows = rows.withColumn("lead", lead).join(shuffled(part), "root")
    apart = rows.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select("key")
    blocks = F.ceil(F.col("n") / BLOCK)
    rows = written(rows.join(shuffled(apart), "key").select("key", "root", "part", "held", "lead", blocks.alias("blocks"), F.pmod(F.xxhash64("root"), blocks).alias("own")))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    a = rows.where("lead").select("key", F.col("root").alias("a"), F.col("part").alias("part_a"), F.col("held").alias("held_a"), F.col("own").alias("i"), every.alias("j"))
    b = rows.select("key", F.col("root").alias("b"), F.col("part").alias("part_b"), F.col("held").alias("held_b"), F.col("lead").alias("lead_b"), F.col("own").alias("j"), every.alias("i"))
    met = a.join(shuffled(b), ["key", "i", "j"]).where((~F.col("lead_b") | (F.col("a") > F.col("b"))) & (F.col("part_a") != F.col("part_b")) & near(F.col("held_a"), F.col("held_b")))
    return met.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def shingle_set(text: str, n: int) -> np.ndarray:
    """Hashes of the text's different shingles, as signed longs."""
    got = set(shingles(words_of(text), n))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, got), dtype=np.uint64, count=len(got)).view(np.int64))


def prefixes(size: int, similarity: float) -> tuple[int, int]:
    """How many first shingles of a set can hold the first one that it shares with a set of that similarity: of a set that isn't larger, of any."""
    return size - math.ceil(2 * similarity / (1 + similarity) * size - 1e-9) + 1, size - math.ceil(similarity * size - 1e-9) + 1


def marks(held: np.ndarray) -> np.ndarray:
    """MARKS longs in which each hash sets a bit: a bit that only one of two sets has stands for a hash at least that the other lacks."""
    on = np.zeros(64 * MARKS, dtype=np.uint8)
    on[held & (64 * MARKS - 1)] = 1
    return np.packbits(on).view(np.int64)


def dense_links(dense: DataFrame, texts: DataFrame, comp: DataFrame, similarity: float, n: int) -> DataFrame:
    """(a, b), a > b: all pairs of dense buckets that comp leaves apart and that may have that similarity of their sets of n-word shingles.

    dense: see dense_buckets; texts: (root, text).  Exact, by prefixes: shingles have one order for all texts, the common ones last.  Let the first that two sets share be at some place of
    both: then they share at most what follows there.  So only texts meet that have a shingle at such a place in common, and texts that each hold enough of their own never do.
    Nor do those whose marks differ in more bits than sets of that similarity can have shingles apart.
    """
    spark = dense.sparkSession
    part = dense.join(shuffled(comp), F.col("root") == F.col("node"), "left").select("key", "root", F.coalesce("component", "root").alias("part"))
    apart = part.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select("key")
    roots = written(dense.join(apart, "key", "left_semi").select("root").distinct())
    some = texts.join(F.broadcast(roots) if roots.count() <= BROADCAST_IDS else roots, "root", "left_semi").select("root", "text")

    def every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [shingle_set(text, n) for text in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *own]))], ["key"])

    sample = some.where(F.pmod(F.xxhash64("root"), F.lit(SAMPLE)) == 0).mapInArrow(every, "key long").groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    got = sample.orderBy(F.desc("n"), "key").limit(COMMON).orderBy("key").toArrow()
    sent = spark.sparkContext.broadcast((got["key"].to_numpy(), got["n"].to_numpy()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = sent.value
        for b in batches:
            out = []
            for root, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own = shingle_set(text, n)
                common = np.zeros(len(own), dtype=np.int64)
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
                    common = np.where(keys[at] == own, counts[at], 0)
                lead, most = prefixes(len(own), similarity)
                key = own[np.lexsort((own, common))][:most]
                place = np.arange(len(key), dtype=np.int32)
                bits = [np.full(len(key), x) for x in marks(own)]
                out.append((key, np.full(len(key), root), np.full(len(key), len(own), dtype=np.int32), place, place < lead, *bits))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], ["key", "root", "size", "place", "lead", *named])

    named = [f"m{k}" for k in range(MARKS)]
    rows = written(some.mapInArrow(run, f"key long, root long, size int, place int, lead boolean, {', '.join(f'{m} long' for m in named)}"))
    full = rows.groupBy("key").agg(F.count("*").alias("n"), F.max("lead").alias("any")).where("n > 1 and any").select("key", "n")
    held = F.struct("size", F.expr("size - place").alias("rest"), *named).alias("held")

    def near(x: Column, y: Column) -> Column:
        need = F.lit(similarity / (1 + similarity)) * (x["size"] + y["size"]) - F.lit(1e-9)
        apart = sum((F.bit_count(x[m].bitwiseXOR(y[m])) for m in named), F.lit(0))
        return (x["rest"] >= need) & (y["rest"] >= need) & (x["size"] + y["size"] - apart >= 2 * need)

    return dense_pairs(rows.join(shuffled(full), "key").select("key", "n", "root", held, "lead"), comp, near)


def simhash_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3) -> DataFrame:
    """One row per input row: (doc_id, fingerprint, component_id).

    fingerprint: 16 hex digits.  component_id: the smallest id reachable over links of at most TAU bits.
    Null ids get the component of their group (null if the group holds null ids only); equal rows stay apart.
    """
    fps = written(fingerprints(df, id_col, text_col, shingle_words).select("id", F.col("fps")[0].alias("fp")))
    nodes = written(fps.groupBy("fp").agg(F.min("id").alias("root")))
    comp = connected_components(links(nodes.where("root is not null")))
    of = nodes.join(comp, nodes["root"] == comp["node"], "left").select("fp", F.coalesce("component", "root").alias("component_id"))
    return fps.join(of, "fp").select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8, verify_words: int = 5, families: int = 2) -> DataFrame:
    """(doc_id, component_id), a row for each id, for near-duplicate texts at a word-shingle Jaccard similarity.

    Texts that share at least ``similarity`` of their ``verify_words``-word shingles differ in a few words, hence in a few bits
    of a SimHash of single words; ``families`` independent fingerprints make it likely that one of them
    is within TAU bits.  Min-hash bands of the shingles find what they miss, see band_links and dense_links, so more families add time but no links that matter.  Links whose shingle sketches are too far apart go; the rest
    are verified on the shingle sets.  Equal word sequences are one node.  Null texts have no words, like empty ones; rows with a null id take no part; rows with
    equal ids are one document, whose least text is compared; other columns take no part.
    """
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got, same, least, sig = [], [], [], []
            for t in b.column(2).to_pylist():
                words = words_of(t)
                hashes = {xxhash.xxh32_intdigest(x) >> 1 for x in shingles(words, verify_words)}
                least.append(heapq.nsmallest(SKETCH, hashes))
                sig.append(signature(hashes))
                got.append(fingerprint(t, 1, families))
                same.append(xxhash.xxh3_128_digest(b" ".join(words)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(got, pa.list_(pa.int64())), pa.array(same, pa.binary()), pa.array(least, pa.list_(pa.int32())), pa.array(sig, pa.list_(pa.int32()))], ["id", "h", "fps", "same", "least", "sig"])

    spark = df.sparkSession
    rows = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    early, late = Scratch(spark), Scratch(spark)
    fps = early.written(rows.mapInArrow(run, "id long, h long, fps array<long>, same binary, least array<int>, sig array<int>"))
    ids = written(fps.select("id", "h", "same").distinct())
    texts = early.written(fps.groupBy("same").agg(F.min("id").alias("root"), F.first("fps").alias("fps"), F.first("least").alias("least"), F.first("sig").alias("sig")))
    freed(spark)
    each = texts.select("root", F.posexplode("fps").alias("fam", "fp"))
    nodes = early.written(each.groupBy("fam", "fp").agg(F.min("root").alias("root"), F.count("*").alias("n")))
    equal = each.join(shuffled(nodes.where("n > 1").select("fam", "fp", F.col("root").alias("b"))), ["fam", "fp"]).where("root <> b").select(F.col("root").alias("a"), "b")
    edges = early.written(links(nodes.drop("n"), early.written).union(equal))
    freed(spark)
    edges = early.written(edges.union(band_links(texts, early.written)).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    freed(spark)
    side = lambda x: texts.select(F.col("root").alias(x), F.col("least").alias(f"least_{x}"))
    edges = edges.join(shuffled(side("a")), "a").join(shuffled(side("b")), "b")

    def near(x: Column, y: Column) -> Column:
        # The smallest hashes of both shingle sets together are a sample of their union: a first estimate of the similarity.
        union = F.slice(F.array_sort(F.array_union(x, y)), 1, SKETCH)
        return F.size(F.array_intersect(F.array_intersect(union, x), y)) >= (similarity - SLACK) * F.size(union)

    edges = late.written(edges.where(near(F.col("least_a"), F.col("least_b"))).select("a", "b").distinct())
    dense = late.written(dense_buckets(texts))
    early.drop()

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, have = None, frozenset()
        for x in batches:
            keep = []
            for ta, tb in zip(x.column(2).to_pylist(), x.column(3).to_pylist(), strict=True):
                if tb != last:
                    last, have = tb, frozenset(shingles(words_of(tb), verify_words))
                own = frozenset(shingles(words_of(ta), verify_words))
                both = len(own & have)
                keep.append(both >= similarity * (len(own) + len(have) - both))
            yield pa.RecordBatch.from_arrays([x.column(0), x.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    ends = late.written(edges.select(F.explode(F.array("a", "b")).alias("id")).union(dense.select("root")).distinct())
    if ends.count() <= BROADCAST_IDS:
        ends = F.broadcast(ends)
    # Of several texts under one id the one with the smallest hash is compared.
    several = ids.groupBy("id").agg(F.min("h").alias("h"), F.count("*").alias("n")).where("n > 1").select("id", F.col("h").alias("least_h"))
    one = rows.join(ends, "id", "left_semi")
    if not (several := late.written(several)).isEmpty():
        one = one.join(counted(several), "id", "left").where(F.coalesce(F.col("h") == F.col("least_h"), F.lit(True))).groupBy("id").agg(F.min("text").alias("text"))

    def sure(some: DataFrame) -> DataFrame:
        linked = some.join(one.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
        linked = linked.join(one.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a").select("a", "b", "ta", "tb")
        out = late.written(linked.mapInArrow(verify, "a long, b long").distinct())
        freed(spark)
        return out

    # Texts travel with few links: one of each document first, then only those between what isn't connected yet.
    first = counted(late.written(edges.groupBy("a").agg(F.min("b").alias("b"))))
    good = sure(first)
    comp = counted(late.written(connected_components(good)))
    part = lambda x: comp.select(F.col("node").alias(x), F.col("component").alias(f"part_{x}"))
    rest = edges.join(first, ["a", "b"], "left_anti").join(part("a"), "a", "left").join(part("b"), "b", "left")
    rest = rest.where(F.coalesce("part_a", "a") != F.coalesce("part_b", "b")).select("a", "b")
    good = good.union(sure(rest))
    comp = late.written(connected_components(good))
    # Pairs of dense buckets that no link has met.
    left = counted(late.written(dense_links(dense, one.select(F.col("id").alias("root"), "text"), comp, similarity, verify_words)))
    comp = counted(written(comp if left.isEmpty() else connected_components(good.union(sure(left)))))
    late.drop()
    roots = ids.groupBy("same").agg(F.min("id").alias("root"))
    of = roots.join(comp, roots["root"] == comp["node"], "left").select("same", F.coalesce("component", "root").alias("component_id"))
    # An id with several texts is in the components of all of them: the smallest counts.
    found = ids.join(of, "same").groupBy("id").agg(F.min("component_id").alias("component_id"))
    return found.select(F.col("id").alias("doc_id"), "component_id")
