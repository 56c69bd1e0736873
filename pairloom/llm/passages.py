"""Repeated passages found with compact windows.

A text's tokens are its five-word shingles.  For each of several hash functions the Cartesian tree over the tokens' hashes gives
compact windows: a window (l, c, r) stands for every passage that lies in [l, r] and holds c, as all of them have their least hash at c.
Nodes of fewer than ``LEAST`` tokens are cut off, which leaves about 2 n / LEAST windows of n tokens.

A band is two hash functions.  Where windows of both overlap, the two least hashes are the key of the common stretch: passages agree in a band
exactly when they share both.  Keys are dealt and sorted once, so that the stretches of one key follow each other; each is paired with the key's first document and with the
one before, never all with all, and the pairs' stretches are verified on the words themselves.

Such links can miss a pair of documents in the middle of a group.  So keys of four documents and more (fewer are all paired) are kept, and what links leave apart among their documents meets as well,
if their stretches there may hold as many tokens in common as similar passages do.

Exact repeats have a way of their own, by which they are found for certain.  Every passage of ``LEAST`` tokens
lies in a stretch of the first band; if other documents share its key, the passage itself is a key, under
which all documents link to the first.  They share the words of that passage, so each such link holds.

Texts with the same words are copies, known by 128 bits of hash: only the one with the smallest id, their root, is looked at further.

Keys that a sample of the documents shows to be very common are dealt over several tasks by document; each part links to its own first document, and these to the
first of all.  Documents that very many others link to have their text sent to several tasks.  The sample decides only how work is dealt.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import connected_components, freed, small_batches, written
from .simhash import COMMON, MARKS, marks, remixed, words_of

SHINGLE = 5
#: A passage has at least so many words, hence LEAST shingles.
WORDS = 50
LEAST = WORDS - SHINGLE + 1
#: Bands of two hash functions.  At similarity 0.8 a passage of LEAST tokens agrees with another in one of two with probability 0.87; longer ones hold several.
BANDS = 2
#: Band numbers that mark the two hashes of a whole text.
WHOLE = (14, 15)
SIMILARITY = 0.8
#: Shingles that may differ between two shared ones within a passage: what two changed words leave.
GAP = 2 * SHINGLE + 2
#: Documents of a key that meet without a token in common if links leave them apart; their marks alone tell.
BUCKET = 4
#: So many document numbers are broadcast at most; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: So many stretches are broadcast at most to the texts they lie in.
BROADCAST_PLACES = 50_000
#: One of so many documents is looked at for common keys; rows of one key that a task gets, about; most keys that are split.
SAMPLE = 16
HOT_ROWS = 4096
HOT_KEYS = 100_000
#: Links to one document that a task gets, about.
HOT_LINKS = 1024
_BASE = np.uint64(0x100000001B3)


def tokens_of(text: str | None) -> np.ndarray:
    """64-bit hashes of the text's five-word shingles."""
    words = words_of(text)
    if len(words) < SHINGLE:
        return np.zeros(0, dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    h = np.fromiter(map(digest, words), dtype=np.uint64, count=len(words))
    out = np.zeros(len(h) - SHINGLE + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(SHINGLE):
            out = out * _BASE + h[k : len(h) - SHINGLE + 1 + k]
    return out


def runs(t: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of every n tokens in a row."""
    t, out = remixed(t, 9), np.zeros(max(len(t) - n + 1, 0), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            out = out * _BASE + t[k : k + len(out)]
    return remixed(out, 1)


def _nearest(v: np.ndarray, or_equal: bool) -> np.ndarray:
    """For each place the nearest place to the left with a smaller value (or an equal one); the first value must be the smallest.

    Pointers skip what is known to be larger, all places at once.
    """
    to = np.maximum(np.arange(len(v)) - 1, 0)
    open_ = np.arange(1, len(v))
    while len(open_):
        at = to[open_]
        larger = v[at] > v[open_] if or_equal else v[at] >= v[open_]
        open_ = open_[larger & (at > 0)]
        to[open_] = to[to[open_]]
    return to


def windows(h: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Compact windows, rows (l, c, r), of several token sequences at once: h holds them with a zero before, between and after them.

    A window spans at least so many tokens; r is inclusive; the leftmost of equal hashes counts as the least.  A token has such a window
    exactly when it is the least of some stretch of ``least`` tokens; what bounds its window has one too, so bounds are sought among such tokens only.
    """
    if len(h) < least + 2:
        return np.zeros((0, 3), dtype=np.int64)
    value, place, size = h, np.arange(len(h)), 1
    while size < least:  # leftmost least of every stretch of size tokens
        step = min(size, least - size)
        right = value[step:] < value[:-step]
        place = np.where(right, place[step:], place[:-step])
        value = np.where(right, value[step:], value[:-step])
        size += step
    keep = np.ones(len(place), dtype=bool)
    keep[1:] = place[1:] != place[:-1]
    found = np.unique(np.concatenate((place[keep], np.flatnonzero(h == 0))))
    v = h[found]
    left = found[_nearest(v, True)]
    right = (len(h) - 1 - found[::-1])[_nearest(v[::-1], False)][::-1]
    rows = np.stack((left + 1, found, len(h) - 2 - right), axis=1)
    return rows[v > 0]


def _parts(key: np.ndarray, doc: np.ndarray, hot: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Part of its key that each row belongs to: 0 of a usual key, 1 to the number of parts of a hot one."""
    keys, parts = hot
    if not len(keys):
        return np.zeros(len(key), dtype=np.int32)
    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    mixed = (remixed(doc.view(np.uint64), 1) >> np.uint64(33)).astype(np.int64)
    return np.where(keys[at] == key, 1 + mixed % parts[at], 0).astype(np.int32)


def _hot_keys(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys of very many rows, sorted, and into how many parts each is split; sample: the rows (key, ...) of one of SAMPLE documents."""
    counts = sample.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") * SAMPLE > HOT_ROWS)
    got = counts.orderBy(F.desc("n"), "key").limit(HOT_KEYS).orderBy("key").toArrow()
    n = got["n"].to_numpy()
    return got["key"].to_numpy(), -(-n * SAMPLE // HOT_ROWS)


def _sampled(doc: str = "doc") -> Column:
    return F.pmod(F.xxhash64(doc), F.lit(SAMPLE)) == 0


class _Crowds:
    """Rows of keys that hold at least four documents, or are split, from sorted batches; rows of the open group wait until it holds as many."""

    def __init__(self) -> None:
        self.state: tuple[int, int] | None = None
        self.last, self.count = 0, 0
        self.waiting: list[list[np.ndarray]] = []

    def of(self, key: np.ndarray, part: np.ndarray, doc: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
        """(key, doc, place) of the batch's rows, and of earlier ones that waited; the marks of whole texts are left out."""
        cols = [key, doc, place]
        start = np.ones(len(key), dtype=bool)
        start[1:] = (key[1:] != key[:-1]) | (part[1:] != part[:-1])
        group = np.cumsum(start) - 1
        change = start.copy()
        change[1:] |= doc[1:] != doc[:-1]
        count = np.bincount(group[change])
        goes_on = self.state == (int(key[0]), int(part[0]))
        if goes_on:
            count[0] += self.count - (int(doc[0]) == self.last)
        else:
            self.waiting = []
        crowded = (count > 3) | (part[start] > 0)
        out = [[c[crowded[group]] for c in cols]]
        if crowded[0]:
            out, self.waiting = [*self.waiting, *out], []
        if len(count) > 1:
            self.waiting = []
        if not crowded[-1]:
            self.waiting.append([c[group == group[-1]] for c in cols])
        self.state, self.last, self.count = (int(key[-1]), int(part[-1])), int(doc[-1]), int(count[-1])
        got = [np.concatenate(c) for c in zip(*out, strict=True)]
        near = got[2] & 15 < min(WHOLE)
        return [c[near] for c in got]


def _met(found: DataFrame, before: bool) -> tuple[DataFrame, DataFrame]:
    """(doc, other, place) over the rows (key, part, doc, place): the group's first document, and the one before if wanted; and the rows (key, doc, place) of keys of four documents and more, if that is wanted.

    If the one before is wanted, rows of the first band also have an empty other where the group holds several documents.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of the group that is open: its key and part, first and last document, the one before the last, places of the first one's rows that wait for a second document.
        state: tuple[int, int] | None = None
        first = last = previous = 0
        has_previous = False
        waiting: list[np.ndarray] = []
        crowds = _Crowds()
        for b in batches:
            key, part, doc, place = (c.to_numpy() for c in b.columns)
            n = len(key)
            if not n:
                continue
            start = np.ones(n, dtype=bool)
            start[1:] = (key[1:] != key[:-1]) | (part[1:] != part[:-1])
            goes_on = state == (int(key[0]), int(part[0]))
            group = np.cumsum(start) - 1
            heads = doc[start]
            change = start.copy()
            change[1:] |= doc[1:] != doc[:-1]
            run_of = np.cumsum(change) - 1
            docs = doc[change]
            runs_group = group[change]
            prev = np.zeros(len(docs), dtype=np.int64)
            has = np.zeros(len(docs), dtype=bool)
            has[1:] = runs_group[1:] == runs_group[:-1]
            prev[1:] = docs[:-1]
            if goes_on:
                heads = heads.copy()
                heads[0] = first
                same = int(docs[0]) == last
                has[0], prev[0] = (has_previous, previous) if same else (True, last)
            head = heads[group]
            later = doc != head
            held = [(doc[later], head[later], place[later])]
            if before:
                also = later & has[run_of] & (prev[run_of] != head)
                held.append((doc[also], prev[run_of][also], place[also]))
            several = np.zeros(len(heads), dtype=bool)
            several[group[later]] = True
            if goes_on and has_previous:  # a second document came before this batch
                several[0] = True
            own = place & 15 == 0 if before else np.zeros(n, dtype=bool)
            alone = [(doc[x], place[x]) for x in ((own & later) | (own & ~later & (several[group] | (part > 0))),)]
            if goes_on and several[0]:
                alone += [(np.full(len(p), first, dtype=np.int64), p) for p in waiting]
            if not goes_on or several[0] or len(heads) > 1:
                waiting = []
            if not several[-1] and part[-1] == 0:
                waiting.append(place[own & (group == group[-1])])
            top = part > 0
            top &= ~later
            state, first, last = (int(key[-1]), int(part[-1])), int(head[-1]), int(doc[-1])
            has_previous, previous = bool(has[-1]), int(prev[-1])
            some = [(d, o, p, np.ones(len(d), dtype=bool), None) for d, o, p in held]
            some += [(d, d, p, np.zeros(len(d), dtype=bool), None) for d, p in alone]
            some.append((doc[top], doc[top], place[top], np.zeros(int(top.sum()), dtype=bool), key[top]))
            other = pa.array(np.concatenate([x[1] for x in some]), mask=~np.concatenate([x[3] for x in some]))
            keys = pa.array(np.concatenate([np.zeros(len(x[0]), dtype=np.int64) if x[4] is None else x[4] for x in some]), mask=np.concatenate([np.full(len(x[0]), x[4] is None) for x in some]))
            names = ["doc", "other", "place", "key", "crowd"]
            size = len(keys)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[0] for x in some])), other, pa.array(np.concatenate([x[2] for x in some])), keys, pa.nulls(size, pa.int64())], names)
            if before:
                crowd, docs, places = crowds.of(key, part, doc, place)
                none = pa.nulls(len(crowd), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(docs), none, pa.array(places), none, pa.array(crowd)], names)

    dealt = found.select("key", "part", "doc", "place").repartition("key", "part").sortWithinPartitions("key", "part", "doc")
    every = written(dealt.mapInArrow(run, "doc long, other long, place long, key long, crowd long"))
    got = every.where("crowd is null")
    freed(found.sparkSession)
    # Firsts of the parts of common keys.
    tops = got.where("key is not null")
    ends = tops.groupBy("key").agg(F.min("doc").alias("first"))
    joined = tops.join(ends, "key").where("doc <> first").select("doc", F.col("first").alias("other"), "place")
    return got.where("key is null").select("doc", "other", "place").union(joined), every.where("crowd is not null").select(F.col("crowd").alias("key"), "doc", "place")


def _bands(joined: np.ndarray, borders: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(key, l, c, r, band) of the stretches of each band; borders: the places of zeros between the token sequences that joined holds."""
    for band in range(BANDS):
        h, start, rows = [], [], []
        for fn in (2 * band, 2 * band + 1):
            x = np.maximum(remixed(joined, fn + 1), 1)
            x[borders] = 0
            got = windows(x)
            h.append(x)
            rows.append(got)
            start.append(np.maximum(got[:, 0], got[:, 1] - LEAST + 1))  # of the passages of LEAST tokens that have their least hash at c
        every = np.unique(np.concatenate(start))
        one, two = (rows[i][np.searchsorted(start[i], every, side="right") - 1] for i in (0, 1))
        with np.errstate(over="ignore"):
            key = remixed(h[0][one[:, 1]] * _BASE + h[1][two[:, 1]], 20 + band)
        yield key, np.maximum(one[:, 0], two[:, 0]), one[:, 1], np.minimum(one[:, 2], two[:, 2]), band


def _windows_of(df: DataFrame, hot: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """(key, part, doc, place) over the rows (doc, text); place packs the band and l and r into one long, see _unpacked; for a whole text its number and r, its last token."""
    hot = hot or (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))
    sent = df.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zero = np.zeros(1, dtype=np.uint64)
        for b in batches:
            for at in range(0, len(b), 128):
                part = b.slice(at, 128)
                ids = [(d, t) for d, t in zip(part.column(0).to_pylist(), map(tokens_of, part.column(1).to_pylist()), strict=True) if len(t) >= LEAST]
                if not ids:
                    continue
                long = np.array([len(t) for _, t in ids])
                first = np.cumsum([1, *(long + 1)])
                doc = np.array([d for d, _ in ids], dtype=np.int64)
                joined = np.concatenate([zero, *(x for _, t in ids for x in (t, zero))])
                keys, docs, places = [], [], []
                for key, left, c, right, band in _bands(joined, first - 1):
                    owner = np.searchsorted(first, c, side="right") - 1
                    keys.append(key)
                    docs.append(doc[owner])
                    places.append((left - first[owner] << 32) + (right - first[owner] << 4) + band)
                for k, mark in enumerate(WHOLE):
                    keys.append(np.array([xxhash.xxh3_64_intdigest(t.tobytes(), k) for _, t in ids], dtype=np.uint64))
                    docs.append(doc)
                    places.append((long - 1 << 4) + mark)
                key, owner = np.concatenate(keys).view(np.int64), np.concatenate(docs)
                cols = [key, _parts(key, owner, sent.value), owner, np.concatenate(places)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], ["key", "part", "doc", "place"])

    return df.mapInArrow(run, "key long, part int, doc long, place long")


def _unpacked(place: int) -> tuple[int, int, int]:
    """(band, l, r): 4 bits of band, 28 bits each of the places; a text has fewer than 2**28 words."""
    return place & 15, place >> 32, place >> 4 & (1 << 28) - 1


def _stretches_of(df: DataFrame, hot: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """(key, part, doc, place): every LEAST tokens in a row in the stretches met, over the rows (doc, text, met); the first of equal ones of a row."""
    hot = hot or (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))
    sent = df.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, text, met in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                tokens = tokens_of(text)
                on = np.zeros(max(len(tokens) - LEAST + 1, 0), dtype=bool)
                for _, left, right in map(_unpacked, met):
                    on[left : max(right - LEAST + 2, left)] = True
                at = np.flatnonzero(on)
                key, k = np.unique(runs(tokens, LEAST)[at], return_index=True)
                key, owner = key.view(np.int64), np.full(len(key), doc, dtype=np.int64)
                cols = [key, _parts(key, owner, sent.value), owner, at[k]]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], ["key", "part", "doc", "place"])

    return df.mapInArrow(run, "key long, part int, doc long, place long")


def merged(found: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Token stretches [a, b) that the stretches (band, l, r) cover together."""
    out: list[tuple[int, int]] = []
    for _, a, r in sorted(found, key=lambda x: x[1]):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], r + 1))
        else:
            out.append((a, r + 1))
    return out


def _followed(a: np.ndarray, b: np.ndarray, pos: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Places in b of a's tokens at pos, where b repeats tokens: on the diagonal if it goes on, else the next place, else the first."""
    to, expected, last = [], -1, int(pos[0])
    where, first, end, right = a.tolist(), low.tolist(), high.tolist(), b.tolist()
    for p in pos.tolist():
        expected, last = expected + p - last if to else -1, p
        if not (0 <= expected < len(right) and right[expected] == where[p]):
            some = order[first[p] : end[p]]
            k = int(np.searchsorted(some, expected))
            expected = int(some[k if k < len(some) else 0])
        to.append(expected)
    return np.array(to)


def verified(a: np.ndarray, b: np.ndarray, where: list[tuple[int, int]], similarity: float = SIMILARITY, least: int = LEAST) -> list[tuple[int, int, int, int]]:
    """Passages (a start, a end, b start, b end), in tokens, ends exclusive, of at least so many tokens and that similarity of their sets.

    Shared tokens are chained along the diagonal; a chain below the similarity is cut at its largest gap.
    """
    order = np.argsort(b, kind="stable")
    ranked = b[order]
    at = np.searchsorted(ranked, a)
    hit = at < len(b)
    hit[hit] = ranked[at[hit]] == a[hit]
    inside = np.zeros(len(a), dtype=bool)
    for x, y in where:
        inside[x:y] = True
    pos = np.flatnonzero(hit & inside)
    if len(pos) == 0:
        return []
    to = order[at[pos]]
    if (ranked[1:] == ranked[:-1]).any():
        to = _followed(a, b, pos, order, at, np.searchsorted(ranked, a, side="right"))
    step = np.diff(pos)
    breaks = np.flatnonzero((step > GAP) | (np.abs(np.diff(to) - step) > GAP)) + 1
    todo = list(zip([0, *breaks.tolist()], [*breaks.tolist(), len(pos)], strict=True))
    out = []
    while todo:
        x, y = todo.pop()
        a0, a1 = int(pos[x]), int(pos[y - 1]) + 1
        b0, b1 = int(to[x:y].min()), int(to[x:y].max()) + 1
        if a1 - a0 < least or b1 - b0 < least:
            continue
        sa, sb = np.unique(a[a0:a1]), np.unique(b[b0:b1])
        both = len(np.intersect1d(sa, sb, assume_unique=True))
        if both >= similarity * (len(sa) + len(sb) - both):
            out.append((a0, a1, b0, b1))
        elif y - x > 1:
            cut = x + 1 + int(np.argmax(np.diff(pos[x:y]) + np.abs(np.diff(to[x:y]) - np.diff(pos[x:y]))))
            todo += [(x, cut), (cut, y)]
    return sorted(out)


def _one_text(rows: DataFrame) -> DataFrame:
    """rows (doc, text) with one text, the least, for each document.  Only documents that stand there more than once are gathered; usually there are none."""
    twice = written(rows.groupBy("doc").agg(F.count("*").alias("n")).where("n > 1").select("doc"))
    if twice.isEmpty():
        return rows
    least = rows.join(twice, "doc", "left_semi").groupBy("doc").agg(F.min("text").alias("text"))
    return rows.join(twice, "doc", "left_anti").union(written(least))


def repeated_passages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Links (doc, start, end, other, other_start, other_end) between passages of two documents, in word places, ends exclusive.

    Every repeated passage of each document is in some link, as doc or as other; a copy has one link, over all its words, to its root, and copies of one passage link to a few documents only.
    Null, empty and short texts have no passages; rows with a null id take no part, and rows with equal ids count as one text (the least).
    """
    return _linked(df, id_col, text_col)[0]


def _linked(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The links of repeated_passages, and (node, component) over them."""
    small_batches(df.sparkSession)
    rows = _one_text(df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")))
    met, crowds = _met(_windows_of(rows, _hot_keys(_windows_of(rows.where(_sampled())))), True)
    met = met.withColumn("band", F.col("place").bitwiseAND(15))
    both = met.where((F.col("band") >= min(WHOLE)) & F.col("other").isNotNull()).groupBy("doc", "other").agg(F.collect_set("place").alias("marks")).where(F.size("marks") == len(WHOLE))
    # A copy in a part of a common key has the part's first as other, which may be a copy itself.
    both = written(both.groupBy("doc").agg(F.min("other").alias("other"), F.first(F.shiftright(F.col("marks")[0], 4)).alias("last")))
    up = both.select(F.col("doc").alias("other"), F.col("other").alias("up"))
    copies = written(both.join(up, "other", "left").select("doc", F.coalesce("up", "other").alias("root"), "last"))
    small = copies.count() <= BROADCAST_IDS
    gone = F.broadcast(copies.select("doc")) if small else copies.select("doc")
    roots = copies.select(F.col("doc").alias("other"), "root")
    met = met.where(F.col("band") < min(WHOLE)).select("doc", "other", "place").join(gone, "doc", "left_anti").join(F.broadcast(roots) if small else roots, "other", "left")
    pairs = written(met.groupBy("doc", F.coalesce("root", "other").alias("other")).agg(F.collect_set("place").alias("met")))
    freed(df.sparkSession)
    links = written(_links(rows, pairs.where("other is not null")))
    around = written(pairs.where("other is null").select("doc", "met"))
    if (around.agg(F.sum(F.size("met"))).first()[0] or 0) <= BROADCAST_PLACES:
        around = F.broadcast(around)
    marked = rows.join(around, "doc").select("doc", "text", "met")
    met = _met(_stretches_of(marked, _hot_keys(_stretches_of(marked.where(_sampled())))), False)[0].where("other is not null").withColumnRenamed("place", "at")
    late = F.col("doc") > F.col("other")
    had = links.select(F.greatest("doc", "other").alias("doc"), F.least("doc", "other").alias("other"), F.when(late, F.col("start")).otherwise(F.col("other_start")).alias("start"), F.when(late, F.col("end")).otherwise(F.col("other_end")).alias("end"))
    known = (met["doc"] == had["doc"]) & (met["other"] == had["other"]) & (had["start"] <= met["at"]) & (met["at"] + WORDS <= had["end"])
    # No stretches: the whole texts are verified.
    more = written(met.join(had, known, "left_anti").select("doc", "other", F.array().cast("array<long>").alias("met")).distinct())
    freed(df.sparkSession)
    end, none = F.col("last") + SHINGLE, F.lit(0).cast("long")
    whole = copies.select("doc", none.alias("start"), end.alias("end"), F.col("root").alias("other"), none.alias("other_start"), end.alias("other_end"))
    links = links.union(written(_links(rows, more))).union(whole)
    comp = written(connected_components(links.select(F.col("doc").alias("a"), F.col("other").alias("b"))))
    apart = _apart(rows, crowds.join(gone, "doc", "left_anti"), comp).join(pairs.where("other is not null").select("doc", "other"), ["doc", "other"], "left_anti")
    if (apart := written(apart)).isEmpty() or (late := written(_links(rows, apart))).isEmpty():
        return links, comp
    links = links.union(late)
    return links, connected_components(links.select(F.col("doc").alias("a"), F.col("other").alias("b")))


def _distinct(tokens: np.ndarray) -> int:
    """The least number of different tokens in a stretch of LEAST, or of all if they are fewer."""
    order = np.lexsort((np.arange(len(tokens)), tokens))
    before = np.full(len(tokens), -1)
    before[order[1:]] = np.where(tokens[order[1:]] == tokens[order[:-1]], order[:-1], -1)
    if len(tokens) <= LEAST:
        return int((before < 0).sum())
    # A token that comes again d places on is missing in the stretches that hold both.
    again = np.flatnonzero((before >= 0) & (np.arange(len(tokens)) - before < LEAST))
    lost = np.zeros(len(tokens) + 1, dtype=np.int64)
    np.add.at(lost, np.maximum(again - LEAST + 1, 0), 1)
    np.add.at(lost, before[again] + 1, -1)
    return LEAST - int(np.cumsum(lost)[: len(tokens) - LEAST + 1].max())


def _prefix(tokens: np.ndarray, rank: np.ndarray, met: list[tuple[int, int]]) -> tuple[np.ndarray, int, int, np.ndarray]:
    """(places, number of different tokens, how many a similar passage shares at least, marks) of the stretches met; places: of their first tokens by rank, one of which is shared by any document with a similar passage there."""
    held = [tokens[x:y] for x, y in met]
    need = math.ceil(SIMILARITY * min(map(_distinct, held)) - 1e-9)
    at = np.concatenate([np.arange(x, min(y, len(tokens))) for x, y in met])
    _, first = np.unique(rank[at], return_index=True)
    return at[first[: len(first) - need + 1]], len(first), need, marks(tokens[at].view(np.int64))


def _apart(rows: DataFrame, crowds: DataFrame, comp: DataFrame) -> DataFrame:
    """(doc, other, met), doc > other: pairs of documents of a key in crowds (key, doc, place) that comp leaves apart and that may share a similar passage there.

    Similar passages share most tokens.  Let the tokens of all documents have one order, the common ones last, and let a document need so many shared ones: then the first that it shares comes
    before the last so many of its stretches' tokens.  So only documents meet that have a token at such a place in common, and only if what follows, and what their marks say, is enough for both.
    """
    of = crowds.join(comp, F.col("doc") == F.col("node"), "left").select("key", "doc", "place", F.coalesce("component", "doc").alias("part"))
    keys = of.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select("key")
    each = written(of.join(keys, "key", "left_semi").groupBy("key", "doc", "part").agg(F.collect_set("place").alias("met")))
    freed(rows.sparkSession)
    # A text is read once for all its keys.
    few = each.groupBy("key").agg((F.count("*") <= BUCKET).alias("few"))
    texts = rows.join(each.join(few, "key").groupBy("doc", "part").agg(F.collect_list(F.struct("key", "met", "few")).alias("at")), "doc").select("doc", "part", "at", "text")

    def every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [np.unique(tokens_of(t)).view(np.int64) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *own]))], ["token"])

    sample = texts.where(_sampled()).select("text").mapInArrow(every, "token long").groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    got = sample.orderBy(F.desc("n"), "token").limit(COMMON).orderBy("token").toArrow()
    sent = rows.sparkSession.sparkContext.broadcast((got["token"].to_numpy(), got["n"].to_numpy()))
    named = [f"m{k}" for k in range(MARKS)]
    names = ["key", "token", "doc", "part", "rest", "need", "size", *named]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = sent.value
        for b in batches:
            out = []
            for doc, part, at, text in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                tokens = tokens_of(text)
                signed = tokens.view(np.int64)
                common = np.zeros(len(tokens), dtype=np.int64)
                if len(known):
                    k = np.minimum(np.searchsorted(known, signed), len(known) - 1)
                    common = np.where(known[k] == signed, counts[k], 0)
                order = np.lexsort((signed, common))
                rank = np.empty(len(tokens), dtype=np.int64)
                rank[order] = np.cumsum(np.append(True, signed[order[1:]] != signed[order[:-1]]))
                for x in at:
                    first, size, need, bits = _prefix(tokens, rank, merged([_unpacked(m) for m in x["met"]]))
                    n = 1 if x["few"] else len(first)
                    out.append((np.full(n, x["key"]), np.zeros(1, dtype=np.int64) if x["few"] else signed[first], np.full(n, doc), np.full(n, part), size - np.arange(n, dtype=np.int32), np.full(n, need, dtype=np.int32), np.full(n, size, dtype=np.int32), *(np.full(n, m) for m in bits)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names)

    tokens = written(texts.mapInArrow(run, f"key long, token long, doc long, part long, rest int, need int, size int, {', '.join(f'{m} long' for m in named)}"))
    shared = tokens.groupBy("key", "token").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select("key", "token")
    some = tokens.join(shared, ["key", "token"], "left_semi").select("key", "token", "part", "doc", F.struct("rest", "need", "size", *named).alias("x"))
    other = some.select("key", "token", F.col("part").alias("part_other"), F.col("doc").alias("other"), F.col("x").alias("y"))
    x, y = F.col("x"), F.col("y")
    only = lambda x, y: sum((F.bit_count(x[m].bitwiseAND(F.bitwise_not(y[m]))) for m in named), F.lit(0))
    least = F.greatest(x["need"], y["need"])
    enough = (F.least(x["rest"], y["rest"]) >= least) & (x["size"] - only(x, y) >= least) & (y["size"] - only(y, x) >= least)
    pairs = some.join(other, ["key", "token"]).where((F.col("doc") > F.col("other")) & (F.col("part") != F.col("part_other")) & enough).select("key", "doc", "other").distinct()
    return pairs.join(each.select("key", "doc", "met"), ["key", "doc"]).groupBy("doc", "other").agg(F.array_distinct(F.flatten(F.collect_list("met"))).alias("met"))


def _links(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """The verified links of the pairs (doc, other, met); without stretches in met, of the whole texts."""
    ends = written(pairs.select(F.explode(F.array("doc", "other")).alias("doc")).distinct())
    if ends.count() <= BROADCAST_IDS:
        ends = F.broadcast(ends)
    texts = written(rows.join(ends, "doc", "left_semi"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, b_tokens = None, None
        for batch in batches:
            out = []
            for doc, other, met, ta, tb in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                where, more = merged([_unpacked(m) for m in met]) if met else [(0, len(ta))], SHINGLE - 1
                if last != other:
                    last, b_tokens = other, tokens_of(tb)
                out += [(doc, a0, a1 + more, other, b0, b1 + more) for a0, a1, b0, b1 in verified(tokens_of(ta), b_tokens, where)]
            names = ["doc", "start", "end", "other", "other_start", "other_end"]
            cols = list(zip(*out, strict=True)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names)

    # Documents that very many link to: their texts go to several tasks.  There are at most HOT_KEYS of them, so the counts can be broadcast.
    count = pairs.groupBy("other").agg(F.count("*").alias("n")).where(F.col("n") > HOT_LINKS).orderBy(F.desc("n"), "other").limit(HOT_KEYS)
    hubs = F.broadcast(written(count.select("other", F.ceil(F.col("n") / HOT_LINKS).cast("int").alias("parts"))))
    part = F.pmod(F.xxhash64("doc"), F.coalesce("parts", F.lit(1))).cast("int")
    here = pairs.join(hubs, "other", "left").select("doc", "other", "met", part.alias("part"))
    there = texts.select(F.col("doc").alias("other"), F.col("text").alias("tb")).join(hubs, "other", "left")
    there = there.select("other", "tb", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part"))
    both = here.join(texts.withColumnRenamed("text", "ta"), "doc").join(there, ["other", "part"])
    return both.select("doc", "other", "met", "ta", "tb").mapInArrow(run, "doc long, start long, end long, other long, other_start long, other_end long")


def passage_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of df: doc_id, class_id, n_links, n_passages, n_words, passages (start:end in words, comma-joined).

    class_id is the smallest document reachable over shared passages, the document itself if it shares none; n_links counts the documents its passages
    were linked to (copies of one passage link to a few documents only).  Rows with a null id have a null class; rows with equal ids get the same
    figures.  Other columns take no part.
    """
    links, comp = _linked(df, id_col, text_col)
    links = written(links)
    both = links.select("doc", "start", "end", "other").union(links.select("other", "other_start", "other_end", "doc"))
    spans = both.select("doc", "start", "end").distinct()
    partners = both.select("doc", "other").distinct().groupBy("doc").agg(F.count("*").alias("n_links"))
    before = Window.partitionBy("doc").orderBy("start", "end")
    reach = F.max("end").over(before.rowsBetween(Window.unboundedPreceding, -1))
    new = spans.withColumn("new", F.coalesce((F.col("start") > reach).cast("int"), F.lit(1))).withColumn("part", F.sum("new").over(before.rowsBetween(Window.unboundedPreceding, 0)))
    merged = new.groupBy("doc", "part").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    by_doc = merged.groupBy("doc").agg(F.count("*").alias("n_passages"), F.sum(F.col("end") - F.col("start")).alias("n_words"), F.array_sort(F.collect_list(F.struct("start", "end"))).alias("all"))
    text = F.array_join(F.transform("all", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    figures = by_doc.join(partners, "doc").join(comp.withColumnRenamed("node", "doc"), "doc").withColumn("passages", text)
    out = df.select(F.col(id_col).cast("long").alias("doc")).join(figures, "doc", "left")
    zero = F.lit(0).cast("long")
    return out.select(F.col("doc").alias("doc_id"), F.coalesce("component", "doc").alias("class_id"), *[F.coalesce(c, zero).alias(c) for c in ("n_links", "n_passages", "n_words")], F.coalesce("passages", F.lit("")).alias("passages"))
