"""Benchmark decontamination with a generalised suffix automaton over the words of the test items.

The automaton reads a document's words one by one and keeps the longest suffix of what it has read that occurs in an item.
Where that length reaches an item window (``WINDOW`` words, or a whole shorter item), the window's words are hit.
The automaton is built on the driver and broadcast.  Its size is that of the items: they are cut
into blocks of at most ``BLOCK_WORDS`` words, each with an automaton of its own, so that no broadcast grows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import sent, small_batches, written

WINDOW = 13
#: Least share of hit words, as 1 in so many, for a contaminated document.
SHARE = 20
BLOCK_WORDS = 500_000
#: Blocks whose automata are scanned in one pass.
GROUP = 4
#: What is kept of a text, from it, its hit spans and its number of words.
Left = Callable[[str | None, list[tuple[int, int]], int], str | None]
#: Word bytes stay (A-Z lower-cased); all other ASCII becomes a space.  Bytes from 0x80 on belong to letters beyond ASCII.
_TABLE = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of the text with A-Z lower-cased."""
    return (text or "").encode("utf-8", "replace").translate(_TABLE).split()


class ItemAutomaton:
    """Suffix automaton over word numbers of several items; a separator follows each item."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW) -> None:
        self.window, self.vocab = window, {}
        step: list[dict[int, int]] = [{}]
        link, length = [-1], [0]
        #: Of each state: the items that hold its strings; below, the short items that its longest string spells.
        holds: list[set[str]] = [set()]
        whole: dict[int, set[str]] = {}
        for item, words in items:
            last = 0
            for w in words:
                c = self.vocab.setdefault(w, len(self.vocab))
                last = self._grow(step, link, length, holds, last, c)
                holds[last].add(item)
        for s in sorted(range(1, len(step)), key=length.__getitem__, reverse=True):
            holds[link[s]] |= holds[s]
        short = [(i, w) for i, w in items if len(w) < window]
        for item, words in short:
            s = 0
            for w in words:
                s = step[s][self.vocab[w]]
            whole.setdefault(s, set()).add((item, len(words)))
        self.least = min([window, *(len(w) for _, w in items)]) if items else 0
        self.step, self.link, self.length = step, link, length
        self.holds = [frozenset(x) if length[s] >= window else frozenset() for s, x in enumerate(holds)]
        #: Short items that end where the state is met: its own, and those of the states its links lead to.
        #: A short item is the longest string of its state, as nothing precedes it in all its places.
        self.ends: list[tuple] = [()] * len(step)
        for s in sorted(range(1, len(step)), key=length.__getitem__):
            self.ends[s] = (*whole.get(s, ()), *self.ends[link[s]])

    @staticmethod
    def _grow(step: list, link: list, length: list, holds: list, last: int, c: int) -> int:
        if c in step[last]:
            q = step[last][c]
            if length[q] == length[last] + 1:
                return q
            return ItemAutomaton._split(step, link, length, holds, last, c, q)
        new = len(step)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        holds.append(set())
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            link[new] = q if length[q] == length[p] + 1 else ItemAutomaton._split(step, link, length, holds, p, c, q)
        return new

    @staticmethod
    def _split(step: list, link: list, length: list, holds: list, p: int, c: int, q: int) -> int:
        copy = len(step)
        step.append(dict(step[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        holds.append(set())
        link[q] = copy
        while p >= 0 and step[p].get(c) == q:
            step[p][c] = copy
            p = link[p]
        return copy

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit spans [start, end) of word places, in order and merged, and the items with occurring windows."""
        spans: list[list[int]] = []
        items: set[str] = set()
        if not self.least or len(words) < self.least:
            return [], items
        get = self.vocab.get
        known = np.fromiter((get(w, -1) for w in words), dtype=np.int64, count=len(words))
        inside = np.diff(np.concatenate(([0], (known >= 0).view(np.int8), [0])))
        starts, stops = np.flatnonzero(inside == 1), np.flatnonzero(inside == -1)
        enough = stops - starts >= self.least
        step, link, length, window, ends, holds = self.step, self.link, self.length, self.window, self.ends, self.holds
        for a, b in zip(starts[enough].tolist(), stops[enough].tolist(), strict=True):
            s = n = 0
            for at, c in enumerate(known[a:b].tolist(), a + 1):
                nxt = step[s].get(c)
                while nxt is None:
                    s = link[s]
                    n = length[s]
                    nxt = step[s].get(c)
                s = nxt
                n += 1
                reach = 0
                if n >= window:
                    t = s
                    while length[link[t]] >= window:
                        t = link[t]
                    items |= holds[t]
                    reach = window
                for item, k in ends[s] if n == length[s] else ends[link[s]]:
                    items.add(item)
                    reach = max(reach, k)
                if reach:
                    if spans and at - reach <= spans[-1][1]:
                        while len(spans) > 1 and at - reach <= spans[-2][1]:
                            spans.pop()
                        spans[-1][0] = min(spans[-1][0], at - reach)
                        spans[-1][1] = at
                    else:
                        spans.append([at - reach, at])
        return [(x, y) for x, y in spans], items


def _blocks(items: list[tuple[str, list[bytes]]], block_words: int) -> list[list]:
    out, size = [[]], 0
    for item in items:
        if out[-1] and size + len(item[1]) > block_words:
            out.append([])
            size = 0
        out[-1].append(item)
        size += len(item[1])
    return out


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def find_contamination(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, keep: tuple[str, ...] = (), block_words: int = BLOCK_WORDS, left: Left | None = None) -> DataFrame:
    """df's id and the columns in keep, n_words, hits array<struct<start, end>> of word places, items array<string>.

    Every row stays; null texts have no words; items that are null or wordless match nothing; null item ids are passed over.
    Equal items of several ids are all reported.  Columns in keep with the names of the results are replaced.  left makes the kept text from the text, the hit spans and the
    number of words in the last pass, so that no second worker stands beside each scanning one.  The items are read to the driver; the automata of GROUP of their
    blocks are broadcast and scanned in one pass, and what they found is written before the next are made.
    """
    small_batches(df.sparkSession)
    spark = df.sparkSession
    items = [(str(r[0]), words_of(r[1])) for r in benchmark.select(item_col, item_text_col).where(F.col(item_col).isNotNull() & F.col(item_text_col).isNotNull()).toLocalIterator()]
    blocks = _blocks(sorted(x for x in items if x[1]), block_words)
    keep = tuple(c for c in keep if c.lower() not in ("n_words", "hits", "items"))
    rest = [c for c in keep if c not in (id_col, text_col)]
    rows = df.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"), F.array().cast("array<struct<start:int,end:int>>").alias("__hits"), F.array().cast("array<string>").alias("__items"), F.lit(0).cast("long").alias("__n"), *rest)
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def scanner(held: list, texts: bool, left: Left | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automata = [get() for get in held]
            for b in batches:
                hits, names, count, kept = [], [], [], []
                for text, old, had in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                    words = words_of(text)
                    spans, found = [(x["start"], x["end"]) for x in old], set(had)
                    for auto in automata:
                        more, items = auto.scan(words)
                        spans = _merged([*spans, *more]) if spans else more
                        found |= items
                    hits.append([{"start": x, "end": y} for x, y in spans])
                    names.append(sorted(found))
                    count.append(len(words))
                    if left:
                        kept.append(left(text, spans, len(words)))
                new = [pa.array(hits, spans_type), pa.array(names, pa.list_(pa.string())), pa.array(count, pa.int64())]
                text = pa.nulls(len(b), b.schema.field(1).type) if not texts else pa.array(kept, b.schema.field(1).type) if left else b.column(1)
                yield pa.RecordBatch.from_arrays([b.column(0), text, *new, *b.columns[5:]], names=b.schema.names)

        return run

    for k in range(0, len(blocks), GROUP):
        rows = written(rows) if k else rows
        last = k + GROUP >= len(blocks)
        rows = rows.mapInArrow(scanner([sent(spark, ItemAutomaton(x, window)) for x in blocks[k : k + GROUP]], text_col in keep or not last, left if last and text_col in keep else None), rows.schema)
    kept = [F.col("__text").alias(text_col) if c == text_col else F.col(c) for c in keep if c != id_col]
    return rows.select(F.col("__id").alias(id_col), *kept, F.col("__n").alias("n_words"), F.col("__hits").alias("hits"), F.col("__items").alias("items"))


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of some spans and what stands between those words."""
    data = text.encode("utf-8", "replace")
    places = [m.span() for m in re.finditer(rb"[^ ]+", data.translate(_TABLE))]
    out, at = [], 0
    for a, b in spans:
        out.append(data[at : places[a][0]])
        at = places[b - 1][1]
    return b"".join([*out, data[at:]]).decode()


def own_text(text: str | None, spans: list[tuple[int, int]], n_words: int, least_words: int = 1, most_share: float = 0.5) -> str | None:
    """The text without its hit spans of at least so many words; null if more than most_share of its words are in them."""
    spans = [(x, y) for x, y in spans if y - x >= least_words]
    if text is None or sum(y - x for x, y in spans) > most_share * n_words:
        return None
    return without_spans(text, spans) if spans else text


def remove_hits(found: DataFrame, text_col: str = "text", least_words: int = 1, most_share: float = 0.5) -> DataFrame:
    """What find_contamination gave with the text kept: hit spans of at least so many words are cut from the text.

    A document of whose words more than most_share are hit has a null text: too little of its own is left.  Null texts stay null.
    """
    names = found.columns
    kind = found.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for text, hits, n in zip(b.column(text_col).to_pylist(), b.column("hits").to_pylist(), b.column("n_words").to_pylist(), strict=True):
                texts.append(own_text(text, [(h["start"], h["end"]) for h in hits], n, least_words, most_share))
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == text_col else b.column(c) for c in names], names)

    return found.mapInArrow(run, kind)


def contaminated() -> Column:
    """Over the columns n_words and hits: some word is hit and at least 1 in SHARE is."""
    n = n_hit()
    return (n > 0) & (SHARE * n >= F.col("n_words"))


def n_hit() -> Column:
    return F.aggregate("hits", F.lit(0).cast("long"), lambda acc, x: acc + (x["end"] - x["start"]))


