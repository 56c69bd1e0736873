"""Ranked lexical search with dual-sorted wavelet trees.

Documents are cut into shards of a bounded number of postings.  A shard numbers its documents by ascending id and writes the postings of all terms one after
the other, each term's by falling impact.  The sequence of document numbers is held as a wavelet tree whose levels lie in one array each: a node stands for a
range of ids, and a term's range in a node still falls by impact, so one sequence serves both orders.  The first posting of a term's range in a node
has the term's largest impact among the node's documents: the weighted sum over the terms bounds every score below the node, and is the score itself at a leaf.

A search descends all of an item's term ranges together, nodes with the highest bounds first, some hundred nodes at a time in numpy.  What is bounded
below the k-th best score so far can't be among the results, so these are exact.  Scores found in one shard prune the next ones of its task.

Impacts and weights are whole numbers, as the query's contract gives them, so sums are exact in any order.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, small_batches, written

K = 50
#: Postings of a shard: its tree takes about 8 bytes a posting and level.
SHARD = 1 << 20
#: Nodes that are expanded at once.
NODES = 128
#: Bytes of the items' terms that are searched in one pass over the documents; more items take more passes.
ITEM_BYTES = 16_000_000
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")


def terms_of(text: str | None) -> list[bytes]:
    """Terms of a text, A-Z lower-cased: runs of digits, letters and all beyond ASCII."""
    return _TERM.findall((text or "").encode("utf-8", "replace").lower())


def impact(tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """Saturated frequency of a term in a document of n terms, in millionths."""
    m = 100 - 50 + (50 * n * documents) // length
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class Tree:
    """Wavelet tree over a shard: docs are ids in ascending order; each posting is (term, place in docs, impact)."""

    def __init__(self, docs: np.ndarray, term: np.ndarray, doc: np.ndarray, impacts: np.ndarray, n_terms: int) -> None:
        order = np.lexsort((doc, -impacts, term))
        seq, imp = doc[order].astype(np.int32), impacts[order].astype(np.int32)
        self.docs, self.size = docs, len(seq)
        self.starts = np.searchsorted(term[order], np.arange(n_terms + 1)).astype(np.int64)
        self.bits = max(0, int(len(docs) - 1).bit_length())
        # zeros[v, i]: how many of the first i documents of level v go to the left; split[v]: how many in all; heads[v]: impacts in that level's order.
        self.zeros = np.zeros((self.bits, self.size + 1), dtype=np.int32)
        self.heads = np.empty((self.bits + 1, self.size), dtype=np.int32)
        self.split = np.zeros(self.bits + 1, dtype=np.int64)
        self.heads[0] = imp
        for v in range(self.bits):
            left = ((seq >> (self.bits - 1 - v)) & 1) == 0
            np.cumsum(left, out=self.zeros[v, 1:])
            self.split[v] = self.zeros[v, -1]
            seq, imp = np.concatenate((seq[left], seq[~left])), np.concatenate((imp[left], imp[~left]))
            self.heads[v + 1] = imp

    def root(self, terms: np.ndarray, weights: np.ndarray) -> tuple | None:
        """The group of just the root: nodes (bound, level, prefix) and entries (node, weight, from, to)."""
        a, b = self.starts[terms], self.starts[terms + 1]
        there = b > a
        if not there.any():
            return None
        a, b, w = a[there], b[there], weights[there]
        bound = np.array([(w * self.heads[0][a]).sum()])
        return bound, np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(len(a), np.int64), w, a, b

    def children(self, group: tuple) -> tuple:
        """The nodes one level below those of a group; those without a posting are left out."""
        _, level, prefix, node, w, a, b = group
        at = level[node]
        base = at * (self.size + 1)
        flat = self.zeros.ravel()
        za, zb = flat[base + a].astype(np.int64), flat[base + b].astype(np.int64)
        ones = self.split[at]
        here = np.concatenate((node * 2, node * 2 + 1))
        lo, hi = np.concatenate((za, ones + a - za)), np.concatenate((zb, ones + b - zb))
        keep = hi > lo
        here, lo, hi, w = here[keep], lo[keep], hi[keep], np.concatenate((w, w))[keep]
        below = np.repeat(level + 1, 2)
        best = w * self.heads.ravel()[below[here] * self.size + lo]
        # Sums stay far below 2^53, so doubles hold them exactly.
        bound = np.bincount(here, weights=best, minlength=len(below)).astype(np.int64)
        return bound, below, np.repeat(prefix * 2, 2) + np.tile([0, 1], len(prefix)), here, w, lo, hi


def picked(group: tuple, keep: np.ndarray) -> tuple:
    """The nodes of a group at the places keep, in that order."""
    bound, level, prefix, node, w, a, b = group
    to = np.full(len(bound), -1)
    to[keep] = np.arange(len(keep))
    node = to[node]
    held = node >= 0
    return bound[keep], level[keep], prefix[keep], node[held], w[held], a[held], b[held]


class Best:
    """The k best (score, id) so far, equal scores by ascending id."""

    def __init__(self, k: int) -> None:
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def least(self) -> int:
        """The score that a result needs at least."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate((self.scores, scores)), np.concatenate((self.ids, ids))
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]


def search(tree: Tree, terms: np.ndarray, weights: np.ndarray, best: Best) -> int:
    """Adds a shard's best documents for the terms; gives how many nodes were expanded."""
    first = tree.root(terms, weights)
    if first is None:
        return 0
    queue: list = [(-int(first[0][0]), 0, first)]
    made, expanded = 1, 0
    while queue and -queue[0][0] >= best.least:
        group = heapq.heappop(queue)[2]
        good = np.flatnonzero(group[0] >= best.least)
        group = picked(group, good)
        leaf = group[1] == tree.bits
        if leaf.any():
            best.add(group[0][leaf], tree.docs[group[2][leaf]])
            group = picked(group, np.flatnonzero(~leaf))
        if not len(group[0]):
            continue
        expanded += len(group[0])
        below = tree.children(group)
        good = np.flatnonzero(below[0] >= best.least)
        good = good[np.argsort(-below[0][good], kind="stable")]
        for at in range(0, len(good), NODES):
            some = picked(below, good[at : at + NODES])
            heapq.heappush(queue, (-int(some[0][0]), made, some))
            made += 1
    return expanded


def postings(df: DataFrame, id_col: str, text_col: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """(id, n, terms, tfs): how many terms each row's text has, and the numbers and frequencies of those in the vocabulary.  Rows keep their count."""
    sent = df.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = sent.value.get
        for b in batches:
            sizes, terms, tfs = [], [], []
            for text in b.column(1).to_pylist():
                found = terms_of(text)
                sizes.append(len(found))
                count = Counter(map(number, found))
                count.pop(None, None)
                terms.append(list(count.keys()))
                tfs.append(list(count.values()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))], ["id", "n", "terms", "tfs"])

    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, n long, terms array<int>, tfs array<int>")


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, terms, bytes): the distinct terms of each item; rows with equal ids are one item; items without an id or a term go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [sorted(set(terms_of(t))) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.binary()))], ["item", "terms"])

    each = items.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("item"), F.col(text_col).alias("text")).mapInArrow(run, "item long, terms array<binary>")
    whole = each.groupBy("item").agg(F.array_distinct(F.flatten(F.collect_list("terms"))).alias("terms")).where(F.size("terms") > 0)
    return whole.withColumn("bytes", F.aggregate("terms", F.lit(0), lambda s, t: s + F.length(t) + 64).cast("long"))


def _of_block(df: DataFrame, id_col: str, text_col: str, asked: list[tuple[int, list[bytes]]], k: int, shard: int, scratch: Scratch) -> DataFrame:
    """(item, doc_id, score) of the k best of each task, for items (number, terms)."""
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, terms in asked for t in terms}))}
    held = scratch.written(postings(df, id_col, text_col, vocabulary))
    total = held.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("length")).first()
    documents, length = total["documents"], total["length"] or 0
    # As many counts as the block of items has terms, a bounded number.
    counted = held.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toArrow()
    weights = np.zeros(len(vocabulary), dtype=np.int64)
    for term, df_ in zip(counted["term"].to_pylist(), counted["df"].to_pylist(), strict=True):
        weights[term] = weight(documents, df_)
    queries = []
    for item, terms in asked:
        own = np.array([vocabulary[t] for t in terms], dtype=np.int64)
        own = own[weights[own] > 0]
        queries.append((item, own, weights[own]))
    sent = df.sparkSession.sparkContext.broadcast(queries)
    n_terms = len(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {item: Best(k) for item, _, _ in sent.value}
        rows: list[pa.RecordBatch] = []

        def done() -> None:
            t = pa.Table.from_batches(rows)
            rows.clear()
            ids, n = t["id"].to_numpy(), t["n"].to_numpy()
            lists = t["terms"].combine_chunks()
            sizes = np.diff(lists.offsets.to_numpy())
            order = np.argsort(ids, kind="stable")
            place = np.empty(len(ids), dtype=np.int64)
            place[order] = np.arange(len(ids))
            row = np.repeat(np.arange(len(ids)), sizes)
            tf = t["tfs"].combine_chunks().flatten().to_numpy().astype(np.int64)
            tree = Tree(ids[order], lists.flatten().to_numpy().astype(np.int64), place[row], impact(tf, n[row], documents, length), n_terms)
            for item, terms, w in sent.value:
                search(tree, terms, w, best[item])

        size = 0
        for b in batches:
            at, sums = 0, np.cumsum(np.diff(b.column(2).offsets.to_numpy()))
            while at < len(b):  # as many rows as still fit; a row has no more postings than there are terms
                before = int(sums[at - 1]) if at else 0
                fit = max(1, int(np.searchsorted(sums, before + shard - size, side="right")) - at) if not rows else int(np.searchsorted(sums, before + shard - size, side="right")) - at
                if fit <= 0:
                    done()
                    size = 0
                    continue
                rows.append(b.slice(at, fit))
                at += fit
                size += int(sums[at - 1]) - before
        if rows:
            done()
        for item, found in best.items():
            yield pa.RecordBatch.from_arrays([pa.array([item] * len(found.ids), pa.int64()), pa.array(found.ids), pa.array(found.scores)], ["item", "doc_id", "score"])

    return held.where("id is not null and size(terms) > 0").mapInArrow(run, "item long, doc_id long, score long")


def ranked_search(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", k: int = K, shard: int = SHARD) -> DataFrame:
    """(item_id, rank, doc_id, score): the k highest-scoring documents of every item, all with a score above 0; equal scores by ascending doc_id.

    Every row of df counts as a document, repeated rows too (each can be a result); rows without an id count in the statistics but are no results.  Null and
    wordless texts have no terms: such documents and items get no rows.  Rows of items with equal ids are one item.  Empty tables give no rows;
    other columns take no part.  Items are searched in blocks of bounded size, a pass over the documents for each.
    """
    spark = df.sparkSession
    small_batches(spark)
    scratch = Scratch(spark)
    asked = scratch.written(item_terms(items, item_id_col, item_text_col))
    size = asked.agg(F.sum("bytes")).first()[0] or 0
    blocks = max(1, -(-size // ITEM_BYTES))
    found = None
    for block in range(blocks):
        part = [(r["item"], [bytes(t) for t in r["terms"]]) for r in asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).collect()]
        got = scratch.written(_of_block(df, id_col, text_col, part, k, shard, scratch))
        found = got if found is None else found.union(got)
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    out = written(top.select(F.col("item").alias("item_id"), "rank", "doc_id", "score"))
    scratch.drop()
    return out
