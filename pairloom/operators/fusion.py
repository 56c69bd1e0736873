"""Retrieval by cosine channels over weighted n-grams, and weighted reciprocal-rank fusion of channels.

A cosine channel gives each row its nearest targets among all whose cosine is LEAST or more.  It is exact: with the n-grams of a text in one order, rarest first, let its prefix be
the n-grams from which on the rest still has a norm of LEAST.  Two texts whose prefixes share nothing meet in the rest of one of them only, so their cosine is below LEAST.
So texts are joined on prefixes, which hold rare n-grams, and only pairs that meet there are measured.  Equal titles are one text until the end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.stages import Folder
from ..sources.catalog import keyed

# Weights of the channels, the constant of ranks, candidates kept by rank and with protected ones, targets of a channel, the least document frequency.
WEIGHTS = {"exact": 2.5, "words": 1.2, "characters": 1.1, "core": 1.4}
RANK_CONSTANT = 60
KEPT, KEPT_WITH_PROTECTED = 60, 75
TOP = {"exact": 20, "words": 25, "characters": 25, "core": 20}
MIN_DF = 2
#: Cosines below it aren't looked for.
LEAST = 0.7
_SLACK = 1e-9
Grams = Callable[[Column], Column]


def character_grams(title: Column) -> Column:
    """Runs of three to five characters of each word, with a space before and after it."""
    of_word = lambda w, n: F.when(F.length(w) >= n, F.transform(F.sequence(F.lit(1), F.length(w) - n + 1), lambda i: F.substring(w, i, n))).otherwise(F.array().cast("array<string>"))
    words = F.transform(F.filter(F.split(title, " "), lambda w: w != ""), lambda w: F.concat(F.lit(" "), w, F.lit(" ")))
    return F.flatten(F.transform(words, lambda w: F.concat(*[of_word(w, n) for n in (3, 4, 5)])))


def word_grams(title: Column) -> Column:
    """Words, and pairs of neighbours."""
    words = F.filter(F.split(title, " "), lambda w: w != "")
    pairs = F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda x, y: F.concat_ws(" ", x, y))
    return F.concat(words, F.filter(pairs, lambda p: F.contains(p, F.lit(" "))))


def _counted(texts: DataFrame, grams: Grams) -> DataFrame:
    """(title, gram, tf) of distinct titles."""
    return texts.select("title", F.explode(grams(F.col("title"))).alias("gram")).groupBy("title", "gram").agg(F.count("*").alias("tf"))


def _weighed(counted: DataFrame, idf: DataFrame) -> DataFrame:
    """(title, id, df, w): sublinear frequencies times idf, each title's of norm 1."""
    raw = counted.join(idf, "gram").withColumn("w", (1 + F.log("tf")) * F.col("idf"))
    norms = raw.groupBy("title").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return raw.join(norms, "title").select("title", "id", "df", (F.col("w") / F.col("norm")).alias("w"))


def _prefix(weighed: DataFrame, least: float) -> DataFrame:
    rest = F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("title").orderBy(F.desc("df"), F.desc("id")).rowsBetween(Window.unboundedPreceding, 0))
    return weighed.withColumn("rest", rest).where(F.col("rest") >= (least - _SLACK) ** 2).select("title", "id")


def _vectors(weighed: DataFrame) -> DataFrame:
    """(title, ids, ws) with ascending ids."""
    held = weighed.groupBy("title").agg(F.array_sort(F.collect_list(F.struct("id", "w"))).alias("v"))
    return held.select("title", F.transform("v", lambda x: x["id"]).alias("ids"), F.transform("v", lambda x: x["w"]).alias("ws"))


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Inner products of two sparse vectors a row; ids are below 2^40, rows of a batch below 2^23."""
    for b in batches:
        ids, ws, ids_b, ws_b = (b.column(i) for i in range(2, 6))
        keys, keys_b = ((np.repeat(np.arange(len(x), dtype=np.int64) << 40, np.diff(x.offsets.to_numpy())) | x.flatten().to_numpy()) for x in (ids, ids_b))
        values, values_b = ws.flatten().to_numpy(), ws_b.flatten().to_numpy()
        at = np.minimum(np.searchsorted(keys_b, keys), max(len(keys_b) - 1, 0))
        same = keys_b[at] == keys if len(keys_b) else np.zeros(len(keys), dtype=bool)
        dots = np.bincount(keys[same] >> 40, weights=values[same] * values_b[at[same]], minlength=b.num_rows)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(dots, pa.float64())], ["title", "title_B", "cosine"])


def cosine_channel(a: DataFrame, b: DataFrame, grams: Grams, top: int, least: float = LEAST, folder: Folder | None = None) -> DataFrame:
    """(row_key, b_index, cosine, rank) of the top nearest targets of each row, by cosine over n-grams weighed by their frequency in b; cosines of least or more.

    a: row_key, title; b: b_index, title.  Cosines are rounded to nine places; ties go to the smaller b_index.  n-grams of fewer than MIN_DF rows of b count nowhere.
    Null and empty titles have no n-grams and meet nothing; a row_key that comes twice is one row for each title.
    """
    folder = folder or Folder(a.sparkSession)
    a, b = (x.select(k, "title").where("title is not null").distinct() for x, k in ((a, "row_key"), (b, "b_index")))
    many = b.groupBy("title").agg(F.count("*").alias("rows"))
    grams_b = folder.staged(_counted(many, grams))
    total = b.agg(F.count("*").alias("total"))
    df = grams_b.join(many, "title").groupBy("gram").agg(F.sum("rows").alias("df")).where(F.col("df") >= MIN_DF)
    df = keyed(folder.staged(df), "id", "gram")
    idf = folder.staged(df.crossJoin(F.broadcast(total)).select("gram", "id", "df", (F.log((F.col("total") + 1) / (F.col("df") + 1)) + 1).alias("idf")))
    wa, wb = (folder.staged(_weighed(x, idf)) for x in (_counted(a.select("title").distinct(), grams), grams_b))
    met = _prefix(wa, least).join(_prefix(wb, least).withColumnRenamed("title", "title_B"), "id").select("title", "title_B").distinct()
    pairs = met.join(_vectors(wa), "title").join(_vectors(wb).select(F.col("title").alias("title_B"), F.col("ids").alias("ids_B"), F.col("ws").alias("ws_B")), "title_B")
    near = pairs.select("title", "title_B", "ids", "ws", "ids_B", "ws_B").mapInArrow(_products, "title string, title_B string, cosine double")
    near = near.withColumn("cosine", F.round("cosine", 9)).where(F.col("cosine") >= least)
    first = b.withColumn("n", F.row_number().over(Window.partitionBy("title").orderBy("b_index"))).where(F.col("n") <= top).select(F.col("title").alias("title_B"), "b_index")
    place = F.row_number().over(Window.partitionBy("title").orderBy(F.desc("cosine"), "b_index"))
    best = near.join(first, "title_B").withColumn("rank", place).where(F.col("rank") <= top)
    return folder.staged(a.join(best.drop("title_B"), "title").select("row_key", "b_index", "cosine", "rank"))


def exact_channel(a: DataFrame, b: DataFrame, top: int = TOP["exact"]) -> DataFrame:
    """(row_key, b_index, rank) of equal titles; of targets with one title the first."""
    place = F.row_number().over(Window.partitionBy("title").orderBy("b_index"))
    first = b.where("title <> ''").select("b_index", "title").withColumn("rank", place).where(F.col("rank") <= top)
    return a.select("row_key", "title").join(first, "title").select("row_key", "b_index", "rank")


def fused(channels: dict[str, DataFrame], weights: dict[str, float] | None = None, protected: str = "exact") -> DataFrame:
    """(row_key, b_index, score, channels, protected, rank): the sum of weight / (RANK_CONSTANT + rank) over the channels that hold a pair.

    Kept are the KEPT best of each row, and protected ones (those of one channel) up to KEPT_WITH_PROTECTED in all.  Ties go to the smaller b_index.  A pair counts once in a channel, at its best rank.
    """
    weights = weights or WEIGHTS
    each = [df.groupBy("row_key", "b_index").agg(F.min("rank").alias("rank")).withColumn("channel", F.lit(name)).withColumn("weight", F.lit(float(weights[name]))) for name, df in sorted(channels.items())]
    rows = each[0]
    for more in each[1:]:
        rows = rows.unionByName(more)
    # Summed as whole parts of 10^12, so that scores don't depend on the order of rows.
    part = F.round(F.col("weight") / (F.lit(RANK_CONSTANT) + F.col("rank")) * 1e12).cast("long")
    got = rows.groupBy("row_key", "b_index").agg(F.sum(part).alias("s"), F.count("*").alias("channels"), F.max(F.col("channel") == protected).alias("protected"))
    best, order = Window.partitionBy("row_key").orderBy(F.desc("s"), "b_index"), Window.partitionBy("row_key").orderBy(F.desc("kept"), F.desc("s"), "b_index")
    got = got.withColumn("rank", F.row_number().over(best)).withColumn("kept", (F.col("rank") <= KEPT) | F.col("protected"))
    got = got.where("kept").withColumn("n", F.row_number().over(order)).where(F.col("n") <= KEPT_WITH_PROTECTED)
    return got.select("row_key", "b_index", (F.col("s") / 1e12).alias("score"), "channels", "protected", "rank")


def candidates(a: DataFrame, b: DataFrame, least: float = LEAST) -> DataFrame:
    """Fused candidates of all channels; a: row_key, title, core; b: b_index, title, core (see blocking.features)."""
    folder = Folder(a.sparkSession)
    core = lambda x, k: x.select(k, F.array_join("core", " ").alias("title"))
    found = fused(
        {
            "exact": exact_channel(a, b),
            "words": cosine_channel(a, b, word_grams, TOP["words"], least, folder),
            "characters": cosine_channel(a, b, character_grams, TOP["characters"], least, folder),
            "core": cosine_channel(core(a, "row_key"), core(b, "b_index"), word_grams, TOP["core"], least, folder),
        }
    )
    result = folder.result(found)
    folder.drop()
    return result
