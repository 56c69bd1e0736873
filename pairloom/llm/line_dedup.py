"""Boilerplate lines by distinct-site spread, with DataFrame functions only.

One aggregation by line key merges two HyperLogLog sketches, of the sites and of the whole texts that hold the line.
Counting texts keeps a page that was copied whole to many sites from looking like boilerplate.
Lines whose estimate lies near a threshold are counted exactly; only they are shuffled by (line, site).
A boilerplate line stays at its first place (smallest id, then position) and goes everywhere else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import counted, written

MIN_SITES = 10
MIN_TEXTS = 20
#: log2 of the sketch's registers: a relative standard error of 1.6 %.
LG_K = 12
#: An estimate this far from the threshold, relatively and in sites, decides by itself (4 standard errors).
NEAR = 0.065
NEAR_SITES = 2


def _key(line: Column) -> list[Column]:
    """128 bits of the line without spaces at its ends."""
    line = F.btrim(line, F.lit(" \t\r"))
    return [F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2")]


def _lines(df: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    whole = F.xxhash64(text_col).alias("whole")
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(site_col).cast("string"), F.lit("")).alias("site"), whole, F.posexplode(F.split(text_col, "\n")).alias("pos", "line"))
    return rows.where(F.btrim("line", F.lit(" \t\r")) != "").select("id", "site", "whole", "pos", *_key(F.col("line")))


def boilerplate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", min_sites: int = MIN_SITES, min_texts: int = MIN_TEXTS) -> DataFrame:
    """(h1, h2, first): keys of lines on at least min_sites distinct sites and in min_texts distinct texts, and their first place."""
    lines = _lines(df, id_col, text_col, site_col)
    spread = lines.groupBy("h1", "h2").agg(
        F.count("*").alias("n"),
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_K))).alias("sites"),
        F.hll_sketch_estimate(F.hll_sketch_agg("whole", F.lit(LG_K))).alias("texts"),
        F.min(F.struct("id", "pos")).alias("first"),
    )

    def low(n: int) -> float:
        return min(n * (1 - NEAR), n - NEAR_SITES)

    def high(n: int) -> float:
        return max(n * (1 + NEAR), n + NEAR_SITES)

    able = (F.col("n") >= max(min_sites, min_texts)) & (F.col("sites") > low(min_sites)) & (F.col("texts") > low(min_texts))
    able = written(spread.where(able))
    sure = (F.col("sites") >= high(min_sites)) & (F.col("texts") >= high(min_texts))
    near = able.where(~sure).select("h1", "h2", "first")
    exact = lines.join(counted(near.select("h1", "h2")), ["h1", "h2"], "left_semi").groupBy("h1", "h2").agg(F.countDistinct("site").alias("sites"), F.countDistinct("whole").alias("texts"))
    exact = exact.where((F.col("sites") >= min_sites) & (F.col("texts") >= min_texts))
    return counted(written(able.where(sure).select("h1", "h2", "first").union(near.join(exact.select("h1", "h2"), ["h1", "h2"]))))


def drop_boilerplate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", min_sites: int = MIN_SITES, min_texts: int = MIN_TEXTS) -> DataFrame:
    """df's columns with boilerplate lines gone from the text, and n_lines, n_dropped (longs).

    Every row stays; a null text stays null with no lines; a text of boilerplate only becomes empty.
    A null site is a site of its own.  Rows with a null id take part like any other, and rows with equal ids and texts are treated alike.
    Columns of df named n_lines or n_dropped are replaced.
    """
    bad = boilerplate(df, id_col, text_col, site_col, min_sites, min_texts)
    hits = _lines(df, id_col, text_col, site_col).join(bad, ["h1", "h2"]).where(~F.struct("id", "pos").eqNullSafe(F.col("first")))
    hits = hits.groupBy("id", "whole").agg(F.collect_set("pos").alias("__gone"))
    hits = hits.select(F.col("id").alias("__id"), F.col("whole").alias("__whole"), "__gone")
    same = df[id_col].eqNullSafe(F.col("__id")) & (F.xxhash64(text_col) == F.col("__whole"))
    out = df.join(hits, same, "left")
    kept = F.array_join(F.filter(F.split(text_col, "\n"), lambda x, i: ~F.array_contains("__gone", i)), "\n")
    n = F.coalesce(F.when(F.col(text_col) == "", 0).otherwise(F.size(F.split(text_col, "\n"))), F.lit(0)).cast("long")
    extra = {"n_lines": n, "n_dropped": F.coalesce(F.size("__gone"), F.lit(0)).cast("long")}
    rest = [F.when(F.col("__gone").isNull(), F.col(text_col)).otherwise(kept).alias(text_col) if c == text_col else F.col(c) for c in df.columns if c.lower() not in extra]
    return out.select(*rest, *[v.alias(k) for k, v in extra.items()])
