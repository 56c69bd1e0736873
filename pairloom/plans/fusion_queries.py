"""Queries over the cosine channels and their fusion, with SQL that measures every pair."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import blocking, fusion
from ..sources.catalog import part_catalogs


def _features(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    a, b = part_catalogs(spark, sf_dir)
    return blocking.features(a, "row_key", False), blocking.features(b, "b_index", False)


def character_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest titles by runs of characters."""
    return fusion.cosine_channel(*_features(spark, sf_dir), fusion.character_grams, fusion.TOP["characters"])


def fused_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of four channels, fused by their ranks."""
    return fusion.candidates(*_features(spark, sf_dir))


QUERIES = {f.__name__: f for f in (character_neighbours, fused_candidates)}
_WORDS = "list_filter(string_split(title, ' '), lambda w: w <> '')"
_CHARACTERS = f"flatten(list_transform({_WORDS}, lambda w: flatten(list_transform([3, 4, 5], lambda n: list_transform(range(1, length(w) + 4 - n), lambda i: substring(' ' || w || ' ', i, n))))))"
_GRAMS = f"list_concat({_WORDS}, list_transform(range(1, len({_WORDS})), lambda i: ({_WORDS})[i] || ' ' || ({_WORDS})[i + 1]))"


def _channel(name: str, title: str, grams: str, top: int) -> str:
    """Common tables that end in one of this name: row_key, b_index, cosine, rank."""
    return f""", {name}_t AS (SELECT k, side, {title} AS title FROM feat),
    {name}_g AS (SELECT k, side, gram, count(*) AS tf FROM (SELECT k, side, unnest({grams}) AS gram FROM {name}_t) GROUP BY ALL),
    {name}_i AS (SELECT gram, ln(((SELECT count(*) FROM b) + 1) / (count(*) + 1)) + 1 AS idf FROM {name}_g WHERE side = 1 GROUP BY 1 HAVING count(*) >= 2),
    {name}_w AS (SELECT k, side, gram, (1 + ln(tf)) * idf AS w FROM {name}_g JOIN {name}_i USING (gram)),
    {name}_v AS (SELECT k, side, gram, w / sqrt(sum(w * w) OVER (PARTITION BY k, side)) AS w FROM {name}_w),
    {name}_p AS (SELECT x.k AS row_key, y.k AS b_index, round(sum(x.w * y.w), 9) AS cosine FROM {name}_v x JOIN {name}_v y USING (gram) WHERE x.side = 0 AND y.side = 1 GROUP BY 1, 2),
    {name} AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY row_key ORDER BY cosine DESC, b_index) AS INTEGER) AS rank FROM {name}_p WHERE cosine >= {fusion.LEAST}::DOUBLE) WHERE rank <= {top})"""


def oracles(part: str) -> dict[str, str]:
    """The SQL of both queries after the common tables of the part catalogs."""
    near = part + _channel("characters", "title", _CHARACTERS, fusion.TOP["characters"])
    more = _channel("words", "title", _GRAMS, fusion.TOP["words"]) + _channel("core", "array_to_string(core, ' ')", _GRAMS, fusion.TOP["core"])
    union = " UNION ALL ".join(f"SELECT row_key, b_index, rank, '{c}' AS channel, {w}::DOUBLE AS weight FROM {c}" for c, w in fusion.WEIGHTS.items())
    return {
        "character_neighbours": near + " SELECT row_key, b_index, cosine, rank FROM characters",
        "fused_candidates": near
        + more
        + f""", exact AS (SELECT * FROM (SELECT a.k AS row_key, b.k AS b_index, row_number() OVER (PARTITION BY a.k ORDER BY b.k) AS rank FROM a JOIN b USING (title) WHERE title <> '') WHERE rank <= {fusion.TOP["exact"]}),
    s AS (SELECT row_key, b_index, sum(CAST(round(weight / ({fusion.RANK_CONSTANT} + rank) * 1e12) AS BIGINT)) AS s, count(*) AS channels, bool_or(channel = 'exact') AS protected FROM ({union}) GROUP BY 1, 2),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY row_key ORDER BY s DESC, b_index) AS INTEGER) AS rank FROM s)
    SELECT row_key, b_index, CAST(s AS DOUBLE) / 1e12 AS score, channels, protected, rank FROM (SELECT *, row_number() OVER (PARTITION BY row_key ORDER BY s DESC, b_index) AS n FROM r WHERE rank <= {fusion.KEPT} OR protected) WHERE n <= {fusion.KEPT_WITH_PROTECTED}""",
    }
