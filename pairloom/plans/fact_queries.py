"""Queries over facts of made-up products, each with its SQL.

A part's key picks a form of title and its size a number in it, so the SQL knows each fact without reading the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import similarity as M
from ..operators import facts
from ..sources.catalog import parts

#: Title, description, and the facts that they state: attribute to (value in SQL, quality).  n is the number.
_FORMS = [
    ("Boneless skinless chicken breasts ~ oz", "", {"bone_state": ("'boneless'", 0.98), "skin_state": ("'skinless'", 0.98), "meat_species": ("'chicken'", 0.94), "meat_cut": ("'breast'", 0.94), "net_weight": ("n * 28.349523125::DOUBLE", 0.94)}),
    ("Ground beef ~% lean", "", {"grind_type": ("'ground'", 0.95), "meat_species": ("'beef'", 0.94), "ground_meat_lean_fat_ratio": ("CAST(n AS DOUBLE) || ',' || CAST(100 - n AS DOUBLE)", 0.99)}),
    ("LED bulb ~w 800 lm 2700k e26 a19", "", {"wattage": ("CAST(n AS DOUBLE)", 0.96), "light_output_lumens": ("800::DOUBLE", 0.99), "light_color_temperature": ("2700::DOUBLE", 0.99), "light_bulb_base": ("'e26'", 0.98), "light_bulb_shape": ("'a19'", 0.98)}),
    ("Sunscreen lotion SPF ~", "", {"spf": ("CAST(n AS DOUBLE)", 0.99), "physical_state": ("'lotion'", 0.94)}),
    ("Mascara Soft  Brown waterproof, black", "", {"shade": ("'black'", 0.96), "waterproof_status": ("'waterproof'", 0.94)}),
    ("Eyebrow pencil ~ Soft  Brown", "", {"shade": ("'soft brown'", 0.96)}),
    ("Pinot noir wine 2019 750 ml 13.5% abv", "", {"wine_varietal": ("'pinot noir'", 0.95), "vintage": ("2019::DOUBLE", 0.92), "alcohol_strength_abv": ("13.5::DOUBLE", 0.99), "net_volume": ("750::DOUBLE", 0.94)}),
    ("Flash drive ~ gb usb-c", "", {"storage_capacity": ("n * 1024::DOUBLE", 0.98), "connector_type": ("'usb-c'", 0.95)}),
    ("Large grade A eggs ~ count", "", {"egg_size_grade": ("'grade a,large'", 0.92), "declared_count": ("CAST(n AS DOUBLE)", 0.96)}),
    ("Large grade A plums", "", {}),
    ("Toilet paper 3-ply", "", {"paper_ply": ("3::DOUBLE", 0.99)}),
    ("Detergent refill ~ loads", "", {"rated_use_count": ("CAST(n AS DOUBLE)", 0.98), "refill_vs_starter_kit": ("'refill'", 0.95)}),
    ("Infant formula milk based stage 2", "", {"formula_base": ("'milk based'", 0.90), "baby_stage": ("'2'", 0.88)}),
    ("Apple drink ~% juice", "", {"juice_percentage": ("CAST(n AS DOUBLE)", 0.98), "flavor": ("'apple'", 0.94), "produce_species": ("'apple'", 0.94)}),
    ("Aspirin tablets", "Active ingredient - aspirin ~ mg Purpose none", {"active_ingredient": ("'aspirin ' || n || ' mg'", 0.96), "active_strength": ("CAST(n AS DOUBLE)", 0.95), "dosage_form": ("'tablets'", 0.94), "ingredient_signature": ("'aspirin,none,purpose'", 0.82)}),
    ("Wafers", "Ingredients - sugar, cocoa butter, sugar. Contains milk", {"ingredient_signature": ("'butter,cocoa,sugar'", 0.82)}),
    ("Stainless steel women bottle christmas", "", {"durable_material": ("'stainless steel,steel'", 0.80), "target_audience": ("'women'", 0.78), "occasion_or_holiday": ("'christmas'", 0.92), "packaging_form": ("'bottle'", 0.82)}),
]
_ASKED = sorted({a for *_, stated in _FORMS for a in stated})
_VALUES = ", ".join(f"({i}, '{t}', '{d}')" for i, (t, d, _) in enumerate(_FORMS))
_MADE = f"SELECT p_partkey AS row_key, p_size % 40 + 11 AS n, f.i AS form, f.t, f.d FROM {{part}} JOIN (VALUES {_VALUES}) AS f(i, t, d) ON p_partkey % {len(_FORMS)} = f.i"
_PAIRED = "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN -1 WHEN 1 THEN 0 ELSE p_size / CAST(50 AS DOUBLE) END AS q FROM {part}"


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = parts(spark, sf_dir)
    made = spark.sql(_MADE, part=part)
    filled = lambda c: F.replace(c, F.lit("~"), F.col("n").cast("string"))
    blank = [F.lit("").alias(c) for c in ("brand_raw", "item_info", "sizing_comp", "tags")]
    return made.select("row_key", filled("t").alias("name"), filled("d").alias("description"), *blank)


def _shown(found: DataFrame) -> DataFrame:
    listed = F.array_join(F.transform("nums", lambda x: x.cast("string")), ",")
    return found.select("row_key", "attr", F.coalesce("txt", F.array_join("toks", ","), listed, F.round("num", 6).cast("string")).alias("value"), F.round("quality", 4).alias("quality"))


def stated_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What made-up titles and descriptions state, of the attributes that some of them state."""
    return _shown(facts.extract(_products(spark, sf_dir), "row_key", unicode=False).where(F.col("attr").isin(*_ASKED)))


def overlaid_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of a sun lotion, beside what an enrichment adds: a new attribute, a known one, an unsure one, an empty one."""
    p = parts(spark, sf_dir).select(F.col("p_partkey").alias("row_key"), F.lit("Lotion SPF 30").alias("name"), *[F.lit("").alias(c) for c in ("description", "brand_raw", "item_info", "sizing_comp", "tags")], (F.col("p_size") / 50).alias("sure"))
    entry = lambda v: F.struct(F.lit(v).alias("value"), F.col("sure").alias("confidence"))
    told = F.to_json(F.struct(entry("Aloe").alias("base_ingredient"), entry("99").alias("spf"), entry('["Adult", "Kids"]').alias("target_age_range"), entry("").alias("skin_type")))
    p = p.withColumn("enrichment_json", told)
    return _shown(facts.overlaid(facts.extract(p, "row_key", unicode=False), p, "row_key").where(F.col("attr").isin("base_ingredient", "spf", "target_age_range", "skin_type")))


def quantity_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = spark.sql(_PAIRED, part=parts(spark, sf_dir))
    return p.select("p_partkey", M.quantity_relation(F.col("q")).alias("relation"))


_STATED = " UNION ALL ".join(f"SELECT row_key, '{attr}' AS attr, CAST({value if "'" in value or '||' in value else f'round({value}, 6)'} AS VARCHAR) AS value, {quality}::DOUBLE AS quality FROM m WHERE form = {i}" for i, (*_, stated) in enumerate(_FORMS) for attr, (value, quality) in stated.items())
QUERIES = {f.__name__: f for f in (stated_facts, overlaid_facts, quantity_relations)}
ORACLES = {
    "stated_facts": f"WITH m AS ({_MADE.format(part='part')}) {_STATED}",
    "overlaid_facts": """WITH p AS (SELECT p_partkey AS row_key, p_size / 50::DOUBLE AS sure FROM part)
    SELECT row_key, 'spf' AS attr, '30.0' AS value, 0.99::DOUBLE AS quality FROM p
    UNION ALL SELECT row_key, 'base_ingredient', 'aloe', round(least(sure, 0.9::DOUBLE), 4) FROM p WHERE sure >= 0.75
    UNION ALL SELECT row_key, 'target_age_range', 'adult,kids', round(least(sure, 0.9::DOUBLE), 4) FROM p WHERE sure >= 0.75""",
    "quantity_relations": f"SELECT p_partkey, CASE WHEN q <= 0 THEN 'UNKNOWN' WHEN q >= 0.72 THEN 'COMPATIBLE' ELSE 'CONFLICT' END AS relation FROM ({_PAIRED.format(part='part')})",
}
