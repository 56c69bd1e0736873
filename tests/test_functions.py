"""Scalar rules, by example."""

import pytest
from pyspark.sql import functions as F

from pairloom.functions import quantity as Q
from pairloom.functions import similarity as M
from pairloom.functions import text as T


def one(spark, f, *values):
    names = [f"c{i}" for i in range(len(values))]
    kinds = ", ".join(f"{n} {'string' if v is None or isinstance(v, str) else 'double' if isinstance(v, float) else 'array<string>' if all(isinstance(x, str) for x in v) else 'array<double>'}" for n, v in zip(names, values, strict=True))
    return spark.createDataFrame([tuple(values)], kinds).select(f(*[F.col(n) for n in names])).first()[0]


@pytest.mark.parametrize(("text", "want"), [("Mac &amp; Cheese™", "mac and cheesetm"), ("NaN", ""), (None, ""), ("½ × 2% Paté", "1 2 x 2% pat")])
def test_norm(spark, text, want):
    assert one(spark, T.norm, text) == want


def test_norm_text_strips_tags_and_dashes(spark):
    assert one(spark, T.norm_text, "<b>Gluten‑Free</b> O'Hara &lt;i&gt;x&lt;/i&gt;") == "gluten-free o'hara x"


def test_brand_and_tokens(spark):
    assert one(spark, T.norm_brand, "Dr. Pepper Company") == "dr pepper"
    assert one(spark, lambda a, b: T.core_tokens(a, b), "great value organic tomato sauce 12 oz", "great value") == ["organic", "sauce", "tomato"]
    assert one(spark, T.numeric_tokens, "2% milk 12 fl oz v912") == ["12floz", "2", "v912"]
    assert one(spark, T.id_text, "123.0") == "123"
    assert one(spark, T.bare, "O'Neil-Co 5") == "o neil co 5"


@pytest.mark.parametrize(("text", "want"), [('{"a": 1}', '{"a": 1}'), ("{'a': None, 'b': True}", '{"a": null, "b": true}'), ("", "{}"), ("nan", "{}"), ("{broken", "{}"), ("[1]", "[1]")])
def test_jsonish(spark, text, want):
    assert one(spark, T.jsonish, text) == want


@pytest.mark.parametrize(("text", "want"), [("2 x 80 Count", [2, 80, 160]), ("(2 pack) soap 4 Count", [2, 4, 8]), ("8 waffles", [8]), ("24/PK", [24]), ("plain", [])])
def test_count_values(spark, text, want):
    got = one(spark, Q.count_values, text)
    assert set(want) - {2} <= set(got) and all(x > 0 for x in got)


def test_pack_total_and_explicit(spark):
    assert one(spark, Q.pack_total, "4 pack of cans, 2/pack") == 8
    assert one(spark, Q.explicit_pack, "2 x - pack of 3 soap") == 6
    assert one(spark, Q.explicit_pack, "twin pack soap") == 2
    assert one(spark, Q.explicit_pack, "soap") is None


def test_quantities_and_totals(spark):
    got = one(spark, Q.quantities, "12 fl. oz bottle 2 lb 3 ct")
    assert [(r.dim, round(r.value, 3)) for r in got] == [("volume_ml", 354.882), ("mass_g", 907.185), ("count", 3.0)]
    assert one(spark, Q.total_quantity, "pack of 3 beans 16 oz", "").value == pytest.approx(48 * Q.OUNCE)
    assert one(spark, Q.total_quantity, "cheese 16 oz, 24 slices", "").value == pytest.approx(16 * Q.OUNCE)
    assert one(spark, Q.total_quantity, "bars 12 ct 2 oz", "") is None
    assert one(spark, Q.total_quantity, "bars 12 ct 2 oz", "24 oz").value == pytest.approx(24 * Q.OUNCE)


def test_amounts_skip_nutrition_and_overlaps():
    assert Q.amounts_of("shake 50g protein 11 fl oz") == {"mass": [], "volume": [11 * Q.FLUID_OUNCE], "dimension": []}
    assert Q.amounts_of("treats for 40+ lb dogs")["mass"] == []
    assert Q.amounts_of("1 1/2 lb")["mass"] == [1.5 * Q.POUND]


def test_dimensions_and_models(spark):
    assert one(spark, Q.dimensions, "frame 8 x 10 in") == [203.2, 254.0]
    assert one(spark, Q.model_ids, "vtech v912 500mg") == ["v912"]
    assert one(spark, Q.model_compatible, "v912", "v912-usv5") is True


def test_conflicts(spark):
    assert one(spark, lambda a, b: Q.pack_conflict(a, b, T.bare(a), T.bare(b)), "wipes pack of 6", "wipes pack of 12") is True
    assert one(spark, lambda a, b: Q.pack_conflict(a, b, T.bare(a), T.bare(b)), "2 x 80 count", "160 count") is False
    sizes = spark.createDataFrame([("16 oz", "1 lb"), ("16 oz", "2 lb"), ("16 oz", "12 fl oz")], "a string, b string").select(Q.amounts("a").alias("a"), Q.amounts("b").alias("b"))
    assert [r[0] for r in sizes.select(Q.size_conflict(F.col("a"), F.col("b"))).collect()] == [False, True, False]
    assert one(spark, Q.one_sided_count, "6 count", "soap") is True


def test_similarity(spark):
    assert one(spark, M.token_sim, ["a", "b"], ["a", "b", "c", "d"]) == pytest.approx(0.92)
    assert one(spark, M.token_sim, ["a"], ["b"]) == 0
    assert [one(spark, M.numeric_sim, 100.0, x) for x in (100.2, 102.0, 109.0, 130.0)] == [1.0, 0.9, 0.45, 0.0]
    assert one(spark, M.numeric_sim, 100.0, 100.0) == one(spark, M.numeric_sim, 0.0, 0.0) == 1.0
    assert one(spark, M.related_brands, ["wish", "bone", "inc"], ["wish", "bone"]) is True
    assert one(spark, M.sigmoid, -800.0) == pytest.approx(0)
