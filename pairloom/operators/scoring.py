"""Evidence for and against a pair, scored apart over joined facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import similarity as M
from ..functions import text as T

# Fixed values.
QUANTITY_ATTRS = (
    "net_weight", "net_volume", "declared_count", "pack_structure", "active_strength", "spf", "alcohol_strength_abv", "juice_percentage",
    "electrical_voltage", "wattage", "storage_capacity", "paper_ply", "rated_use_count", "light_output_lumens", "light_color_temperature",
)
HIGH_THRESHOLD = [a for a in QUANTITY_ATTRS if a != "juice_percentage"] + ["normalized_total_quantity", "dimension_signature"]
MATCH_CLUSTERS = {
    "net_quantity": "net_weight net_volume normalized_total_quantity", "pack_count": "declared_count pack_structure component_piece_count", "broad_product_family": "product_family canonical_category",
    "functional_identity": "functional_name canonical_subcategory", "brand_identity": "brand sub_brand product_line", "state_form": "storage_state physical_state preparation_state",
    "flavor_variant": "flavor variant_name", "scent_variant": "scent", "medicine_identity": "active_ingredient active_strength dosage_form route_of_administration release_type",
    "bulb_identity": "light_bulb_base light_bulb_shape light_output_lumens light_color_temperature light_watt_equivalent",
}
CONFLICT_CLUSTERS = {k: v for k, v in MATCH_CLUSTERS.items() if k not in ("pack_count", "brand_identity", "scent_variant", "bulb_identity")}
IDENTITY = (
    "brand", "functional_name", "product_family", "model_or_part_identifier", "canonical_category", "canonical_subcategory",
)
DIET = (
    "organic_status", "gluten_status", "sugar_status", "sodium_status", "fat_level", "lactose_status", "vegan_vegetarian_status", "non_gmo_status",
)
NEVER_VETO = (
    "canonical_category", "product_family", "functional_name", "canonical_subcategory", "model_or_part_identifier",
)
VETO = {
    "canonical_category": "V001", "brand": "V002", "functional_name": "V004", "product_family": "V005", "model_or_part_identifier": "V006", "variant_name": "V007", "normalized_total_quantity": "V008",
    "declared_count": "V008", "pack_structure": "V009", "refill_vs_starter_kit": "V010", "storage_state": "V011", "physical_state": "V012", "flavor": "V013", "scent": "V013", "protein_source": "V066",
    "produce_species": "V015", "produce_form": "V016", "meat_species": "V017", "meat_cut": "V017", "grind_type": "V018", "bone_state": "V018", "skin_state": "V018", "ground_meat_lean_fat_ratio": "V019",
    "seafood_species": "V020", "egg_size_grade": "V021", "egg_production_method": "V022", "beverage_type": "V023", "water_source_treatment_type": "V024", "carbonation_status": "V025",
    "caffeine_status": "V026", "juice_percentage": "V027", "milk_type": "V028", "fat_level": "V028", "cheese_type": "V029", "alcohol_class": "V030", "wine_varietal": "V031",
    "alcohol_strength_abv": "V032", "vintage": "V033", "origin_region_appellation": "V033", "active_ingredient": "V034", "active_strength": "V035", "dosage_form": "V036", "coffee_format": "V067",
    "route_of_administration": "V037", "release_type": "V038", "spf": "V039", "shade": "V040", "finish": "V041", "hair_type": "V042", "skin_type": "V042", "absorbency": "V043", "bristle_firmness": "V044",
    "baby_stage": "V045", "formula_base": "V046", "diaper_size": "V047", "pet_species": "V048", "pet_life_stage": "V049", "pet_litter_clumping_status": "V050", "footwear_size_compatibility": "V051",
    "paper_ply": "V052", "rated_use_count": "V053", "dimension_signature": "V054", "electrical_voltage": "V055", "light_bulb_base": "V056", "light_bulb_shape": "V057", "light_output_lumens": "V058",
    "light_color_temperature": "V058", "light_watt_equivalent": "V058", "connector_type": "V059", "battery_spec": "V060", "storage_capacity": "V061", "theme_or_franchise": "V062",
    "occasion_or_holiday": "V063",
}
ASYMMETRIC = (
    "flavor", "scent", "shade", "waterproof_status", "washable_longwear_status", "meat_species", "meat_cut", "produce_species", "protein_source",
    "sugar_status", "caffeine_status", "coffee_format", "dosage_form", "release_type", "spf", "pet_species", "pet_life_stage", "formula_base",
    "diaper_size", "absorbency", "refill_vs_starter_kit", "product_line", "light_bulb_base", "light_bulb_shape", "model_or_part_identifier",
    "bundle_flag", "assortment_flag",
)
GROUPS = {
    "identity": "brand brand_type sub_brand product_line functional_name product_family model_or_part_identifier variant_name usage_function target_surface_or_body_area compatibility",
    "quantity_packaging": "net_weight net_volume declared_count pack_structure normalized_total_quantity piece_weight variable_weight_flag billed_by_weight ordered_by_weight bundle_flag assortment_flag packaging_form refill_vs_starter_kit capacity rated_use_count dimension_signature closure_style",
    "form_variant": "flavor scent color shade texture style_or_cut shape physical_state storage_state preparation_state concentrate_status spice_heat_level coating_breading filled_stuffed_status smoked_cured_status",
    "food_composition": "base_ingredient protein_source meat_species meat_cut grind_type bone_state skin_state seafood_species produce_species produce_variety produce_form ripeness_or_maturity organic_status gluten_status sugar_status sodium_status fat_level lactose_status vegan_vegetarian_status kosher_halal_status ingredient_signature allergen_signature sweetener_type fortification caffeine_status carbonation_status juice_percentage milk_type cheese_type cheese_aging beverage_type coffee_roast coffee_format tea_type alcohol_class alcohol_style alcohol_strength_abv vintage origin_region_appellation non_gmo_status",
    "health_personal_care": "active_ingredient active_strength dosage_form route_of_administration release_type symptom_or_indication medicated_status spf absorbency device_type finish coverage_level hold_level hair_type skin_type care_concern applicator_type waterproof_status washable_longwear_status disposable_reusable_status",
    "baby_pet": "baby_stage diaper_size feeding_stage nipple_flow formula_base pet_species pet_life_stage pet_size_or_breed pet_food_texture pet_diet_function",
    "durable_apparel": "footwear_size_compatibility target_age_range target_audience durable_material electrical_voltage wattage connector_type battery_spec storage_capacity theme_or_franchise component_piece_count",
    "routing": "canonical_category canonical_subcategory",
    "variant": "occasion_or_holiday",
    "alcohol": "wine_varietal",
    "food": "ground_meat_lean_fat_ratio egg_size_grade egg_production_method",
    "household": "paper_ply",
    "household_tech": "light_bulb_base light_bulb_shape light_output_lumens light_color_temperature light_watt_equivalent",
    "personal_care": "bristle_firmness",
    "pet": "pet_litter_clumping_status",
    "beverage": "water_source_treatment_type",
}
#: Families that a group of attributes applies to; groups that aren't named here always apply.
_EDIBLE, _CARE, _HOME = ("food", "beverage", "alcohol"), ("medicine", "beauty_personal"), ("household_tech", "household")
APPLIES = {
    **dict.fromkeys(("food_composition", "food", "alcohol", "beverage"), _EDIBLE), **dict.fromkeys(("health_personal_care", "personal_care"), _CARE), **dict.fromkeys(("baby_pet", "pet"), ("baby", "pet")),
    "durable_apparel": (*_HOME, "apparel"), **dict.fromkeys(("household", "household_tech"), _HOME),
}


def criteria() -> list[tuple[str, str, float]]:
    """(attribute, group, weight): 7 for an attribute that can veto, 3.5 for other identity and quantity ones, 1.5 for routing and flags, else 2.

    score_pairs takes others, such as those of sources.config.read_criteria.
    """
    out = []
    for group, names in GROUPS.items():
        for n in names.split():
            flag = group == "routing" or n in ("brand_type", "billed_by_weight", "ordered_by_weight", "variable_weight_flag")
            out.append((n, group, 1.5 if flag else 7.0 if n in VETO and n not in NEVER_VETO else 3.5 if group in ("identity", "quantity_packaging") else 2.0))
    return out


def _pick(attr: Column, table: dict, default: Column) -> Column:
    for value, names in table.items():
        default = F.when(attr.isin(*names.split()), value).otherwise(default)
    return default


def value_similarity(attr: Column, a: str = "a", b: str = "b") -> Column:
    """Of two facts, struct columns a and b of one attribute."""
    x, y = F.col(a), F.col(b)
    sides = F.aggregate(F.zip_with(x["nums"], y["nums"], lambda p, q: M.numeric_sim(p, q, 0.02)), F.lit(0.0), lambda s, v: s + v) / F.size(x["nums"])
    return (
        F.when(attr == "normalized_total_quantity", F.when(x["dim"] == y["dim"], M.numeric_sim(x["num"], y["num"])).otherwise(0.0))
        .when(x["num"].isNotNull() & y["num"].isNotNull(), F.when(attr.isin(*QUANTITY_ATTRS, "piece_weight"), M.numeric_sim(x["num"], y["num"])).otherwise((x["num"] == y["num"]).cast("double")))
        .when(attr == "ground_meat_lean_fat_ratio", (x["nums"] == y["nums"]).cast("double"))
        .when(x["nums"].isNotNull() & y["nums"].isNotNull(), F.when(F.size(x["nums"]) == F.size(y["nums"]), sides).otherwise(0.0))
        .when(x["flag"].isNotNull() | y["flag"].isNotNull(), F.coalesce(x["flag"] == y["flag"], F.lit(False)).cast("double"))
        .when(x["toks"].isNotNull() & y["toks"].isNotNull(), M.token_sim(x["toks"], y["toks"]))
        .when(x["txt"] == y["txt"], 1.0)
        .otherwise(M.token_sim(T.joined_words(F.coalesce(x["txt"], F.lit(""))), T.joined_words(F.coalesce(y["txt"], F.lit("")))))
    )


def conflict_severity(attr: Column, sim: Column, a: str = "a", b: str = "b") -> Column:
    """Severity of a contradiction, or null where there is none."""
    x, y = F.col(a), F.col(b)
    edible = ("food", "beverage", "alcohol")
    return (
        F.when(attr == "normalized_total_quantity", F.when((x["dim"] == y["dim"]) & (sim < 0.45), 1 - sim))
        .when(attr.isin(*QUANTITY_ATTRS), F.when(sim < 0.45, 1 - sim))
        .when(attr == "dimension_signature", F.when(sim < 0.50, 1 - sim))
        .when(attr == "functional_name", F.when(sim < 0.18, 1 - sim))
        .when(attr.isin("product_family", "canonical_category"), F.when((x["txt"] != y["txt"]) & ~(x["txt"].isin(*edible) & y["txt"].isin(*edible)), 0.65))
        .when(x["toks"].isNotNull() & y["toks"].isNotNull(), F.when(~F.arrays_overlap(x["toks"], y["toks"]), 1.0))
        .when(x["nums"].isNotNull(), F.when(x["nums"] != y["nums"], 1.0))
        .when(x["flag"].isNotNull(), F.when(x["flag"] != y["flag"], 1.0))
        .when(x["num"].isNotNull(), F.when(x["num"] != y["num"], 1.0))
        .otherwise(F.when(x["txt"] != y["txt"], 1.0))
    )


def interactions(atoms: Column, factor: float, strength: str) -> Column:
    """Sum over unordered pairs of atoms of factor * sqrt(w w') min(strength) min(quality), where it reaches factor."""
    def one(x: Column, y: Column) -> Column:
        v = factor * F.sqrt(x["weight"] * y["weight"]) * F.least(x[strength], y[strength]) * F.least(x["quality"], y["quality"])
        return F.when(v >= factor, v).otherwise(0.0)

    rows = F.transform(atoms, lambda x, i: F.aggregate(F.slice(atoms, i + 2, F.size(atoms)), F.lit(0.0), lambda s, y: s + one(x, y)))
    return F.aggregate(rows, F.lit(0.0), lambda s, v: s + v)


def _grouped(facts: DataFrame, key: str, name: str) -> DataFrame:
    fields = [c for c in facts.columns if c not in (key, "attr")]
    return facts.select(key, "attr", F.struct(*fields).alias(name))


def score_pairs(pairs: DataFrame, facts_a: DataFrame, facts_b: DataFrame, weights: list[tuple[str, str, float]] | None = None) -> DataFrame:
    """pairs (row_key, b_index, ...) with the scores, counts, veto rules and asymmetries of each.  weights: as of criteria(), the default."""
    spark = pairs.sparkSession
    dims = F.broadcast(spark.createDataFrame(weights or criteria(), "attr string, grp string, weight double"))  # a fixed table
    key = ["row_key", "b_index"]
    own = pairs.select(*key)
    left = own.join(_grouped(facts_a, "row_key", "a"), "row_key")
    right = own.join(_grouped(facts_b, "b_index", "b"), "b_index")
    both = left.join(right, [*key, "attr"], "full_outer")
    seen = lambda side, attr: F.max(F.when(F.col("attr") == attr, F.col(side)))
    wanted = ("brand", "brand_type", "product_family", "functional_name", "model_or_part_identifier", "normalized_total_quantity", "pack_structure", "declared_count", "organic_status", "washable_longwear_status", "waterproof_status", "flavor")
    wide = both.groupBy(*key).agg(
        *[seen(s, n)[f].alias(f"{s}_{n}_{f}") for s in "ab" for n, f in _needed(wanted)],
        F.array_sort(F.collect_set(F.when((F.col("a").isNull() != F.col("b").isNull()) & F.col("attr").isin(*ASYMMETRIC), F.col("attr")))).alias("asymmetries"),
    )
    joined = both.where("a is not null and b is not null").join(dims, "attr").join(wide.select(*key, "a_functional_name_toks", "b_functional_name_toks", "a_product_family_txt", "b_product_family_txt", "a_brand_type_txt", "b_brand_type_txt", "a_normalized_total_quantity_num", "b_normalized_total_quantity_num"), key)
    fits = F.lit(True)
    for group, families in APPLIES.items():
        fits = F.when(F.col("grp") == group, F.coalesce(F.col("a_product_family_txt").isin(*families), F.lit(False)) | F.coalesce(F.col("b_product_family_txt").isin(*families), F.lit(False))).otherwise(fits)
    attr = F.col("attr")
    joined = joined.where(fits).withColumn("sim", value_similarity(attr)).withColumn("q", F.sqrt(F.col("a")["quality"] * F.col("b")["quality"]))
    threshold = F.when(attr.isin("functional_name", "ingredient_signature"), 0.35).when(attr == "model_or_part_identifier", 0.55).when(attr == "canonical_subcategory", 0.45).when(attr.isin(*HIGH_THRESHOLD), 0.88).otherwise(0.70)
    capped = F.when(attr.isin("brand_type", "product_family", "canonical_category"), F.least("weight", F.lit(1.5))).when(attr.isin("billed_by_weight", "ordered_by_weight", "variable_weight_flag"), F.least("weight", F.lit(0.5))).otherwise(F.col("weight"))
    capped = F.when(F.col("grp") == "routing", F.least(capped, F.lit(1.0))).otherwise(capped)
    two_false = F.coalesce(~F.col("a")["flag"] & ~F.col("b")["flag"], F.lit(False))
    strength = M.clamp((F.col("sim") - threshold) / (1 - threshold), 0.20)
    atom = lambda w, s, c: F.struct(c.alias("contribution"), attr.alias("attr"), F.col("grp").alias("grp"), w.alias("weight"), F.col("q").alias("quality"), s.alias("s"))
    good = joined.where((F.col("sim") >= threshold) & ~two_false)
    good = good.groupBy(*key, _pick(attr, MATCH_CLUSTERS, attr).alias("cluster")).agg(F.max(atom(capped, F.col("sim"), capped * F.col("q") * strength)).alias("e"))
    good = good.groupBy(*key).agg(F.array_sort(F.collect_list("e")).alias("good"))
    private = F.coalesce((F.col("a_brand_type_txt") == "private_label") & (F.col("b_brand_type_txt") == "private_label"), F.lit(False))
    national = F.coalesce((F.col("a_brand_type_txt") == "national_or_manufacturer") & (F.col("b_brand_type_txt") == "national_or_manufacturer"), F.lit(False))
    totals = F.col("a_normalized_total_quantity_num").isNotNull() & F.col("b_normalized_total_quantity_num").isNotNull()
    titled = (F.col("a")["source"] == "title_family_rules") & (F.col("b")["source"] == "title_family_rules")
    # Families that differ say nothing about products whose functional names agree.
    same_use = F.coalesce(M.token_sim(F.col("a_functional_name_toks"), F.col("b_functional_name_toks")) >= 0.45, F.lit(False))
    skip = (attr == "canonical_subcategory") | (attr.isin("net_weight", "net_volume") & totals) | (attr.isin("product_family", "canonical_category") & (~titled | same_use)) | ((attr == "brand") & private)
    bad = joined.where(~skip).withColumn("severity", conflict_severity(attr, F.col("sim"))).where((F.col("severity").isNotNull()) & (F.col("q") >= 0.72))
    veto_map = F.create_map(*[F.lit(x) for kv in VETO.items() for x in kv])
    vetoes = (F.col("q") >= 0.84) & (F.col("severity") >= 0.55) & ~attr.isin(*NEVER_VETO, *DIET) & ((attr != "brand") | national)
    bad = bad.withColumn("veto", F.when(vetoes, F.try_element_at(veto_map, attr)))
    bad = bad.groupBy(*key, _pick(attr, CONFLICT_CLUSTERS, attr).alias("cluster")).agg(F.max(atom(F.col("weight"), F.col("severity"), F.col("weight") * F.col("q") * F.greatest(F.lit(0.25), "severity"))).alias("e"), F.collect_set("veto").alias("vetoes"))
    bad = bad.groupBy(*key).agg(F.array_sort(F.collect_list("e")).alias("bad"), F.flatten(F.collect_list("vetoes")).alias("vetoes"))
    out = pairs.join(wide, key, "left").join(good, key, "left").join(bad, key, "left")
    return _scores(out)


def _needed(names: tuple[str, ...]) -> list[tuple[str, str]]:
    fields = {"functional_name": ["toks"], "model_or_part_identifier": ["toks"], "normalized_total_quantity": ["num", "dim"], "pack_structure": ["num", "source"], "declared_count": ["num"], "organic_status": ["toks"], "washable_longwear_status": ["toks"], "waterproof_status": ["toks"], "flavor": ["toks"]}
    return [(n, f) for n in names for f in fields.get(n, ["txt"])]


def _scores(p: DataFrame) -> DataFrame:
    kind = "array<struct<contribution:double,attr:string,grp:string,weight:double,quality:double,s:double>>"
    none = F.array().cast(kind)
    p = p.withColumn("good", F.coalesce("good", none)).withColumn("bad", F.coalesce("bad", none))
    strings = F.array().cast("array<string>")
    c = F.col
    words = lambda side, n: F.coalesce(c(f"{side}_{n}_toks"), strings)
    wet = lambda x, y: F.array_contains(words(x, "washable_longwear_status"), "washable") & F.array_contains(words(y, "waterproof_status"), "waterproof") & ~F.array_contains(words(x, "waterproof_status"), "waterproof") & ~F.array_contains(words(y, "washable_longwear_status"), "washable")
    washable = wet("a", "b") | wet("b", "a")
    cross = lambda x, y: F.coalesce((c(x) > 1) & (c(y) > 1) & (F.abs(c(x) - c(y)) > 1e-9), F.lit(False))
    crossed = cross("a_pack_structure_num", "b_declared_count_num") | cross("a_declared_count_num", "b_pack_structure_num")
    special = lambda name, grp: F.struct(F.lit(6.58).alias("contribution"), F.lit(name).alias("attr"), F.lit(grp).alias("grp"), F.lit(7.0).alias("weight"), F.lit(0.94).alias("quality"), F.lit(1.0).alias("s"))
    extra = F.array_compact(F.array(F.when(washable, special("washable_vs_waterproof_variant", "health_personal_care")), F.when(crossed, special("cross_pack_count", "quantity_packaging"))))
    p = p.withColumn("bad", F.concat("bad", extra.cast(kind)))
    vetoes = F.array_compact(F.concat(F.coalesce("vetoes", strings), F.array(F.when(washable, "V065"), F.when(crossed, "V009"))))
    explicit = lambda s: F.coalesce((c(f"{s}_pack_structure_source") == "explicit_multipack") & (c(f"{s}_pack_structure_num") > 1), F.lit(False))
    fa, fb = words("a", "flavor"), words("b", "flavor")
    chocolate = F.array(*[F.lit(x) for x in ("chocolate", "milk chocolate", "dark chocolate", "white chocolate")])
    apart = F.array_union(F.array_except(fa, fb), F.array_except(fb, fa))
    partial = F.arrays_overlap(fa, fb) & (F.size(apart) > 0) & ~((F.size(F.array_except(apart, chocolate)) == 0) & F.arrays_overlap(fa, chocolate) & F.arrays_overlap(fb, chocolate))
    private = F.coalesce((c("a_brand_type_txt") == "private_label") & (c("b_brand_type_txt") == "private_label"), F.lit(False))
    national = F.coalesce((c("a_brand_type_txt") == "national_or_manufacturer") & (c("b_brand_type_txt") == "national_or_manufacturer"), F.lit(False))
    organic = private & (c("a_organic_status_toks").isNull() != c("b_organic_status_toks").isNull())
    asym = F.array_compact(F.concat(F.coalesce("asymmetries", strings), F.array(F.when(explicit("a") != explicit("b"), "explicit_multipack"), F.when(partial, "flavor_partial"), F.when(organic, "organic_status_private"))))
    mass = lambda atoms: F.aggregate(atoms, F.lit(0.0), lambda s, x: s + x["contribution"])
    groups = lambda atoms: F.size(F.array_distinct(F.transform(atoms, lambda x: x["grp"])))
    total = lambda atoms, f: mass(atoms) + F.least(interactions(atoms, f, "s"), 0.25 * mass(atoms))
    identity = F.size(F.filter("good", lambda x: x["attr"].isin(*IDENTITY)))
    strong = F.size(F.filter("good", lambda x: x["weight"] >= 3.5))
    fs = F.coalesce(M.token_sim(c("a_functional_name_toks"), c("b_functional_name_toks")), F.lit(0.0))
    ms = F.coalesce(M.token_sim(c("a_model_or_part_identifier_toks"), c("b_model_or_part_identifier_toks")), F.lit(0.0))
    p = p.select("*", fs.alias("fs"), ms.alias("ms"), total(c("good"), 0.06).alias("for"), total(c("bad"), 0.07).alias("against"))
    one = F.lit(1.0)
    gate = F.greatest(0.15 + 0.85 * M.clamp((c("fs") - 0.20) / 0.75), F.when(c("ms") >= 0.90, 0.95).otherwise(0.0))
    match = (1 - F.exp(-c("for") / 10)) * (0.45 + 0.20 * F.least(one, groups(c("good")) / 4) + 0.20 * F.least(one, identity / 2) + 0.15 * F.least(one, strong / 3)) * gate
    cap = F.when(c("ms") >= 0.90, 1.0).when(c("fs") < 0.45, 0.45).when(c("fs") < 0.65, 0.62).when(c("fs") < 0.75, 0.78).otherwise(1.0)
    against = (1 - F.exp(-c("against") / 8)) * (0.70 + 0.30 * F.least(one, groups(c("bad")) / 3))
    rules = F.array_sort(F.array_distinct(vetoes))
    against = F.when(F.size(rules) > 0, F.greatest(against, F.lit(0.88))).otherwise(against)
    related = M.related_brands(F.split(T.bare(c("a_brand_txt")), " "), F.split(T.bare(c("b_brand_txt")), " "))
    padded = lambda x: F.concat(F.lit(" "), T.bare(x), F.lit(" "))
    inferred = F.coalesce(padded(c("name_B")).contains(padded(c("a_brand_txt"))) & c("a_brand_txt").isNotNull(), F.lit(False)) | F.coalesce(padded(c("name_A")).contains(padded(c("b_brand_txt"))) & c("b_brand_txt").isNotNull(), F.lit(False))
    known = c("a_brand_txt").isNotNull() & c("b_brand_txt").isNotNull()
    shared = F.exists("good", lambda x: x["attr"].isin("produce_species", "meat_species", "seafood_species"))
    policy = F.when(private, "PRIVATE").when(known, F.when(related, "SAME").otherwise("CONFLICT")).when(inferred, "SAME_INFERRED").when(c("a_brand_txt").isNull() & c("b_brand_txt").isNull() & shared, "COMMODITY").otherwise("UNKNOWN")
    quantity = F.coalesce(M.numeric_value(c("a_normalized_total_quantity_dim"), c("b_normalized_total_quantity_dim"), c("a_normalized_total_quantity_num"), c("b_normalized_total_quantity_num")), F.lit(-1.0))
    base = [x for x in ("row_key", "b_index", "item_id_A", "item_id_B", "name_A", "name_B", "retrieval_rank", "retrieval_score", "retrieval_rescue_type") if x in p.columns]
    return p.select(
        *base, F.round(M.clamp(F.least(match, cap)), 6).alias("match_evidence_score"), F.round(M.clamp(against), 6).alias("nonmatch_evidence_score"),
        F.round("fs", 6).alias("functional_identity_similarity"), F.round("ms", 6).alias("model_identifier_similarity"), F.size("good").alias("atomic_positive_evidence_count"),
        identity.alias("identity_anchor_count"), strong.alias("strong_support_count"), F.size("bad").alias("atomic_conflict_count"), (F.size(rules) > 0).alias("hard_veto"), rules.alias("hard_veto_rules"),
        F.size(asym).alias("modifier_asymmetry_count"), F.array_sort(asym).alias("modifier_asymmetries"), F.coalesce(c("a_brand_txt") == c("b_brand_txt"), F.lit(False)).alias("same_brand"),
        private.alias("private_label_pair"), national.alias("national_brand_pair"), quantity.alias("quantity_similarity"), policy.alias("brand_policy"), (T.bare(c("name_A")) == T.bare(c("name_B"))).alias("exact_title_match"),
    )
