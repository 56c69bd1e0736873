"""Title contradictions, safe promotion and the last gate before a match."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import quantity as Q
from ..functions import text as T

# Fixed values.
HARD = ("HARD_VETO", "BRAND", "ROLE", "FORM", "FLAVOR_SCENT_SHADE", "QUANTITY", "ORGANIC_STATUS")
ROLES = (
    "shampoo", "conditioner", "body wash", "bar soap", "deodorant", "antiperspirant", "lotion", "serum", "cleanser", "toothpaste", "mouthwash",
    "toothbrush", "floss", "detergent", "fabric softener", "dish soap", "trash bags", "coffee", "tea", "juice", "soda", "water", "yogurt", "milk",
    "cheese", "cereal", "granola", "crackers", "chips", "cookies", "pasta", "rice", "ketchup", "mustard", "mayonnaise", "salsa", "hummus",
)
STATUSES = (
    "organic", "lactose free", "sugar free", "zero sugar", "decaf", "caffeine free", "low sodium", "reduced sodium", "fat free", "low fat", "whole milk",
    "skim milk", "waterproof", "washable", "unscented", "fragrance free", "sensitive skin",
)
FORMATS = (
    (
        "ground coffee", "whole bean", "coffee pods", "coffee pod", "capsules", "capsule", "instant coffee",
    ),
    (
        "liquid detergent", "detergent pods", "detergent pacs", "laundry pods", "laundry pacs", "laundry sheets", "powder detergent",
    ),
)
FORMS = (
    "gummy", "gummies", "tablet", "tablets", "capsule", "capsules", "softgel", "softgels", "lozenge", "lozenges", "powder", "liquid",
)
FLAVORS = (
    "vanilla", "chocolate", "strawberry", "blueberry", "raspberry", "lemon", "lime", "orange", "apple", "cherry", "peach", "mango", "honey", "cinnamon",
    "garlic", "basil", "ranch", "bbq", "barbecue", "cheddar", "mozzarella", "mint", "peppermint", "coconut", "pineapple", "banana", "caramel",
    "hazelnut", "pumpkin", "grape", "watermelon", "cucumber", "berry", "mocha", "latte", "teriyaki", "barbacoa", "verde", "original",
)
TITLE_STOP = (
    "the", "a", "an", "and", "or", "with", "for", "of", "in", "on", "by", "from", "to", "at", "new", "premium", "classic", "original", "style",
    "assorted", "each", "per", "size", "pack", "count", "ct", "pk", "oz", "ounce", "ounces", "lb", "lbs", "pound", "pounds", "g", "kg", "mg", "mcg",
    "ml", "l", "fl", "fluid", "bottle", "bottles", "bag", "bags", "box", "boxes", "can", "cans", "carton", "cartons", "tub", "tubs", "jar", "jars",
    "pouch", "pouches", "package", "packages", "value", "family", "fresh", "made", "plus", "food", "foods", "brand", "recipe", "delicious", "natural",
    "naturally", "real", "great", "best", "quality", "extra", "super", "ultimate", "select", "signature", "traditional", "authentic",
)
SAFE = (
    "daily", "refreshing", "nourishing", "moisturizing", "natural", "naturally", "classic", "traditional", "premium", "signature", "adult", "men",
    "mens", "women", "womens", "kids", "kid", "baby", "family", "frozen", "refrigerated", "snack", "snacks", "flavored", "flavor", "style", "instant",
    "ready", "eat", "baked", "creamy", "rich", "pure", "gentle", "original", "broad", "spectrum", "with", "real", "made", "whole", "grain", "gluten",
    "free", "no", "added", "quick", "dry",
)
VARIANTS = (
    ("mild mint", "arctic mint", "cool mint", "fresh mint", "spearmint", "peppermint"), ("buttermilk ranch", "classic ranch", "light ranch", "fat free ranch"), ("extra moisturizing", "night"),
)
RISKY = (
    "model_or_part_identifier", "refill_vs_starter_kit", "coffee_format", "pet_species", "pet_life_stage", "meat_species", "meat_cut", "diaper_size",
    "formula_base", "absorbency", "spf", "shade", "waterproof_status", "washable_longwear_status", "release_type", "protein_source", "produce_species",
    "bundle_flag", "assortment_flag", "flavor_partial", "organic_status_private", "explicit_multipack", "flavor", "scent", "product_line", "color",
    "occasion_or_holiday",
)


def _lits(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def padded(c: Column) -> Column:
    return F.concat(F.lit(" "), T.bare(c), F.lit(" "))


def has(z: Column, phrase: str) -> Column:
    return z.contains(f" {phrase} ")


def any_of(z: Column, phrases) -> Column:
    return reduce(lambda x, y: x | y, [has(z, p) for p in phrases])


def first_of(z: Column, phrases) -> Column:
    return F.coalesce(*[F.when(has(z, p), p) for p in phrases])


def title_words(c: Column) -> Column:
    """Words of a bare title without quantities, numbers, stop words and single letters; a private label that starts it goes."""
    z = F.regexp_replace(T.bare(c), r"\b\d+(?:\.\d+)?\s*(?:fl\s*oz|oz|ounce|ounces|lb|lbs|pound|pounds|g|kg|mg|mcg|ml|l|ct|count|pk|pack|gal|gallon|gallons)\b", " ")
    z = F.regexp_replace(z, r"\b\d+(?:\.\d+)?\b", " ")
    labels = "|".join(sorted({*T.LABELS_A, *T.LABELS_B}, key=lambda p: (-len(p.split()), p)))
    kept = F.filter(F.split(F.trim(F.regexp_replace(z, r"\s+", " ")), " "), lambda x: (F.length(x) > 1) & ~F.array_contains(_lits(TITLE_STOP), x))
    return F.filter(F.split(F.regexp_replace(F.array_join(kept, " "), f"^(?:{labels})(?: |$)", ""), " "), lambda x: x != "")


def core_similarity(x: Column, y: Column) -> tuple[Column, Column]:
    """Jaccard and containment of two word sets; 0 if either is empty."""
    both = F.size(F.array_intersect(x, y))
    empty = (F.size(x) == 0) | (F.size(y) == 0)
    return tuple(F.when(empty, 0.0).otherwise(both / n) for n in (F.size(F.array_union(x, y)), F.least(F.size(x), F.size(y))))


def safe_wording(x: Column, y: Column) -> Column:
    apart = F.array_union(F.array_except(x, y), F.array_except(y, x))
    return F.size(F.array_except(apart, _lits(SAFE))) == 0


def obvious_conflict(a: Column, b: Column) -> Column:
    """Of padded titles: shampoo against conditioner, 2-in-1, body wash against salts, toothpaste against mouthwash, chocolate kind, heat."""
    s, k = "shampoo", "conditioner"
    two = lambda z: has(z, "2 in 1") | has(z, "2in1")
    hair = lambda z: has(z, s) | has(z, k)
    only = lambda z, x, y: has(z, x) & ~has(z, y)
    salt = lambda z: has(z, "epsom salt") | has(z, "bath salt")
    crossed = lambda f, g: (f(a) & g(b)) | (f(b) & g(a))
    differ = lambda names: F.coalesce(first_of(a, names) != first_of(b, names), F.lit(False))
    return (
        crossed(lambda z: only(z, s, k), lambda z: only(z, k, s)) | ((two(a) != two(b)) & hair(a) & hair(b)) | crossed(lambda z: has(z, "body wash"), salt)
        | crossed(lambda z: has(z, "toothpaste"), lambda z: has(z, "mouthwash")) | differ(("dark chocolate", "milk chocolate")) | differ(("mild", "medium", "hot"))
    )


def role_conflict(a: Column, b: Column, wa: Column, wb: Column) -> Column:
    """Both titles name product roles and share none; shampoo and conditioner must agree unless both are 2-in-1 shampoos."""
    roles = lambda w: F.array_compact(F.array(*[F.when(F.size(F.array_except(_lits(r.split()), w)) == 0, i) for i, r in enumerate(ROLES)]))
    ra, rb = roles(wa), roles(wb)
    inn = lambda w, x: F.array_contains(w, x)
    two = lambda z: has(z, "2 in 1") | has(z, "2in1")
    both_two = two(a) & two(b) & inn(wa, "shampoo") & inn(wb, "shampoo")
    hair = lambda w: inn(w, "shampoo") | inn(w, "conditioner")
    mixed = ((inn(wa, "shampoo") != inn(wb, "shampoo")) | (inn(wa, "conditioner") != inn(wb, "conditioner"))) & hair(wa) & hair(wb)
    return (~both_two & mixed) | ((F.size(ra) > 0) & (F.size(rb) > 0) & ~F.arrays_overlap(ra, rb))


def status_conflict(a: Column, b: Column) -> Column:
    return reduce(lambda x, y: x | y, [has(a, p) != has(b, p) for p in STATUSES])


def format_conflict(a: Column, b: Column) -> Column:
    differ = [F.coalesce(first_of(a, g) != first_of(b, g), F.lit(False)) for g in FORMATS]
    forms = lambda z: F.array_compact(F.array(*[F.when(has(z, f), f) for f in FORMS]))
    fa, fb = forms(a), forms(b)
    return reduce(lambda x, y: x | y, differ) | ((F.size(fa) > 0) & (F.size(fb) > 0) & ~F.arrays_overlap(fa, fb))


def flavor_words(w: Column) -> Column:
    return F.array_intersect(F.array_distinct(w), _lits(FLAVORS))


def disjoint(x: Column, y: Column) -> Column:
    return (F.size(x) > 0) & (F.size(y) > 0) & ~F.arrays_overlap(x, y)


def variant_conflict(a: Column, b: Column) -> Column:
    one = lambda p, q: (any_of(a, p) & ~any_of(b, p) & any_of(b, q)) | (any_of(b, p) & ~any_of(a, p) & any_of(a, q))
    fresh = (has(a, "fresh flavor") & has(b, "original")) | (has(b, "fresh flavor") & has(a, "original"))
    return one(("decaf", "caffeine free"), ("original", "caffeinated")) | one(("zero sugar", "sugar free"), ("original",)) | fresh


def strength(z: Column) -> Column:
    return F.when(any_of(z, ("maximum strength", "max strength", "ultra strength")), "MAX").when(has(z, "extra strength"), "EXTRA").when(any_of(z, ("original strength", "regular strength")), "ORIGINAL")


def named_variant_conflict(a: Column, b: Column) -> Column:
    return reduce(lambda x, y: x | y, [F.coalesce(first_of(a, g) != first_of(b, g), F.lit(False)) for g in VARIANTS])


def bundle_conflict(a: Column, b: Column) -> Column:
    refill = lambda z: z.contains(" refill")
    bundle = lambda z: refill(z) & any_of(z, ("warmer", "starter kit", "device"))
    return (bundle(a) & refill(b) & ~bundle(b)) | (bundle(b) & refill(a) & ~bundle(a))


def opposite_status(a: Column, b: Column) -> Column:
    crossed = lambda p, q: (any_of(a, p) & any_of(b, q)) | (any_of(b, p) & any_of(a, q))
    fat = (("fat free", "nonfat", "skim milk"), ("low fat", "lowfat"), ("reduced fat", "2 milk", "2 percent milk"), ("whole milk",))
    level = lambda z: F.coalesce(*[F.when(any_of(z, g), i) for i, g in enumerate(fat)])
    return crossed(("non organic",), ("organic",)) | crossed(("decaf", "caffeine free"), ("caffeinated",)) | F.coalesce(level(a) != level(b), F.lit(False))


def subtype_risk(a: Column, b: Column) -> Column:
    deep = has(a, "conditioner") & has(b, "conditioner") & (has(a, "deep conditioner") != has(b, "deep conditioner"))
    heel, sole = ("heel cushion", "heel cushions", "heel cup", "heel cups"), ("insole", "insoles")
    return deep | (any_of(a, heel) & any_of(b, sole)) | (any_of(b, heel) & any_of(a, sole))


def prepared(pairs: DataFrame) -> DataFrame:
    """pairs with what the rules read of name_A and name_B, each computed once: columns that begin with g_."""
    p = pairs
    for side in "AB":
        name = F.col(f"name_{side}")
        p = p.withColumn(f"g_amounts_{side}", Q.amounts(name)).withColumn(f"g_bare_{side}", T.bare(name))
    for side in "AB":
        bare = F.col(f"g_bare_{side}")
        p = p.withColumn(f"g_z_{side}", F.concat(F.lit(" "), bare, F.lit(" "))).withColumn(f"g_w_{side}", title_words(F.col(f"name_{side}"))).withColumn(f"g_plain_{side}", F.split(bare, " "))
        p = p.withColumn(f"g_counts_{side}", Q.count_values(F.col(f"name_{side}"))).withColumn(f"g_total_{side}", Q.pack_total(F.col(f"name_{side}"))).withColumn(f"g_packs_{side}", Q.pack_values(bare))
    a, b = F.col("g_w_A"), F.col("g_w_B")
    lead = F.coalesce(*[F.when((F.size(a) >= k) & (F.size(b) >= k) & (F.slice(a, 1, k) == F.slice(b, 1, k)), k) for k in (3, 2, 1)], F.lit(0))
    p = p.withColumn("g_lead", lead)
    for side in "AB":
        w = F.col(f"g_w_{side}")
        p = p.withColumn(f"g_core_{side}", F.array_distinct(F.slice(w, F.col("g_lead") + 1, F.size(w) + 1))).withColumn(f"g_flavor_{side}", flavor_words(F.col(f"g_plain_{side}")))
    return p


def unprepared(pairs: DataFrame) -> DataFrame:
    return pairs.drop(*[c for c in pairs.columns if c.startswith("g_")])


def firewall() -> Column:
    """Over a prepared scored pair: the blocker's name, or an empty text."""
    c = F.col
    a, b, wa, wb, fa, fb = (c(f"g_{x}") for x in ("z_A", "z_B", "w_A", "w_B", "flavor_A", "flavor_B"))
    ca, cb = c("g_counts_A"), c("g_counts_B")
    q = c("quantity_similarity")
    known = q > 0  # a similarity of 0 counts as unknown here
    tiers = F.coalesce(strength(a) != strength(b), F.lit(False))
    both = (F.size(ca) > 0) & (F.size(cb) > 0)
    rolls = Q.roll_tier(c("g_bare_A")), Q.roll_tier(c("g_bare_B"))
    totals = F.coalesce(c("g_total_A") != c("g_total_B"), F.lit(False))
    packs = (both & ~F.arrays_overlap(ca, cb)) | (~both & totals) | ((rolls[0] != "") & (rolls[1] != "") & (rolls[0] != rolls[1]))
    risky = F.array_intersect("modifier_asymmetries", _lits(RISKY))
    partial = (F.size(F.array_except(fa, fb)) + F.size(F.array_except(fb, fa)) > 0) & F.arrays_overlap(fa, fb)
    return (
        F.when(c("hard_veto"), "HARD_VETO")
        .when(~c("brand_policy").isin("SAME", "SAME_INFERRED", "PRIVATE", "COMMODITY"), "BRAND")
        .when(obvious_conflict(a, b) | role_conflict(a, b, wa, wb) | bundle_conflict(a, b), "ROLE")
        .when(format_conflict(a, b), "FORM")
        .when(disjoint(fa, fb) | variant_conflict(a, b) | tiers | named_variant_conflict(a, b), "FLAVOR_SCENT_SHADE")
        .when(packs | Q.size_conflict(c("g_amounts_A"), c("g_amounts_B")), "QUANTITY")
        .when(opposite_status(a, b), "ORGANIC_STATUS")
        .when(known & (q < 0.72), "QUANTITY")
        .when(F.size(risky) > 0, F.concat(F.lit("ATTRIBUTE_ASYMMETRY:"), F.array_join(F.array_sort(risky), ",")))
        .when(~known & ((F.size(ca) > 0) != (F.size(cb) > 0)), "ONE_SIDED_EXPLICIT_COUNT")
        .when(partial, "PARTIAL_FLAVOR_SCENT_VARIANT")
        .when(subtype_risk(a, b), "ONE_SIDED_PRODUCT_SUBTYPE")
        .otherwise("")
    )


def promotion() -> Column:
    """Over a prepared routed row under review: the reason for a safe promotion, or null."""
    c = F.col
    a, b, wa, wb, pa, pb = (c(f"g_{x}") for x in ("z_A", "z_B", "w_A", "w_B", "packs_A", "packs_B"))
    jac, contain = core_similarity(c("g_core_A"), c("g_core_B"))
    known = c("quantity_similarity") > 0
    same_pack = F.coalesce(F.array_max(pa) == F.array_max(pb), F.lit(False))
    packs = same_pack | ((F.size(pa) == 0) & (F.size(pb) == 0))
    asym = F.when(same_pack, F.array_remove("modifier_asymmetries", "explicit_multipack")).otherwise(c("modifier_asymmetries"))
    clean = ~c("hard_veto") & ~(obvious_conflict(a, b) | role_conflict(a, b, wa, wb) | status_conflict(a, b) | format_conflict(a, b) | disjoint(flavor_words(wa), flavor_words(wb)))
    guard = clean & (F.size(asym) == 0) & packs & safe_wording(c("g_core_A"), c("g_core_B")) & (known | (contain >= 0.78))
    allowed = (c("retrieval_rank") == 1) & (c("nonmatch_confidence") <= 0.28) & (~known | (c("quantity_similarity") >= 0.72)) & guard

    def over(raw: float, fs: float, ps: float, margin: float, evidence: int, least: float, j: float = 0.0) -> Column:
        return (
            (c("match_evidence_score") >= raw) & (c("functional_identity_similarity") >= fs) & (c("pair_support_score") >= ps) & (c("runner_up_margin") >= margin)
            & (c("atomic_positive_evidence_count") >= evidence) & (c("identity_anchor_count") >= 2) & (contain >= least) & (jac >= j)
        )

    policy = c("brand_policy")
    return F.when(
        allowed,
        F.when((policy == "SAME") & known & over(0.50, 0.55, 0.075, 0.005, 3, 0.78, 0.52), "SAFE_SAME_BRAND_KNOWN_QUANTITY")
        .when((policy == "SAME") & ~known & over(0.58, 0.68, 0.10, 0.018, 4, 0.90, 0.66), "SAFE_SAME_BRAND_UNKNOWN_QUANTITY")
        .when((policy == "PRIVATE") & known & over(0.50, 0.60, 0.08, 0.008, 3, 0.76, 0.46), "SAFE_PRIVATE_LABEL")
        .when((policy == "COMMODITY") & known & over(0.62, 0.80, 0.16, 0.025, 4, 0.80), "SAFE_COMMODITY"),
    )
