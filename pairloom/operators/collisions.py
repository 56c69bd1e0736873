"""Checks over all rows matched to one target: several source rows must not claim incompatible versions of it.

All steps demote to review and never promote.  A target's rows are aggregated to one row, map side first, which is joined back to them: a
target with very many rows is a skewed join key, which Spark splits, and no task collects it.  Only groups of two are put side by side.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import quantity as Q
from ..functions import similarity as M
from ..functions import text as T
from ..plans.stages import staged
from . import guards, nets

#: Brand policies under which ounces of weight and of volume are compared as they are shown.
COMPARABLE = ("SAME", "SAME_INFERRED", "PRIVATE")
#: Share of a group's rows that makes a token common.
COMMON = 0.80
STRONG = (
    "mini", "reduced", "lean", "decaf", "unscented", "baby", "infant", "kids", "kid", "boys", "boy", "girls", "girl", "men", "women", "puppy", "kitten",
    "senior", "clinical", "advanced", "sensitive", "gentle", "mega", "triple", "double", "jumbo", "holiday", "white", "yellow", "pink", "red", "blue",
    "green", "black", "brown", "purple", "orange", "gold", "silver", "gray", "vanilla", "chocolate", "strawberry", "lemon", "lime", "apple", "cherry",
    "mint", "coconut", "caramel", "chicken", "beef",
)


def pair_block() -> Column:
    """Over a match prepared by demotions: why the target's metadata rules the pair out, or null."""
    c = F.col
    a, b, ca, cb = c("g_a"), c("g_b"), c("g_ca"), c("g_cb")
    heel, sole = ("heel cushion", "heel cushions", "heel cup", "heel cups"), ("insole", "insoles")
    pods = ("k cup", "k cups", "coffee pod", "coffee pods", "capsule", "capsules")
    ground = guards.has(a, "canister") | guards.has(a, "ground") | (F.size(c("amounts_A")["mass"]) > 0)
    title = c("g_title")
    holder = (guards.has(a, "bowl") & guards.has(title, "bag")) | (guards.has(a, "bag") & guards.has(title, "bowl"))

    def far(x: Column, y: Column) -> Column:
        x = nets.with_counted(x, ca)
        return (F.size(x) > 0) & (F.size(y) > 0) & ~M.near_any(x, y, 0.05)

    apart = lambda dim: far(c("amounts_A")[dim], c("amounts_size")[dim])

    return (
        F.when(guards.disjoint(ca, cb), "B_METADATA_COUNT")
        .when(apart("mass") | apart("volume"), "B_METADATA_SIZE")
        .when(c("brand_policy").isin(*COMPARABLE) & far(c("ounces_A"), c("ounces_size")), "B_METADATA_OZ_SIZE")
        .when(F.coalesce(guards.strength(a) != guards.strength(b), F.lit(False)), "B_METADATA_STRENGTH")
        .when(guards.named_variant_conflict(a, c("g_title")), "B_METADATA_VARIANT")
        .when((guards.any_of(a, heel) & guards.any_of(b, sole)) | (guards.any_of(b, heel) & guards.any_of(a, sole)) | holder, "B_METADATA_ROLE")
        .when(guards.any_of(b, pods) & ~guards.any_of(a, pods) & ground, "B_METADATA_FORM")
    )


def national_conflict() -> Column:
    """Over the same columns, for same-brand pairs: the first explicit contradiction of an exact product, or null."""
    c = F.col
    a, short, full, title = c("g_a"), c("g_short"), c("g_full"), c("g_title")
    missing = lambda phrases, z=short: guards.any_of(a, phrases) & ~guards.any_of(z, phrases)
    colors = "white yellow pink red blue green black brown purple orange gold silver gray grey beige".split()
    present = lambda z, names: F.array_compact(F.array(*[F.when(guards.has(z, n), n) for n in names]))
    differ = lambda names, z=title: guards.disjoint(present(a, names), present(z, names))
    ids = lambda x: F.filter(F.regexp_extract_all(F.upper(x), F.lit(r"\b([A-Z][A-Z0-9]*(?:[-/][A-Z0-9]+)*)\b"), F.lit(1)), lambda v: (F.length(v) >= 4) & v.rlike(r"\d") & ~v.rlike("^[2-9]IN1$"))
    ia, ib = ids(c("name_A")), ids(F.concat_ws(" ", "name_B", F.substring("description_B", 1, 220)))
    alpha = lambda v: F.regexp_extract(v, "^([A-Z]+)", 1)
    shared = F.exists(ia, lambda x: F.exists(ib, lambda y: alpha(x) == alpha(y)))
    fits = F.exists(ia, lambda x: F.exists(ib, lambda y: Q.model_compatible(x, y)))
    total = Q.explicit_total_count(c("name_A")) != Q.first_number(F.lower("size_B"), r"\b(\d+)\s*(?:ct|count)\b")
    lead = Q.leading_multipack(c("name_A"))
    text = F.lower(F.concat_ws(" ", "name_B", F.substring("description_B", 1, 220), "size_B"))
    confirmed = F.exists(F.regexp_extract_all(text, F.lit(r"(?:pack\s+of\s+(\d+))|(?:(\d+)\s*(?:pack|pk|ct|count)\b)"), F.lit(0)), lambda x: F.regexp_extract(x, r"(\d+)", 1).try_cast("bigint") == lead)
    stages = ("puppy", "kitten")
    return F.when(
        c("brand_policy").isin("SAME", "SAME_INFERRED"),
        F.when(shared & ~fits, "V17_NATIONAL_MODEL_PART")
        .when(missing(("zero sugar", "sugar free", "sugarfree", "no sugar")), "V17_NATIONAL_SUGAR_STATUS_UNRESOLVED")
        .when(missing(("unscented", "fragrance free", "fragrancefree")), "V17_NATIONAL_SCENT_STATUS_UNRESOLVED")
        .when(missing(("organic",), full), "V17_NATIONAL_ORGANIC_STATUS_UNRESOLVED")
        .when(guards.has(a, "foundation") & ~guards.any_of(short, ("foundation", "tint")), "V17_NATIONAL_FOUNDATION_VARIANT_UNRESOLVED")
        .when(differ(colors), "V17_NATIONAL_COLOR_VARIANT")
        .when(differ(("boy", "boys", "girl", "girls")) | differ(("men", "women")), "V17_NATIONAL_AUDIENCE_VARIANT")
        .when(guards.has(a, "roast") & guards.has(title, "roast") & differ(("light", "medium", "dark")), "V17_NATIONAL_ROAST_VARIANT")
        .when(differ(("clinical", "advanced", "maximum", "regular"), short), "V17_NATIONAL_TIER_VARIANT")
        .when(differ(("balsamic", "ranch", "italian", "caesar")), "V17_NATIONAL_DRESSING_VARIANT")
        .when(differ(("retinol", "hyaluronic", "salicylic", "benzoyl"), short), "V17_NATIONAL_ACTIVE_VARIANT")
        .when(differ(("express", "overnight")), "V17_NATIONAL_TIMING_VARIANT")
        .when(guards.named_variant_conflict(a, title), "V17_NATIONAL_NAMED_VARIANT")
        .when(missing(("low sodium", "reduced sodium")), "V17_NATIONAL_SODIUM_STATUS_UNRESOLVED")
        .when(guards.any_of(a, ("nighttime", "daytime")) & ((guards.has(a, "nighttime") & ~guards.has(short, "nighttime")) | (guards.has(a, "daytime") & ~guards.has(short, "daytime"))), "V17_NATIONAL_TIME_FORMULA_UNRESOLVED")
        .when(missing(stages[:1]) | missing(stages[1:]), "V17_NATIONAL_LIFE_STAGE_UNRESOLVED")
        .when(F.coalesce(total, F.lit(False)), "V17_NATIONAL_TOTAL_COUNT")
        .when(lead.isNotNull() & ~F.coalesce(confirmed, F.lit(False)), "V17_NATIONAL_MULTIPACK_UNCONFIRMED")
        .when(missing(("bonus",)), "V17_NATIONAL_BONUS_CONFIG")
        .when(guards.any_of(a, ("broom", "faucet", "starter kit", "bundle")) & ~guards.any_of(short, ("broom", "faucet", "starter kit", "bundle")), "V17_NATIONAL_ROLE_BUNDLE"),
    )


def size_errors(rows: DataFrame) -> DataFrame:
    """rows with err: the least relative size error to the target's size; null if incomparable.

    rows: row_key, target, brand_policy, amounts_A, amounts_size, ounces_A, ounces_size, and counts g_ca and g_cb.
    """
    c = F.col
    ca, cb = c("g_ca"), c("g_cb")

    def errors(x: Column, y: Column) -> Column:
        x, y = nets.with_counted(x, ca), nets.with_counted(y, cb)
        return F.flatten(F.transform(x, lambda v: F.transform(y, lambda w: M.relative(v, w))))

    none = F.array().cast("array<double>")
    shown = F.when(c("brand_policy").isin(*COMPARABLE), errors(c("ounces_A"), c("ounces_size"))).otherwise(none)
    counts = F.when((F.size(ca) > 0) & (F.size(cb) > 0), F.array(F.when(F.arrays_overlap(ca, cb), 0.0).otherwise(1.0))).otherwise(none)
    each = [errors(c("amounts_A")[d], c("amounts_size")[d]) for d in ("mass", "volume")]
    return rows.withColumn("err", F.array_min(F.concat(*each, shown, counts)))


def size_preference(rows: DataFrame) -> DataFrame:
    """rows (target, err, ...) with worse: among comparable rows of a target some fit its size clearly better."""
    of = rows.groupBy("target").agg(F.count("*").alias("__n"), F.min(F.when(F.col("err") < 0.20, F.col("err"))).alias("__best"))
    worse = (F.col("__n") >= 2) & (F.col("err") > F.greatest(F.lit(0.025), F.col("__best") + 0.012))
    return rows.join(of, "target").withColumn("worse", F.coalesce(worse & F.col("__best").isNotNull(), F.lit(False))).drop("__n", "__best")


def package_conflicts(rows: DataFrame, own: str = "sig", target: str = "sig_b", counts: str = "", target_counts: str = "") -> DataFrame:
    """rows (target, sig, sig_b) with package: why a row of a target with two and more disagrees with the others or with it, or null.

    GENERAL_COUNT (where columns of counts are named), then TOTAL_COUNT, ROLL_COUNT, ROLL_TIER and SHEETS_PER_ROLL.
    """
    fields = (("sheets", "SHEETS_PER_ROLL"), ("tier", "ROLL_TIER"), ("rolls", "ROLL_COUNT"), ("total", "TOTAL_COUNT"))
    ends = [f(F.col(own)[x]).alias(f"__{name}_{x}") for x, _ in fields for name, f in (("low", F.min), ("high", F.max))]
    rows = rows.join(rows.groupBy("target").agg(F.count("*").alias("__n"), *ends), "target")
    reason = F.lit(None).cast("string")
    for field, label in fields:
        x, y = F.col(own)[field], F.col(target)[field]
        mixed = F.col(f"__low_{field}") != F.col(f"__high_{field}")
        bad = x.isNotNull() & F.when(mixed, y.isNull() | (x != y)).otherwise(y.isNotNull() & (x != y))
        reason = F.when(F.coalesce(bad, F.lit(False)), label).otherwise(reason)
    if counts:
        reason = F.when(guards.disjoint(F.col(counts), F.col(target_counts)), "GENERAL_COUNT").otherwise(reason)
    return rows.withColumn("package", F.when(F.col("__n") >= 2, reason)).drop(*[c for c in rows.columns if c.startswith("__")])


def common_tokens(rows: DataFrame, share: float = COMMON) -> DataFrame:
    """(target, token): tokens that at least that share of a target's rows hold; rows: (target, row_key, words)."""
    n = rows.groupBy("target").agg(F.count("*").alias("n"))
    each = rows.select("target", F.explode(F.array_distinct("words")).alias("token")).groupBy("target", "token").agg(F.count("*").alias("k"))
    return each.join(n, "target").where(F.col("k") / F.col("n") >= share).select("target", "token")


def _strong(words: Column) -> Column:
    return F.array_intersect(words, F.array(*[F.lit(x) for x in STRONG]))


def unsupported_variants(rows: DataFrame) -> DataFrame:
    """(row_key) of the one of two rows of a target that names a variant the target doesn't, while the other fits it clearly better; rows: (target, row_key, words, evidence)."""
    two = rows.groupBy("target").agg(F.count("*").alias("n"), F.min(F.struct("row_key", "words")).alias("x"), F.max(F.struct("row_key", "words")).alias("y"), F.first("evidence").alias("evidence")).where("n = 2")
    cover = lambda w: F.size(F.array_intersect(w, "evidence")) / F.greatest(F.size(w), F.lit(1))
    sides = two.select("evidence", "x", "y", cover(F.col("x.words")).alias("cx"), cover(F.col("y.words")).alias("cy"))
    first = F.col("cx") >= F.col("cy")
    sides = sides.select("evidence", *[F.when(first, F.col(p)).otherwise(F.col(q)).alias(n) for p, q, n in (("x", "y", "best"), ("y", "x", "other"), ("cx", "cy", "high"), ("cy", "cx", "low"))])
    own = lambda a, b: F.array_except(_strong(F.array_except(F.col(a)["words"], F.col(b)["words"])), "evidence")
    alike = F.size(F.array_intersect("best.words", "other.words")) / F.greatest(F.size(F.array_union("best.words", "other.words")), F.lit(1))
    bad = (F.size(own("other", "best")) > 0) & (F.size(own("best", "other")) == 0) & (F.col("high") >= 0.72) & (F.col("high") - F.col("low") >= 0.10) & (alike < 0.72)
    return sides.where(bad).select(F.col("other.row_key").alias("row_key"))


def identity_conflicts(rows: DataFrame) -> DataFrame:
    """(row_key) of rows in groups of three or more whose own words the target doesn't support; rows: (target, row_key, words, evidence)."""
    n = rows.groupBy("target").agg(F.count("*").alias("n")).where("n >= 3")
    common = common_tokens(rows).groupBy("target").agg(F.collect_list("token").alias("common"))
    p = rows.join(n.join(common, "target", "left"), "target").withColumn("common", F.coalesce("common", F.array().cast("array<string>")))
    words = F.array_distinct("words")
    p = p.withColumn("own", F.array_sort(F.array_except(words, "common"))).withColumn("cover", F.size(F.array_intersect(words, "evidence")) / F.greatest(F.size(words), F.lit(1)))
    p = p.withColumn("support", F.size(F.array_intersect("own", "evidence")) / F.greatest(F.size("own"), F.lit(1)))
    strong = F.size(F.array_except(_strong(F.col("own")), "evidence")) > 0
    low = F.when(F.col("n") >= 6, (F.col("cover") < 0.90) & (F.col("support") < 0.50)).otherwise((F.col("cover") < 0.65) & (F.col("support") < 0.20))
    several = p.groupBy("target").agg(F.min("own").alias("low"), F.max("own").alias("high")).where("low <> high").select("target")
    return p.join(several, "target", "left_semi").where((F.size("own") > 0) & (strong | low)).select("row_key")


def demotions(matches: DataFrame, keep: Callable[[DataFrame], DataFrame] = staged) -> DataFrame:
    """(row_key, reason): the first reason, in the order of the checks, to send a provisional match to review.

    matches: row_key, target, name_A, name_B, brand_B, description_B, info_B (may be missing), size_B, brand_policy.  keep: stores a step's rows, which later steps read several times.
    """
    m = matches.withColumn("amounts_A", Q.amounts(F.col("name_A"))).withColumn("amounts_size", Q.amounts(F.col("size_B")))
    title, text = F.col("name_A"), F.concat_ws(" ", "name_B", F.substring("description_B", 1, 1200))
    m = m.withColumn("ounces_A", nets.shown_ounces(title)).withColumn("ounces_size", nets.shown_ounces(F.col("size_B")))
    m = m.withColumn("g_a", guards.padded(title)).withColumn("g_b", guards.padded(text)).withColumn("g_title", guards.padded(F.col("name_B")))
    m = m if "info_B" in m.columns else m.withColumn("info_B", F.lit(""))
    short = F.concat_ws(" ", "name_B", F.substring("description_B", 1, 220))
    m = m.withColumn("g_short", guards.padded(short)).withColumn("g_full", guards.padded(F.concat_ws(" ", short, F.substring("info_B", 1, 260)))).withColumn("g_ca", Q.count_values(title)).withColumn("g_cb", Q.count_values(F.col("size_B")))
    m = m.withColumn("block", pair_block()).withColumn("conflict", national_conflict()).withColumn("reason", F.coalesce("block", "conflict"))
    m = keep(m)
    alive = keep(size_preference(size_errors(m.where("reason is null"))))
    text_b = F.concat_ws(" ", "name_B", F.substring("description_B", 1, 160), "size_B")
    kept = alive.where("not worse").withColumn("sig", Q.package_signature(F.col("name_A"), T.bare_colon(F.col("name_A")))).withColumn("sig_b", Q.package_signature(text_b, T.bare_colon(text_b)))
    about = F.concat_ws(" ", "name_B", F.substring("description_B", 1, 220), "size_B")
    kept = keep(package_conflicts(kept.withColumn("about", Q.count_values(about)), counts="g_ca", target_counts="about"))
    brand = F.split(T.bare(F.col("brand_B")), " ")
    words = F.array_except(guards.title_words(F.col("name_A")), brand)
    evidence = F.array_except(guards.title_words(F.concat_ws(" ", "name_B", F.substring("description_B", 1, 500), F.substring("info_B", 1, 250))), brand)
    active = kept.where(F.col("package").isNull() & F.col("brand_policy").isin("SAME", "SAME_INFERRED")).select("target", "row_key", words.alias("words"), evidence.alias("evidence"))
    out = m.where("reason is not null").select("row_key", "reason")
    out = out.union(alive.where("worse").select("row_key", F.lit("B_COLLISION_BEST_STRUCTURED_SIZE")))
    out = out.union(kept.where("package is not null").select("row_key", F.concat(F.lit("V17_COLLISION_"), "package")))
    active = keep(active)
    out = out.union(unsupported_variants(active).select("row_key", F.lit("V17_COLLISION_UNSUPPORTED_VARIANT")))
    return out.union(identity_conflicts(active).select("row_key", F.lit("V17_COLLISION_NATIONAL_SKU_IDENTITY")))
