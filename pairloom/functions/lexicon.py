"""Phrase dictionaries: which words of a title state which attribute.

A lexicon is a parameter: a list of (attribute, phrase).  DEFAULT holds the attributes that decide matches most often; callers
pass a longer one for theirs, from a file of their own with sources.config.read_lexicon.  Phrases match on word boundaries, punctuation aside: 2% is the word 2.
"""

from __future__ import annotations

import json
import re
import zlib

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
DEFAULT = {
    "flavor": (
        "vanilla", "chocolate", "dark chocolate", "milk chocolate", "strawberry", "strawberries", "blueberry", "blueberries", "raspberry", "raspberries",
        "lemon", "lime", "orange", "apple", "cherry", "cherries", "peach", "mango", "honey", "cinnamon", "garlic", "ranch", "bbq", "barbecue", "cheddar",
        "mint", "coconut", "caramel", "grape", "mocha"
    ),
    "scent": ("unscented", "fragrance free", "lavender", "linen", "fresh scent", "citrus", "floral", "ocean", "rose", "eucalyptus"),
    "storage_state": ("frozen", "refrigerated", "chilled", "fresh", "shelf stable"),
    "physical_state": ("liquid", "powder", "gel", "cream", "lotion", "spray", "aerosol", "tablet", "capsule", "gummy", "wipes", "bar"),
    "organic_status": ("organic",),
    "gluten_status": ("gluten free",),
    "sugar_status": ("sugar free", "zero sugar", "no sugar added", "unsweetened", "sweetened", "diet"),
    "sodium_status": ("low sodium", "reduced sodium", "no salt added", "unsalted", "salted"),
    "fat_level": ("fat free", "nonfat", "low fat", "reduced fat", "whole milk", "2%", "1%", "skim"),
    "caffeine_status": ("decaf", "decaffeinated", "caffeine free", "caffeinated"),
    "carbonation_status": ("sparkling", "carbonated", "still"),
    "coffee_format": ("whole bean", "ground coffee", "coffee pods", "k cup", "instant coffee", "capsules"),
    "dosage_form": ("tablets", "capsules", "caplets", "gummies", "solution", "syrup", "ointment", "patch"),
    "waterproof_status": ("waterproof", "water resistant"),
    "washable_longwear_status": ("washable", "longwear", "long wear"),
    "pet_species": ("dog", "dogs", "cat", "cats", "kitten", "puppy", "rabbit", "bird", "fish"),
    "meat_species": ("beef", "chicken", "turkey", "pork", "lamb", "veal", "bison", "duck"),
    "seafood_species": ("salmon", "tuna", "shrimp", "cod", "tilapia", "haddock", "crab", "lobster"),
    "produce_species": (
        "strawberry", "strawberries", "apple", "apples", "banana", "bananas", "orange", "oranges", "tomato", "tomatoes", "potato", "potatoes", "onion",
        "onions", "carrot", "carrots", "corn", "lettuce"
    ),
    "product_line": ("simply", "sport", "kids", "baby", "professional", "zero sugar", "diet", "ultra", "complete", "original"),
    "packaging_form": ("bottle", "jar", "can", "box", "bag", "pouch", "tube", "carton", "tray", "tub", "cup", "packet"),
    "meat_cut": (
        "breast", "breasts", "thigh", "thighs", "wing", "wings", "drumstick", "drumsticks", "tenderloin", "tenderloins", "sirloin", "ribeye", "rib eye",
        "chuck", "round", "loin", "shoulder", "brisket", "ribs", "steak", "steaks"
    ),
    "egg_size_grade": ("peewee", "small", "medium", "large", "extra large", "jumbo", "grade aa", "grade a"),
}
#: Attributes read from the whole text of a product.
WHOLE_TEXT = {
    "light_bulb_base": ("e26", "e12", "gu10", "gu24", "g9", "g4", "mr16"),
    "light_bulb_shape": ("a19", "a15", "br30", "br40", "par20", "par30", "par38", "g25", "st19", "t8", "t12"),
    "connector_type": ("usb-c", "usb-a", "lightning", "hdmi", "displayport", "micro usb", "3.5mm"),
    "battery_spec": ("aa", "aaa", "c battery", "d battery", "9v", "cr2032", "cr2025", "lithium", "alkaline", "rechargeable"),
    "occasion_or_holiday": (
        "christmas", "halloween", "valentine", "valentine's day", "easter", "thanksgiving", "birthday", "graduation", "wedding", "hanukkah"
    ),
    "target_audience": ("men", "women", "boys", "girls", "kids", "children", "adult", "unisex"),
    "durable_material": (
        "cotton", "polyester", "stainless steel", "steel", "aluminum", "plastic", "glass", "wood", "silicone", "ceramic", "leather", "rubber"
    ),
    "formula_base": ("milk based", "soy based", "goat milk", "hypoallergenic", "gentle", "sensitive"),
    "wine_varietal": (
        "cabernet sauvignon", "sauvignon blanc", "pinot noir", "pinot grigio", "pinot gris", "chardonnay", "merlot", "riesling", "malbec", "syrah", "shiraz",
        "zinfandel", "moscato", "prosecco"
    ),
}
#: Qualities of attributes whose phrases aren't worth 0.94 (0.90 for a status).
QUALITY = {
    "packaging_form": 0.82, "product_line": 0.86, "egg_size_grade": 0.92, "light_bulb_base": 0.98, "light_bulb_shape": 0.98, "connector_type": 0.95, "battery_spec": 0.90, "occasion_or_holiday": 0.92,
    "target_audience": 0.78, "durable_material": 0.80, "formula_base": 0.90, "wine_varietal": 0.95,
}
#: Attributes with one value: the first of the phrases found, by spelling.
SINGLE = {"packaging_form", "wine_varietal"}
#: Attributes read from title and tags; all others from the title.
STATUS = {"organic_status", "gluten_status", "sugar_status", "sodium_status", "fat_level", "caffeine_status", "carbonation_status"}
CANON = {
    "strawberries": "strawberry", "blueberries": "blueberry", "raspberries": "raspberry", "cherries": "cherry", "barbecue": "bbq", "apples": "apple", "bananas": "banana",
    "oranges": "orange", "tomatoes": "tomato", "potatoes": "potato", "onions": "onion", "carrots": "carrot", "breasts": "breast", "thighs": "thigh", "wings": "wing", "drumsticks": "drumstick", "tenderloins": "tenderloin",
    "steaks": "steak",
}
FAMILIES = {
    "medicine": ("medicine", "medication", "pain relief", "cold cough", "allergy", "pharmacy", "ibuprofen", "acetaminophen", "aspirin"),
    "beauty_personal": (
        "makeup", "cosmetic", "mascara", "concealer", "foundation", "lip", "nail", "shampoo", "conditioner", "deodorant", "toothbrush", "oral care",
        "skin care", "personal care"
    ),
    "baby": ("baby", "infant", "diaper", "formula", "toddler", "training pants"),
    "pet": ("pet", "dog", "cat", "small animal", "litter", "pet food", "hay"),
    "alcohol": ("wine", "beer", "spirits", "liquor", "champagne", "vodka", "whiskey", "whisky", "rum", "tequila"),
    "beverage": ("beverage", "water", "juice", "coffee", "tea", "soda", "drink", "milk"),
    "food": ("food", "grocery", "frozen", "dairy", "bakery", "meat", "seafood", "produce", "snack", "cereal", "cheese", "yogurt", "sauce", "pasta"),
    "household_tech": ("light bulb", "battery", "electronics", "cable", "charger", "adapter", "storage media"),
    "household": ("home", "household", "cleaning", "paper towel", "toilet paper", "trash bag", "storage bag", "kitchen"),
    "apparel": ("apparel", "clothing", "shoe", "footwear", "sock", "shirt", "pants", "dress"),
}
SAFE_WORDS = (
    "the", "a", "an", "and", "with", "for", "of", "in", "new", "fresh", "premium", "classic", "original", "size", "pack", "count", "ct", "oz", "ounce",
    "fl", "bottle", "can", "bag", "box", "jar", "pouch", "each", "value", "natural", "quality", "style",
)


def pairs(table: dict[str, tuple[str, ...]]) -> list[tuple[str, str]]:
    return [(k, p) for k, v in table.items() for p in v]


def _plain(phrase: str) -> str:
    return " ".join(re.findall("[a-z0-9]+", phrase.lower()))


def _constant(rows: list[dict], kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(rows)), kind)


def hits(padded: Column, lexicon: list[tuple[str, str]]) -> Column:
    """array<struct<attr, term>> of the phrases in a boundary form, in the lexicon's order, in their canonical spelling.

    The text's runs of words are looked up in a constant hash table, those only that begin with a phrase's first word, so the work doesn't grow with the lexicon.
    """
    rows = [{"at": i, "attr": a, "term": CANON.get(p, p), "find": _plain(p)} for i, (a, p) in enumerate(lexicon) if _plain(p)]
    kind = "array<struct<attr:string,term:string>>"
    if not rows:
        return F.array().cast(kind)
    buckets: list[list[dict]] = [[] for _ in range(2 * len(rows))]
    for r in rows:
        buckets[zlib.crc32(r["find"].encode()) % len(buckets)].append(r)
    table = _constant(buckets, "array<array<struct<at:int,attr:string,term:string,find:string>>>")
    firsts = sorted({r["find"].split()[0] for r in rows})
    lengths = F.array(*[F.lit(n) for n in sorted({len(r["find"].split()) for r in rows})])

    def begun(words: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(1), F.size(words)), lambda i: F.element_at(words, i).isin(*firsts))
        return F.flatten(F.transform(starts, lambda i: F.transform(lengths, lambda n: F.array_join(F.slice(words, i, n), " "))))

    # The words are bound to a variable: a lambda would split the text again for each of them.
    runs = F.get(F.transform(F.array(F.split(F.trim(padded), " ")), begun), F.lit(0))
    of = lambda run: F.filter(F.get(table, (F.crc32(run.cast("binary")) % len(buckets)).cast("int")), lambda x: x["find"] == run)
    found = F.array_sort(F.array_distinct(F.flatten(F.transform(F.array_distinct(runs), of))))
    return F.transform(found, lambda x: F.struct(x["attr"].alias("attr"), x["term"].alias("term")))


def terms(found: Column, attr: str) -> Column:
    """Sorted distinct terms of an attribute; plain chocolate goes where a kind of it is named."""
    got = F.array_distinct(F.transform(F.filter(found, lambda x: x["attr"] == attr), lambda x: x["term"]))
    if attr == "flavor":
        kinds = F.array(F.lit("dark chocolate"), F.lit("milk chocolate"), F.lit("white chocolate"))
        got = F.when(F.arrays_overlap(got, kinds), F.array_remove(got, "chocolate")).otherwise(got)
    return F.array_sort(got)


def family(padded: Column) -> Column:
    """The family with the most phrases in a boundary form; the first of equals; null without any."""
    rows = [{"fam": f, "find": [f" {_plain(p)} " for p in v]} for f, v in FAMILIES.items()]
    scored = F.transform(
        _constant(rows, "array<struct<fam:string,find:array<string>>>"),
        lambda x, i: F.struct(F.size(F.filter(x["find"], lambda p: F.contains(padded, p))).alias("n"), (-i).alias("order"), x["fam"].alias("fam")),
    )
    best = F.array_max(scored)
    return F.when(best["n"] > 0, best["fam"])


def safe_difference(a: Column, b: Column) -> Column:
    """Whether two word arrays differ in harmless words only."""
    apart = F.array_union(F.array_except(a, b), F.array_except(b, a))
    return F.size(F.array_except(apart, F.array(*[F.lit(w) for w in SAFE_WORDS]))) == 0
