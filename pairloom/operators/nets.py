"""Net contents of a package, from a title or a size: expressions over match places, no Python worker.

The leftmost amount counts.  It is multiplied by the number of packages only where the text leaves no doubt: an outer pack named before it (mode mult), or
a count of containers around it (mode perunit).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import quantity as Q

# Units with their dimension and factor, containers, nutrients, and how far around an amount they are looked for.
NUMBER = r"(\d+(?:\.\d+)?)\s*"
NUTRIENT = r"(?!\s*(?:of\s+)?(?:protein|sugar|carbs?|fiber|fat)\b)"
UNITS = (
    ("vol", r"(?:fl\.?\s*oz\.?|fluid\s*ounces?)", Q.FLUID_OUNCE),
    ("vol", r"(?:ml|milliliters?)\b", 1.0),
    ("vol", r"(?:l|liters?|litres?)\b", 1000.0),
    ("mass", r"(?:oz\.?|ounces?)\b" + NUTRIENT, Q.OUNCE),
    ("mass", r"(?:lbs?|pounds?)\b" + NUTRIENT, Q.POUND),
    ("mass", r"(?:kg|kilograms?)\b" + NUTRIENT, 1000.0),
    ("mass", r"(?:g|grams?)\b" + NUTRIENT, 1.0),
)
SHORT_UNIT = r"(?:fl\.?\s*oz\.?|fluid\s*ounces?|oz\.?|ounces?|ml|l|g|kg|lbs?)"
BOTTLES, PACKETS, BOXES, CUPS = "bottles?|cans?|tins?|pouches?", "packets?", "boxes?", "cups?"
CONTAINER = rf"\b(?:{BOTTLES}|{PACKETS}|{BOXES}|{CUPS})\b"
BEFORE, AFTER, TAIL, CLOSE = 35, 120, 100, 35
OUTER = (
    rf"\b([2-9]\d*)\s*x\s*\d+(?:\.\d+)?\s*{SHORT_UNIT}(?![a-z])",
    r"^\s*\(?\s*([2-9]\d*)\s*(?:pack|pk)\b",
    rf"^\s*\(?\s*([2-9]\d*)\s*(?:{BOTTLES}|{PACKETS})\b",
)
EACH = (
    r"contains\s+(\d+)\s+(?:individually\s+)?(?:portioned\s*)?,?\s*([0-9]+(?:\.[0-9]+)?)\s*[- ]?(?:ounce|oz)\b",
    r"\b(\d+)\s+(?:individually\s+)?(?:wrapped\s+)?(?:packs?|cups?|bottles?).{0,60}?\b([0-9]+(?:\.[0-9]+)?)\s*[- ]?(?:ounce|oz)\b",
)
DESCRIPTION = 900

FIELDS = (("dim", "string"), ("total", "double"), ("shown", "double"), ("mode", "string"))


def plain(c: Column) -> Column:
    return F.replace(F.lower(F.coalesce(c, F.lit(""))), F.lit("×"), F.lit("x"))


def first_amount(z: Column) -> Column:
    """struct<pos, k, dim, value, end> of the leftmost amount of a plain text, positions from 1, end exclusive; null without one.  Nutrients aren't amounts."""

    def hit(k: int, dim: str, unit: str, factor: float) -> Column:
        p = F.lit(NUMBER + unit)
        pos = F.regexp_instr(z, p)
        whole, number = (F.regexp_extract(z, NUMBER + unit, g) for g in (0, 1))
        found = F.struct(pos.alias("pos"), F.lit(k).alias("k"), F.lit(dim).alias("dim"), (number.try_cast("double") * factor).alias("value"), (pos + F.length(whole)).alias("end"))
        return F.when(pos > 0, found)

    return F.array_min(F.array_compact(F.array(*[hit(k, *u) for k, u in enumerate(UNITS)])))


def _says(text: Column, *parts: Column | str) -> Column:
    return F.regexp_like(text, F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]))


def per_unit(z: Column, first: Column, count: Column) -> Column:
    """Whether the amount is that of one of count containers: a counted pack before it, or containers counted after or named before it."""
    n = count.cast("string")
    after, tail = F.substring(z, first["end"], F.lit(AFTER)), F.substring(z, first["end"], F.lit(TAIL))
    before = F.substring(z, F.greatest(F.lit(1), first["pos"] - BEFORE), F.least(first["pos"] - 1, F.lit(BEFORE)))
    packed = _says(z, r"\b", n, rf"\s*(?:ct|count)?\s*(?:pack|pk)\b.{{0,55}}?\d+(?:\.\d+)?\s*{SHORT_UNIT}(?![a-z]).{{0,30}}?\b(?:{BOTTLES}|{BOXES}|{PACKETS})\b")
    counted = _says(tail, r"\b", n, rf"\s+(?:{BOTTLES})\b")
    pattern = F.concat(F.lit(r"\b"), n, F.lit(r"\s*(?:ct|count)\b"))
    at = F.regexp_instr(after, pattern)
    near = F.substring(after, F.lit(1), at - 1 + F.length(F.regexp_substr(after, pattern)) + CLOSE)
    named = before.rlike(CONTAINER + r"[\s,:;/-]*$") & ~F.substring(z, first["end"], F.lit(28)).rlike(r"^\s*(?:bag|box|carton)\b")
    return (count > 1) & (packed | counted | ((at > 0) & near.rlike(CONTAINER)) | named)


def with_net(rows: DataFrame, out: str, text: Column, count: Column, description: Column | None = None) -> DataFrame:
    """rows with out: struct<dim, total, shown, mode> of a text whose package count is count; all fields null without an amount.

    With a description, a text without an amount takes n packs of so many ounces as that starts to say (mode text, shown null).
    Steps are columns of their own, as each is used several times.
    """
    c = F.col
    rows = rows.withColumn("__z", plain(text)).withColumn("__n", count).withColumn("__first", first_amount(c("__z")))
    rows = rows.withColumn("__outer", F.coalesce(*[Q.first_number(c("__z"), p) for p in OUTER])).withColumn("__units", F.coalesce(per_unit(c("__z"), c("__first"), c("__n")), F.lit(False)))
    first, outer, units = c("__first"), c("__outer"), c("__units")
    mode = F.when(first.isNotNull(), F.when(outer.isNotNull(), "mult").when(units, "perunit").otherwise("package"))
    total = first["value"] * F.when(outer.isNotNull(), outer).when(units, c("__n")).otherwise(1)
    struct = lambda *xs: F.struct(*[x.cast(t).alias(n) for x, (n, t) in zip(xs, FIELDS, strict=True)])
    net = struct(first["dim"], total, first["value"], mode)
    if description is not None:
        d = F.lower(F.substring(F.coalesce(description, F.lit("")), 1, DESCRIPTION))
        ounces = F.coalesce(*[Q.first_number(d, p, 1) * F.nullif(F.regexp_extract(d, p, 2), F.lit("")).try_cast("double") * Q.OUNCE for p in EACH])
        rows = rows.withColumn("__each", ounces)
        net = F.when(first.isNull() & c("__each").isNotNull(), struct(F.lit("mass"), c("__each"), F.lit(None), F.lit("text"))).otherwise(net)
    return rows.withColumn(out, net).drop("__z", "__n", "__first", "__outer", "__units", "__each")


def shown_ounces(text: Column) -> Column:
    """Every number of ounces that a text shows, of weight or of volume."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"\b(\d+(?:\.\d+)?)\s*(?:(?:fl\.?\s*)?oz\.?|ounces?)\b"), F.lit(1))
    return F.transform(found, lambda v: v.cast("double"))


def with_counted(values: Column, counts: Column) -> Column:
    """Amounts, and each times the count where there is just one count from 2 to 200: a size may state the whole content, a title that of one unit."""
    several = F.filter(counts, lambda n: n.between(2, 200))
    return F.when(F.size(several) == 1, F.concat(values, F.transform(values, lambda v: v * several[0]))).otherwise(values)
