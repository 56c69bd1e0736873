"""Normalisers and tokenisers as Column expressions.

Several normal forms exist side by side because each feeds rules that depend on exactly what it keeps.
All stay in the JVM except HTML unescaping and NFKC, for which Spark has no function: an Arrow UDF does both.
"""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Fixed values.
STOP_WORDS = (
    "the a an and or with for of in on by from to at new premium classic original style assorted each per size "
    "pack count ct pk oz ounce ounces lb lbs g kg ml l"
).split()
LABELS_A = (
    "great value", "marketside", "equate", "parent s choice", "parents choice", "ol roy", "special kitty", "sam s choice", "sams choice",
    "athletic works", "mainstays", "hyper tough", "better homes and gardens", "expert gardener", "onn", "george",
)
LABELS_B = ("wegmans",)
NUMBER = r"\b\d+(?:\.\d+)?(?:\s*(?:fl\s*oz|oz|lb|g|kg|mg|mcg|ml|l|ct|count|pk|pack|%))?\b"
CODE = r"\b(?=[a-z0-9-]{3,24}\b)(?=[a-z0-9-]*[a-z])(?=[a-z0-9-]*\d)[a-z0-9-]+\b"
BRAND_ALIASES = {"coca cola": "coca-cola", "loreal paris": "l'oreal paris", "dr. pepper": "dr pepper", "m and ms": "m&m's", "m&ms": "m&m's"}
COMPANY_WORDS = r"\b(company|co|inc|llc|corp|corporation)\b"


@F.pandas_udf(StringType())
def _plain(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFKC", html.unescape(x)), na_action="ignore")


@F.pandas_udf(StringType())
def _unescaped(s: pd.Series) -> pd.Series:
    return s.map(html.unescape, na_action="ignore")


def known(c: Column) -> Column:
    """The text; null and 'nan' are empty."""
    c = F.coalesce(c.cast("string"), F.lit(""))
    return F.when(F.lower(c) == "nan", "").otherwise(c)


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def _spelled(c: Column) -> Column:
    return F.replace(F.replace(F.lower(c), F.lit("&"), F.lit(" and ")), F.lit("×"), F.lit("x"))


def norm(c: Column, unicode: bool = True) -> Column:
    """Retrieval form: [a-z0-9%+.-] and single blanks.  unicode=False skips unescaping and NFKC and stays in the JVM: for text known to be plain."""
    c = known(c)
    return squeeze(F.regexp_replace(_spelled(_plain(c) if unicode else c), r"[^a-z0-9%+.\- ]+", " "))


def norm_text(c: Column, unicode: bool = True) -> Column:
    """Evidence form: tags go, dashes are one, [a-z0-9%+-./'] stay."""
    c = F.coalesce(c.cast("string"), F.lit(""))
    c = F.regexp_replace(_unescaped(c) if unicode else c, r"<[^>]+>", " ")
    c = F.regexp_replace(_spelled(_plain_nfkc(c) if unicode else c), "[‐‑‒–—−]", "-")
    return squeeze(F.regexp_replace(c, r"[^a-z0-9%+\-./' ]+", " "))


@F.pandas_udf(StringType())
def _plain_nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


def boundary(c: Column) -> Column:
    """Of a normal form: words only, one blank between and around them."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(c, "[^a-z0-9]+", " ")), F.lit(" "))


def bare(c: Column) -> Column:
    """Lower-cased [a-z0-9] words; 'nan' is empty; no unescaping."""
    return squeeze(F.regexp_replace(F.lower(known(c)), "[^a-z0-9]+", " "))


def bare_colon(c: Column) -> Column:
    """As bare, but colons stay and 'nan' is a word."""
    return squeeze(F.regexp_replace(F.lower(F.coalesce(c.cast("string"), F.lit(""))), "[^a-z0-9:]+", " "))


def norm_brand(c: Column, unicode: bool = True) -> Column:
    s = F.regexp_replace(norm_text(c, unicode), COMPANY_WORDS, " ")
    s = F.btrim(squeeze(s), F.lit(" .-'"))
    table = F.create_map(*[F.lit(x) for kv in BRAND_ALIASES.items() for x in kv])
    return F.coalesce(F.try_element_at(table, s), s)


def words(normal: Column) -> Column:
    return F.regexp_extract_all(normal, F.lit("([a-z0-9]+)"), F.lit(1))


def joined_words(normal: Column) -> Column:
    """Words that may hold one inner hyphen or apostrophe."""
    return F.regexp_extract_all(normal, F.lit("([a-z0-9]+(?:[-'][a-z0-9]+)?)"), F.lit(1))


def core_tokens(title: Column, brand: Column) -> Column:
    """Sorted distinct words of a retrieval form without stop words, brand words and whole numbers."""
    stop = F.array(*[F.lit(w) for w in STOP_WORDS])
    kept = F.filter(words(title), lambda w: ~w.rlike("^[0-9]+$"))
    return F.array_sort(F.array_except(F.array_except(F.array_distinct(kept), stop), words(brand)))


def functional_words(name: Column, brand: Column) -> Column:
    """As core_tokens over the evidence form: words with inner marks, and decimals go too."""
    stop = F.array(*[F.lit(w) for w in STOP_WORDS])
    kept = F.filter(joined_words(name), lambda w: ~w.rlike(r"^[0-9]+(\.[0-9]+)?$"))
    return F.array_sort(F.array_except(F.array_except(F.array_distinct(kept), stop), joined_words(brand)))


def numeric_tokens(*normal: Column) -> Column:
    """Sorted distinct numbers with an optional unit, and codes of letters and digits, over joined retrieval forms."""
    s = F.concat_ws(" ", *normal)
    numbers = F.transform(F.regexp_extract_all(s, F.lit(NUMBER), F.lit(0)), lambda x: F.regexp_replace(x, r"\s+", ""))
    return F.array_sort(F.array_distinct(F.concat(numbers, F.regexp_extract_all(s, F.lit(CODE), F.lit(0)))))


def id_text(c: Column) -> Column:
    """An id as text: 123.0 is 123."""
    return F.regexp_replace(F.trim(F.coalesce(c.cast("string"), F.lit(""))), r"^(\d+)\.0+$", "$1")


def number(c: Column) -> Column:
    """A number or null, whatever the text."""
    return c.cast("string").try_cast("double")


def category_path(info: Column) -> Column:
    """Distinct category_0..3 of a JSON object, joined, 180 characters at most."""
    levels = F.array(*[F.get_json_object(info, f"$.category_{i}") for i in range(4)])
    return F.substring(F.array_join(F.array_distinct(F.filter(levels, lambda x: x.isNotNull() & (x != ""))), " > "), 1, 180)


def friendly_size(sizing: Column) -> Column:
    """size_user_friendly, else size, of a JSON object."""
    first = F.get_json_object(sizing, "$.size_user_friendly")
    return F.coalesce(F.when(first != "", first), F.get_json_object(sizing, "$.size"), F.lit(""))


def jsonish(c: Column) -> Column:
    """JSON text for an object written as JSON or as a Python literal; {} for anything else."""
    s = F.trim(F.coalesce(c, F.lit("")))
    python = F.regexp_replace(F.regexp_replace(F.regexp_replace(s, r"\bNone\b", "null"), r"\bTrue\b", "true"), r"\bFalse\b", "false")
    python = F.regexp_replace(python, "'", '"')
    ok = F.when(F.get_json_object(s, "$").isNotNull(), s).when(F.get_json_object(python, "$").isNotNull(), python)
    return F.coalesce(F.when(ok.rlike(r"^[\[{]"), ok), F.lit("{}"))
