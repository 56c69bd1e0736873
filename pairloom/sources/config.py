"""Settings and small files: criteria, thresholds and phrase lists from JSON, summaries to JSON, one-time copies of outputs.

Files are read and written through Spark's file systems, so any path that Spark can read will do.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.routing import Thresholds

#: A word in an attribute's criticality, and its weight; the first that is in it counts.
CRITICALITY = (("fatal", 7.0), ("strong", 3.5), ("contextual", 1.5))
OTHER = 2.0
# Names of a configuration's router settings, by threshold; those of a tuple in its order.
ROUTER = {
    "quantity": "min_quantity_similarity", "max_nonmatch": "match_max_nonmatch_confidence", "nonmatch_above": "nonmatch_confidence_above", "raw_below": "nonmatch_raw_below",
    "support_below": "nonmatch_support_below", "functional_below": "nonmatch_functional_below", "review_raw": "review_raw_min review_raw_max", "review_functional": "review_functional_min",
    "review_support": "review_support_min", "same_unknown": "unknown_quantity_min_raw unknown_quantity_min_functional unknown_quantity_min_margin",
    **{lane: " ".join(f"{name}_min_{x}" for x in ("raw", "functional", "support", "margin")) for lane, name in (("same", "same_brand"), ("private", "private"), ("general", "general"))},
}


def clean_path(text: str) -> str:
    """A path as typed: outer blanks and quotes go."""
    return text.strip().strip("'\"").strip()


def read_json(spark: SparkSession, path: str):
    """The value in a JSON file; a byte-order mark is allowed.  The file is a setting, read whole by the driver."""
    return json.loads(spark.read.text(clean_path(path), wholetext=True).first()[0].lstrip("﻿"))


def read_criteria(spark: SparkSession, path: str) -> list[tuple[str, str, float]]:
    """(attribute, group, weight) for scoring.score_pairs, from {"attributes": [{name, group, criticality or weight}]} or the bare list."""
    data = read_json(spark, path)
    out = []
    for x in data["attributes"] if isinstance(data, dict) else data:
        said = str(x.get("criticality") or "").lower()
        out.append((x["name"], x["group"], float(x["weight"]) if "weight" in x else next((w for word, w in CRITICALITY if word in said), OTHER)))
    return out


def read_lexicon(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(attribute, phrase) pairs for facts.extract, from {attribute: [phrase, ...]}."""
    return [(a, p) for a, phrases in read_json(spark, path).items() for p in phrases]


def read_thresholds(spark: SparkSession, path: str) -> Thresholds:
    """Thresholds from a configuration's "router" and "calibration" settings; what isn't named keeps its default."""
    data = read_json(spark, path)
    router, fits, given = data.get("router", {}), data.get("calibration", {}), {}
    for name, keys in ROUTER.items():
        default = getattr(Thresholds(), name)
        olds = default if isinstance(default, tuple) else (default,)
        values = tuple(float(router.get(k, old)) for k, old in zip(keys.split(), olds, strict=True))
        given[name] = values if isinstance(default, tuple) else values[0]
    for side in ("match", "nonmatch"):
        for part in ("coefficient", "intercept"):
            if part in fits.get(side, {}):
                given[f"{side}_{part}"] = float(fits[side][part])
    return Thresholds(**given)


def _files(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A text as one file, which appears whole or not at all."""
    files, target = _files(spark, path)
    fresh = target.suffix(".new")
    out = files.create(fresh, True)
    out.write(bytearray(text.encode()))
    out.close()
    # One step: readers find the old file or the new one.
    kind = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(files.makeQualified(fresh), files.makeQualified(target), how)


def write_json(df: DataFrame, path: str) -> None:
    """The one row of df as a JSON object in one file, which appears whole or not at all."""
    row = df.select(F.to_json(F.struct("*")).alias("j")).first()
    write_text(df.sparkSession, path, row["j"] if row else "{}")


def only_match(spark: SparkSession, pattern: str) -> str:
    """The one path that a glob pattern finds; an error if there are none or several."""
    files, p = _files(spark, pattern)
    found = [str(s.getPath()) for s in files.globStatus(p) or []]
    if len(found) != 1:
        raise ValueError(f"{pattern} finds {len(found)} paths, not one")
    return found[0]


def keep_copy(spark: SparkSession, path: str, name: str = "before") -> str:
    """A copy of a file or folder beside it, made once: a later call leaves the first copy alone.  Its path."""
    files, source = _files(spark, path.rstrip("/"))
    copy = source.suffix(f".{name}")
    if files.exists(source) and not files.exists(copy):
        part = source.suffix(f".{name}.new")
        spark._jvm.org.apache.hadoop.fs.FileUtil.copy(files, source, files, part, False, True, spark._jsc.hadoopConfiguration())
        files.rename(part, copy)
    return str(copy)


def exists(spark: SparkSession, path: str) -> bool:
    files, p = _files(spark, path)
    return files.exists(p)


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first n rows in a named order."""
    return df.orderBy(*order).limit(n)
