"""Command line: link two catalogs, profile them, compare two sets of matched pairs, look a product up."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .operators import report
from .plans import link
from .sources import catalog, config


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="pairloom", description=__doc__)
    modes = ap.add_subparsers(dest="mode", required=True)
    p = modes.add_parser("link", help="one verdict for each row of the first catalog")
    for name in ("a", "b", "out"):
        p.add_argument(f"--{name}", required=True, type=config.clean_path)
    for name in ("config", "criteria", "lexicon", "facts", "run"):
        p.add_argument(f"--{name}", type=config.clean_path)
    p.add_argument("--rows", type=int, help="link the first so many rows only")
    p = modes.add_parser("profile", help="blank and filled values of a catalog's columns")
    p.add_argument("--a", required=True, type=config.clean_path)
    p = modes.add_parser("compare", help="pairs that two sets of matches share")
    p.add_argument("--left", required=True, type=config.clean_path)
    p.add_argument("--right", required=True, type=config.clean_path)
    p = modes.add_parser("lookup", help="a product by id, or by a part of its name")
    p.add_argument("--a", required=True, type=config.clean_path)
    p.add_argument("--query", required=True)
    o = ap.parse_args(argv)
    spark = SparkSession.builder.appName("pairloom").getOrCreate()
    if o.mode == "link":
        a, b = (catalog.catalog(catalog.read_csv(spark, x)) for x in (o.a, o.b))
        a, b = catalog.keyed(a, "row_key", "item_id"), catalog.keyed(b, "b_index", "item_id")
        if o.rows:
            a = config.first_rows(a, o.rows, "row_key")
        given = {"facts_path": o.facts, "run_path": o.run}
        given |= {"thresholds": config.read_thresholds(spark, o.config)} if o.config else {}
        given |= {"criteria": config.read_criteria(spark, o.criteria)} if o.criteria else {}
        given |= {"lexicon": config.read_lexicon(spark, o.lexicon)} if o.lexicon else {}
        folder = catalog.write_verdicts(link.link(a, b, settings=link.Settings(**given)), o.out)
        done = spark.read.csv(f"{folder}/all_verdicts", header=True)
        config.write_json(report.summary(done), f"{o.out}/run_summary.json")
    elif o.mode == "profile":
        report.profile(catalog.read_csv(spark, o.a), "item_id").show(200, truncate=False)
    elif o.mode == "compare":
        report.pair_diff(catalog.read_pairs(spark, o.left), catalog.read_pairs(spark, o.right)).show(truncate=False)
    else:
        report.lookup(catalog.read_csv(spark, o.a), o.query).show(truncate=80)


if __name__ == "__main__":
    main()
