"""File-to-file jobs for ``spark-submit``: audit, clean, train, score.

``spark-submit hearthline/jobs.py audit --raw raw/*.csv --out audited`` and so on; the session
settings, ``spark.checkpoint.dir`` among them, come from the submit command.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from hearthline import sources
from hearthline.ml.evaluate import rounded, score
from hearthline.ml.training import FeatureGroups, Trained, load_model, save_model, train
from hearthline.plans import audit, clean, engineer_features, prepare_training
from hearthline.plans.audit import Audit


def audit_job(
    spark: SparkSession,
    raw: str | list[str],
    out: str,
    report: str | None = None,
    fmt: str = "parquet",
    ordered: bool = False,
    multi_line: bool = False,
    date_formats: Sequence[str] = (),
) -> Audit:
    """Raw CSV to audited listings, and the counts of each step if asked for."""
    listings = sources.read_listings_csv(spark, raw, multi_line=multi_line)
    if report:
        listings = sources.stage(listings, "raw")  # the report reads a few columns again
    done = audit(listings, date_formats=date_formats)
    if ordered:
        sources.write_table(done.listings, out, fmt, order_col=done.order_col)
    else:
        sources.write_table(done.listings.drop(done.order_col), out, fmt)
    if report:
        sources.write_table(done.report, report, fmt)
    return done


def clean_job(
    spark: SparkSession,
    audited: str,
    out: str,
    on_bad_date: str = "fail",
    date_formats: Sequence[str] = (),
) -> None:
    """Audited listings to clean listings."""
    listings = sources.read_table(spark, audited)
    sources.write_table(clean(listings, on_bad_date=on_bad_date, date_formats=date_formats), out)


def _lookups(spark: SparkSession, postal: str, communes: str) -> tuple[DataFrame, DataFrame]:
    return sources.read_postal_map(spark, postal), sources.read_commune_stats(spark, communes)


def train_job(
    spark: SparkSession,
    cleaned: str,
    postal: str,
    communes: str,
    out: str | None = None,
    kind: str = "boosted_trees",
    groups: FeatureGroups | None = None,
    **settings,
) -> Trained:
    """Clean listings to a fitted model with its evaluation tables under ``out``."""
    prepared = prepare_training(
        sources.read_table(spark, cleaned), *_lookups(spark, postal, communes)
    )
    done = train(prepared, kind, groups, **settings)
    if out:
        save_model(done.model, f"{out}/model")
        tables = {
            "metrics": rounded(done.metrics),
            "gaps": done.gaps,
            "test_range": done.test_range,
            "worst": done.worst,
        }
        for name, table in tables.items():
            sources.write_table(table, f"{out}/{name}")
    return done


def score_job(
    spark: SparkSession, cleaned: str, postal: str, communes: str, model: str, out: str
) -> None:
    """Clean listings to listings with a predicted price."""
    ready = engineer_features(
        sources.read_table(spark, cleaned), *_lookups(spark, postal, communes)
    )
    scored = score(load_model(model), ready).select(*ready.columns, "predicted")
    sources.write_table(scored, out)


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="hearthline")
    jobs = parser.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("audit")
    job.add_argument("--raw", required=True, nargs="+")
    job.add_argument("--out", required=True)
    job.add_argument("--report")
    job.add_argument("--fmt", choices=("parquet", "csv"), default="parquet")
    job.add_argument("--ordered", action="store_true", help="write rows in input order")
    job.add_argument("--multi-line", action="store_true", help="cells may hold line breaks")
    job.add_argument("--date-format", action="append", default=[], help="beside ISO dates")

    job = jobs.add_parser("clean")
    job.add_argument("--audited", required=True)
    job.add_argument("--out", required=True)
    job.add_argument("--on-bad-date", choices=("fail", "null"), default="fail")
    job.add_argument("--date-format", action="append", default=[], help="beside ISO dates")

    for name in ("train", "score"):
        job = jobs.add_parser(name)
        job.add_argument("--cleaned", required=True)
        job.add_argument("--postal", required=True)
        job.add_argument("--communes", required=True)
        job.add_argument("--out", required=True)
        if name == "train":
            job.add_argument(
                "--kind",
                choices=("linear", "random_forest", "boosted_trees"),
                default="boosted_trees",
            )
        else:
            job.add_argument("--model", required=True)

    a = parser.parse_args(arguments)
    spark = SparkSession.builder.appName(f"hearthline-{a.job}").getOrCreate()
    with sources.scratch(spark):
        if a.job == "audit":
            audit_job(
                spark, a.raw, a.out, a.report, a.fmt, a.ordered, a.multi_line, a.date_format
            )
        elif a.job == "clean":
            clean_job(spark, a.audited, a.out, a.on_bad_date, a.date_format)
        elif a.job == "train":
            train_job(spark, a.cleaned, a.postal, a.communes, a.out, a.kind)
        else:
            score_job(spark, a.cleaned, a.postal, a.communes, a.model, a.out)


if __name__ == "__main__":
    main()
