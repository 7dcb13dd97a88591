"""Command line: validate a feed (V13), run the review job (Q1), load the star
from a folder of NDJSON files (Q2, stream with availableNow).

    python -m stardust.cli [--master local[4]] validate PATH [--limit N] [--strict]
    python -m stardust.cli run SOURCE DESTINATION [--min-stars 4] [--verified]
    python -m stardust.cli load INPUT_GLOB ROOT
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import functions as F


def _validate(args) -> int:
    from .operators import validate as V
    from .plans import reviews as RV
    from .session import get_spark

    spark = get_spark(args.master)
    ann = RV.validated_file(spark, args.path, args.limit).persist()
    totals = V.report_totals(ann).first().asDict()
    totals["corrupt_count"] = ann.where("is_corrupt").count()
    print(json.dumps(totals))
    for r in V.preview_invalid(ann, ["source_file", "review_id", "value"], 20).select(
            "review_id", V.error_text().alias("errors")).collect():
        print(f"  {r['review_id']}: {r['errors']}")
    ann.unpersist()
    return 1 if args.strict and totals["invalid_count"] else 0


def _run(args) -> int:
    from .functions import predicates as P
    from .plans.review_job import run_reviews
    from .session import get_spark

    spark = get_spark(args.master)
    filters = [P.star_between(args.min_stars, 5)]
    if args.verified:
        filters.append(P.verified(True))
    m = run_reviews(spark, args.source, args.destination, filters=filters, quarantine=args.quarantine)
    print(m.select(F.to_json(F.struct("*"))).first()[0])
    return 0


def _load(args) -> int:
    from .session import get_spark
    from .streaming.loader import StarStreamLoader

    spark = get_spark(args.master)
    StarStreamLoader(spark, args.input, root=args.root).run_available()
    return 0


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="stardust")
    ap.add_argument("--master", help="Spark master when not started by spark-submit, such as local[4]")
    sub = ap.add_subparsers(dest="cmd", required=True)
    v = sub.add_parser("validate")
    v.add_argument("path")
    v.add_argument("--limit", type=int, default=0)
    v.add_argument("--strict", action="store_true")
    r = sub.add_parser("run")
    r.add_argument("source")
    r.add_argument("destination")
    r.add_argument("--min-stars", type=int, default=1)
    r.add_argument("--verified", action="store_true")
    r.add_argument("--quarantine")
    lo = sub.add_parser("load")
    lo.add_argument("input")
    lo.add_argument("root")
    args = ap.parse_args(argv)
    return {"validate": _validate, "run": _run, "load": _load}[args.cmd](args)


if __name__ == "__main__":
    sys.exit(main())
