"""Command-line entry point for the subject-area jobs (use with spark-submit).

    spark-submit run_job.py deaths bronze silver gold \\
        --landing s3a://lake/landing/obitos --warehouse s3a://lake/obitos \\
        --conf spark.hadoop.fs.s3a.endpoint=http://store:9000

Layers run in the order given (default: all of the area's layers). Site settings
(object-store endpoint, credentials provider, ...) are passed as --conf, never written
into code.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from terrace import build_session  # noqa: E402
from terrace.plans import AREAS, Layout  # noqa: E402

LAYERS = {"rail": ["bronze", "silver", "consolidated", "gold"]}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("area", choices=sorted(AREAS))
    parser.add_argument("layers", nargs="*", help="bronze, silver, (consolidated,) gold; default: all")
    parser.add_argument("--landing", required=True)
    parser.add_argument("--warehouse", required=True)
    parser.add_argument("--format", default="parquet", help="table format (parquet, or delta with its jars)")
    parser.add_argument("--time-lookup", choices=["full", "date"], default="full",
                        help="rail gold: match the full time key, or the date only (every time of the day)")
    parser.add_argument("--evidence", action="store_true", help="log schema report and preview of each table")
    parser.add_argument("--conf", action="append", default=[], help="key=value Spark setting")
    args = parser.parse_args(argv)

    conf = dict(item.split("=", 1) for item in args.conf)
    spark = build_session(f"terrace-{args.area}", conf)
    module = AREAS[args.area]
    layers = args.layers or LAYERS.get(args.area, ["bronze", "silver", "gold"])
    if args.evidence:
        import logging
        logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    layout = Layout(args.landing, args.warehouse, args.format, args.evidence)
    for layer in layers:
        step = getattr(module, layer, None)
        if step is None:
            parser.error(f"{args.area} has no layer {layer!r}")
        if args.area == "rail" and layer == "gold":
            step(spark, layout, args.time_lookup)
        else:
            step(spark, layout)


if __name__ == "__main__":
    main()
