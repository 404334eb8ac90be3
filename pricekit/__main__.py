"""Run one job from a JSON config.

``python -m pricekit <job> <config.json> [--as-of DATE] [--run-id ID]``, or
``spark-submit --py-files pricekit.zip pricekit/__main__.py <job> <config.json>``.

The session comes from the submitting environment (cluster master,
``spark.checkpoint.dir`` etc.); only gaps are filled by library defaults.
"""

from __future__ import annotations

import argparse
import logging
import sys

from pricekit.plans import cluster, cost, geo, ground_truth, rates
from pricekit.session import get_session
from pricekit.sources.config import load_config

JOBS = ("cost", "cluster", "rates", "geo", "ground_truth")


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="pricekit")
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("config")
    parser.add_argument("--as-of", default=None, help="cost job: effective-before date (default today)")
    parser.add_argument("--format", default="parquet", help="table format of the outputs")
    parser.add_argument("--run-id", default=None, help="ground_truth job: a run tried again under its id logs once")
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    log = logging.getLogger("pricekit")

    config = load_config(args.config)
    rules = [tuple(r) for r in config.get("rules", [])]
    spark = get_session(app_name=f"pricekit-{args.job}")
    if args.job == "cost":
        out = cost.run(spark, config, as_of=args.as_of, fmt=args.format, rules=rules)
        log.info("cost: %s", "no new data, nothing written" if out is None else "written")
    elif args.job == "cluster":
        cluster.run(spark, config, fmt=args.format, rules=rules)
    elif args.job == "rates":
        rates.run(spark, config, fmt=args.format, rules=rules)
    elif args.job == "geo":
        geo.run(spark, config, fmt=args.format, rules=rules)
    else:
        status = ground_truth.run(spark, config, rules, fmt=args.format, run_id=args.run_id)
        log.info("ground truth QC status: %s", status)
    return 0


if __name__ == "__main__":
    sys.exit(main())
