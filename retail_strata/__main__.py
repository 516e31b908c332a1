"""Command line: run one layer or the whole pipeline for a date."""

from __future__ import annotations

import argparse
import datetime as dt

from retail_strata.plans.pipeline import run_bronze, run_gold, run_pipeline, run_silver
from retail_strata.session import build_session


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="retail_strata")
    parser.add_argument("layer", choices=["bronze", "silver", "gold", "all"])
    parser.add_argument("--landing", help="folder holding raw_<entity>/<yyyymmdd>/*.csv")
    parser.add_argument("--warehouse", required=True, help="folder of the layer tables")
    parser.add_argument("--run-date", type=dt.date.fromisoformat, default=dt.date.today())
    parser.add_argument("--on-missing", choices=["skip", "fail"], default="skip")
    parser.add_argument("--run-id", help="name of the run (default: its time); give that of a run that broke off to go on with it")
    parser.add_argument("--input-gb", type=float, help="size of the input, for shuffle partitions")
    args = parser.parse_args(argv)
    if args.layer in ("bronze", "all") and not args.landing:
        parser.error("--landing is needed to read the raw layer")

    size = None if args.input_gb is None else int(args.input_gb * 1e9)
    spark = build_session(input_bytes=size)
    if args.layer == "bronze":
        run_bronze(
            spark,
            args.landing,
            args.warehouse,
            args.run_date,
            on_missing=args.on_missing,
            run_id=args.run_id,
        )
    elif args.layer == "silver":
        run_silver(spark, args.warehouse, args.run_date, args.on_missing, args.run_id)
    elif args.layer == "gold":
        run_gold(spark, args.warehouse, args.run_date, args.run_id)
    else:
        run_pipeline(
            spark,
            args.landing,
            args.warehouse,
            args.run_date,
            on_missing=args.on_missing,
            run_id=args.run_id,
        )


if __name__ == "__main__":
    main()
