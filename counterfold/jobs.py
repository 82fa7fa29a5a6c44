"""Command line: ``estimate DATASET …`` and ``merge PREFIX …``.

    spark-submit -m counterfold.jobs estimate data.parquet --estimands questions.yaml \\
        --estimators wtmle-ose--glm --parquet-output out/run1
    spark-submit -m counterfold.jobs merge out/run --json-output summary
"""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from counterfold.operators.schema import MAX_FINITE_LEVELS
from counterfold.plans.engine import (
    DEFAULT_BATCH,
    DEFAULT_KEY,
    FACTORIAL,
    RELEASE_UNUSABLE,
    Engine,
)
from counterfold.plans.registry import DEFAULT_ESTIMATORS
from counterfold.sinks import Outputs, merge_results


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="counterfold", description="Causal effects on Spark.")
    commands = top.add_subparsers(dest="command", required=True)
    e = commands.add_parser("estimate", aliases=["tmle"], help="answer causal questions")
    e.add_argument("dataset", help="table: .csv, .parquet, or Arrow files")
    e.add_argument("--estimands", default=FACTORIAL, help="factorialATE or a .json/.yaml file")
    e.add_argument(
        "--estimators", default=DEFAULT_ESTIMATORS, help="string, preset name or .json/.yaml file"
    )
    e.add_argument("--verbosity", type=int, default=0)
    e.add_argument("--chunksize", type=int, default=DEFAULT_BATCH, help="questions per batch")
    e.add_argument("--rng", type=int, default=123, help="seed of folds and trees")
    e.add_argument("--cache-strategy", default=RELEASE_UNUSABLE,
                   help="release-unusable, no-cache, or the number of fits to keep")
    e.add_argument("--sort-estimands", action="store_true",
                   help="answer questions that share fits one after the other")
    e.add_argument("--save-sample-ids", action="store_true")
    e.add_argument("--pvalue-threshold", type=float, default=None,
                   help="keep influence values of effects below this p-value")
    e.add_argument("--key", default=DEFAULT_KEY, help="unique row key")
    e.add_argument("--shuffle", action="store_true", help="shuffle rows before folding")
    e.add_argument("--resume", action="store_true", help="go on after the last finished batch")
    e.add_argument("--max-finite-levels", type=int, default=MAX_FINITE_LEVELS,
                   help="a text column with more levels is not finite")
    e.add_argument("--resampling", default="3",
                   help="number of folds or adaptive, then -joint, -outcome or -key")
    e.add_argument("--run-id", default="run")
    m = commands.add_parser("merge", help="put the results of several runs together")
    m.add_argument("prefix", help="prefix of the folders of the runs")
    for p in (e, m):
        p.add_argument("--json-output")
        p.add_argument("--parquet-output")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("counterfold").getOrCreate()
    outputs = Outputs(json=args.json_output, parquet=args.parquet_output)
    if args.command == "merge":
        merge_results(spark, args.prefix, outputs)
        return 0
    if args.verbosity:
        logging.basicConfig(level=logging.INFO)
    engine = Engine(
        args.dataset, args.estimands, args.estimators, spark=spark, key=args.key, seed=args.rng,
        shuffle=args.shuffle, cache=args.cache_strategy, save_sample_ids=args.save_sample_ids,
        pvalue_threshold=args.pvalue_threshold, outputs=outputs, batch_size=args.chunksize,
        sort_estimands=args.sort_estimands, run_id=args.run_id, verbosity=args.verbosity,
        max_finite_levels=args.max_finite_levels, resampling=args.resampling,
    )
    engine(resume=args.resume)
    return 0


if __name__ == "__main__":
    sys.exit(main())
