"""Command line: ``python -m duewatch backfill|train|score|evaluate|monitor``."""

from __future__ import annotations

import argparse
import datetime

from duewatch.operators.labelled import training_set
from duewatch.operators.learning import DEFAULT_TREES
from duewatch.plans import monitoring, scoring, tables, training
from duewatch.session import build_session
from duewatch.sources.snapshots import read_snapshots


def options() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="duewatch", description="Loan-default tables, model, scores and monitoring.")
    parser.add_argument("--root", default="datamart", help="folder of all written tables")
    parser.add_argument("--master", help="Spark master when not given by spark-submit")
    jobs = parser.add_subparsers(dest="job", required=True)

    def months(job: argparse.ArgumentParser) -> None:
        job.add_argument("--first", required=True, help="first snapshot month, YYYY-MM-DD")
        job.add_argument("--last", required=True, help="last snapshot month, YYYY-MM-DD")

    backfill = jobs.add_parser("backfill", help="raw CSV files to all tables")
    backfill.add_argument("--raw", default="data", help="folder of the four CSV files")
    backfill.add_argument("--lookback", type=int, default=tables.LAG_MONTHS, help="months of features before the first")
    months(backfill)

    train = jobs.add_parser("train", help="two-stage training on the split calendar")
    train.add_argument("--run-id", help="name of the run; the time when left out")
    train.add_argument("--initial-trials", type=int, default=training.DEFAULT_TRIALS)
    train.add_argument("--refine-trials", type=int, default=training.DEFAULT_TRIALS)
    train.add_argument("--folds", type=int, default=training.DEFAULT_FOLDS)
    train.add_argument("--trees", type=int, default=DEFAULT_TREES)

    score = jobs.add_parser("score", help="score months with the newest or the named run")
    score.add_argument("--run-id")
    score.add_argument("--threshold", type=float, default=0.5)
    months(score)

    evaluate = jobs.add_parser("evaluate", help="join scores with labels and record the AUC per month")
    evaluate.add_argument("--dpd", type=int, default=tables.DPD)
    evaluate.add_argument("--mob", type=int, default=tables.MOB)
    months(evaluate)

    monitor = jobs.add_parser("monitor", help="drift, AUC and alerts; exit code 1 when there is something to send")
    monitor.add_argument("--run-id")
    months(monitor)
    return parser


def earlier_month(month: str, count: int) -> str:
    day = datetime.date.fromisoformat(month)
    place = day.year * 12 + day.month - 1 - count
    return datetime.date(place // 12, place % 12 + 1, 1).isoformat()


def main(arguments: list[str] | None = None) -> int:
    args = options().parse_args(arguments)
    spark = build_session(f"duewatch {args.job}", args.master)
    if args.job == "backfill":
        raw = tables.RawTables.from_csv(spark, args.raw)
        tables.backfill(raw, args.root, earlier_month(args.first, args.lookback), args.last)
    elif args.job == "train":
        labels = read_snapshots(spark, f"{args.root}/gold/label_store")
        store = read_snapshots(spark, f"{args.root}/gold/feature_store_full")
        run = training.two_stage_training(
            training_set(labels, store), initial_trials=args.initial_trials, refine_trials=args.refine_trials,
            folds=args.folds, trees=args.trees,
        )
        now = datetime.datetime.now()
        training.save_run(spark, run, args.root, args.run_id or now.strftime("%Y%m%d_%H%M%S"), now)
    elif args.job == "score":
        scoring.score_and_write(spark, args.root, args.first, args.last, args.run_id, args.threshold)
    elif args.job == "evaluate":
        scoring.evaluate_and_write(spark, args.root, args.first, args.last, args.dpd, args.mob)
    else:
        return int(monitoring.monitor_and_write(spark, args.root, args.first, args.last, args.run_id))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
