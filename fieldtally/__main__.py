"""Command line: ``python -m fieldtally <job> …`` or through spark-submit."""

from __future__ import annotations

import argparse

from fieldtally.operators.train import ENSEMBLE, ENSEMBLE_SIZE, KINDS
from fieldtally.plans import jobs, store
from fieldtally.session import get_session
from fieldtally.sources.text import count_records, read_header


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="fieldtally")
    top.add_argument("--master", help="only for local runs")
    sub = top.add_subparsers(dest="job", required=True)

    def job(name: str, about: str, *paths: str) -> argparse.ArgumentParser:
        one = sub.add_parser(name, help=about)
        for path in paths:
            one.add_argument(path)
        return one

    job("count", "count the lines of a text or bzip2 file", "input")
    profile = job("profile", "count the target's zeros, ones, missing and other cells", "input")
    sample = job("sample", "write a one per cent sample", "input", "output")
    sample.add_argument("--rows", type=int, help="exactly so many lines instead")
    correlate = job("correlate", "write the correlation matrix and the target's pairs", "input", "matrix", "pairs")
    correlate.add_argument("--all-columns", action="store_true", help="drop no column")
    categories = job("categories", "estimate the values of every column, count those of columns with few", "input", "output")
    categories.add_argument("--limit", type=int, default=100, help="values of a column to be counted exactly")
    moments = job("moments", "add a file's moments of all features to the saved ones", "input", "state")
    for one in (categories, moments):
        one.add_argument("--part", default="0", help="name of this file's share; written again, it is replaced")
    prepare = job("prepare", "cut and clean a file once, for jobs with --prepared", "input", "store")
    train = job("train", "fit and save a model on the training part", "input", "model")
    train.add_argument("--kind", choices=sorted(KINDS), default="logistic_l1")
    train.add_argument("--all-rows", action="store_true", help="hold nothing out")
    ensemble = job("ensemble", "fit and save an ensemble", "input", "model")
    ensemble.add_argument("--members", nargs="+", default=list(ENSEMBLE[:ENSEMBLE_SIZE]))
    ensemble.add_argument("--hold-out", action="store_true", help="train on the training part only")
    for name, about in (("score", "score an unlabelled file in input order"), ("validate", "score a labelled file")):
        scoring = job(name, about, "input", "model", "output")
        scoring.add_argument("--vote", action="store_true", help="the model is an ensemble")
        if name == "score":
            scoring.add_argument("--single-file", action="store_true")
        else:
            scoring.add_argument("--held-out", action="store_true", help="only the rows that training held out")
    job("accuracy", "confusion counts of id,label,prediction lines", "input")
    combined = job("combined", "split, train a forest, score the rest, report", "input", "validation", "model", "predictions")
    linear = job("linear", "add a file of numbers, target last, to the statistics of linear shard models", "input", "state")
    linear.add_argument("names", nargs="+", help="column names, the target last")
    linear.add_argument("--part", default="0", help="name of this file's statistics")
    linear.add_argument("--shards", type=int, default=4)
    job("predict-mean", "mean prediction of the linear shard models for each line", "input", "state", "output")
    for one in (profile, correlate, train):
        one.add_argument("--prepared", action="store_true", help="the input is a prepared store")
    for one in (categories, moments, prepare, profile, sample, correlate, train, ensemble, combined):
        one.add_argument("--header", help="file whose first line has the column names, for an input without them")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = get_session(f"fieldtally {args.job}", args.master)
    header = read_header(spark, args.header) if getattr(args, "header", None) else None
    if getattr(args, "prepared", False):
        match args.job:
            case "profile":
                store.profile_prepared(spark, args.input).show()
            case "correlate":
                store.correlate_prepared(spark, args.input, args.matrix, args.pairs)
            case "train":
                store.train_prepared(spark, args.input, args.model, args.kind, hold_out=not args.all_rows)
        return
    match args.job:
        case "prepare":
            store.prepare_job(spark, args.input, args.store, header=header)
        case "count":
            print(count_records(spark, args.input))
        case "profile":
            jobs.profile_job(spark, args.input, header).show()
        case "categories":
            jobs.categories_job(spark, args.input, args.output, args.part, header, args.limit)
            jobs.category_table(spark, args.output).show(100, truncate=60)
        case "moments":
            jobs.moments_job(spark, args.input, args.state, args.part, header)
            jobs.moments_table(spark, args.state).show(100)
        case "sample":
            jobs.sample_job(spark, args.input, args.output, header, args.rows)
        case "correlate":
            jobs.correlation_job(spark, args.input, args.matrix, args.pairs, header, args.all_columns)
        case "train":
            jobs.train_job(spark, args.input, args.model, hold_out=not args.all_rows, kind=args.kind, header=header)
        case "ensemble":
            jobs.ensemble_job(spark, args.input, args.model, tuple(args.members), hold_out=args.hold_out, header=header)
        case "score":
            jobs.score_job(spark, args.input, args.model, args.output, args.vote, args.single_file)
        case "validate":
            jobs.validation_job(spark, args.input, args.model, args.output, args.vote, "validation" if args.held_out else "all")
        case "accuracy":
            jobs.accuracy_job(spark, args.input).show()
        case "linear":
            jobs.linear_fit_job(spark, args.input, args.state, args.names, args.part, args.shards)
        case "predict-mean":
            jobs.linear_predict_job(spark, args.input, args.state, args.output)
        case "combined":
            jobs.combined_job(spark, args.input, args.validation, args.model, args.predictions, header).show()


if __name__ == "__main__":
    main()
