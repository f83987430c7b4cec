"""Jobs from raw file to result: split, train, score, vote, correlate, profile."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.catalog import KEY, TARGET, ArrayCells, ColumnCatalog
from fieldtally.operators.correlate import corr_matrix_array, corr_target_array
from fieldtally.operators.evaluate import confusion_accuracy, grouped_auc, parse_predictions
from fieldtally.operators.forest import Forest
from fieldtally.operators.gradient_boost import Boosted
from fieldtally.operators.least_squares import load_state, save_state, solve_states, state_of
from fieldtally.operators.moments import load_moments, save_moments
from fieldtally.operators.order import cache_input
from fieldtally.operators.profile import array_state, moments_of, target_profile
from fieldtally.operators.quota import quota_sample
from fieldtally.operators.sampling import (
    BALANCE,
    BALANCE_TWO_THIRDS,
    CORRELATION,
    Rates,
    class_balance,
    nested_sample,
    random_split,
    target_sample,
)
from fieldtally.operators.score import score_test, score_validation
from fieldtally.operators.train import ENSEMBLE, ENSEMBLE_SIZE, deep_forest, fit, fit_ensemble, fit_kind, logistic_l1
from fieldtally.operators.shards import mean_linear_prediction, shard_of
from fieldtally.operators.sketches import category_counts, load_sketches, read_sketches, save_sketches, sketch_cells
from fieldtally.operators.stumps import Stumps
from fieldtally.operators.vote import Vote
from fieldtally.plans.record import RecordPlan, RecordSpec
from fieldtally.session import materialize
from fieldtally.sources.sinks import write_corr_matrix, write_corr_pairs, write_lines, write_submission
from fieldtally.sources.text import cast_row, read_header, read_lines, read_wide, split_cells

# Split weights and seeds.
SPLIT = {"train": 0.8, "validation": 0.2}
SPLIT_SEED = 345
SAMPLE = {"rest": 9.0, "sample": 1.0}
SAMPLE_SEED = 17
# Of a dealt frame: a partition, and what a row takes besides its features and for each of them (index and value).
PARTITION_BYTES = 1 << 27
ROW_BYTES = 128
CELL_BYTES = 12


def open_wide(
    spark: SparkSession,
    path: str,
    spec: RecordSpec | None = None,
    in_order: bool = False,
    needed: Sequence[str] | None = None,
    header: str | None = None,
) -> tuple[DataFrame, RecordPlan]:
    """(raw frame with ``cells``, its plan); cells are cut up to the last one that the plan reads, or up to ``needed``.

    ``header`` is the line of names of a file without one.
    """
    spec = spec or RecordSpec()

    def last(catalog: ColumnCatalog) -> int:
        return RecordPlan(spec, ArrayCells(catalog)).last_position()

    raw, cells = read_wide(spark, path, in_order, last if needed is None else needed, tested=(spec.key, spec.primary, spec.target), header=header)
    return raw, RecordPlan(spec, cells)


def training_frame(raw: DataFrame, plan: RecordPlan, rates: Rates = BALANCE, strict: bool = False) -> DataFrame:
    """Rows to train on, balanced, cleaned: (key, label, features)."""
    rows = class_balance(plan.select_rows(raw, strict), plan.target(), plan.key(), rates, case_sensitive=plan.spec.case_sensitive)
    return plan.transform(rows)


def spread(frame: DataFrame, *key: str, partitions: int | None = None) -> DataFrame:
    """A cleaned frame dealt by key over all cores and cached: a fit reads it many times, and its input may be a single split.

    ``key`` should tell rows apart: all rows of one key are in one partition. The rows are counted first, so that a partition holds
    about ``PARTITION_BYTES`` at most, whatever the number of cores.
    """
    if partitions is None:
        width = frame.schema["features"].metadata.get("ml_attr", {}).get("num_attrs", 1) if "features" in frame.columns else 1
        needed = math.ceil(frame.count() * (ROW_BYTES + CELL_BYTES * width) / PARTITION_BYTES)
        partitions = max(frame.sparkSession.sparkContext.defaultParallelism, needed)
    return cache_input(frame.repartition(partitions, *key))


def train(raw: DataFrame, plan: RecordPlan, estimator: Estimator | None = None, rates: Rates = BALANCE) -> PipelineModel:
    """Filter → balance → clean → fit. The cleaned frame is cached, the raw text is not."""
    frame = spread(training_frame(raw, plan, rates), plan.spec.key)
    try:
        return fit(estimator or logistic_l1(), frame)
    finally:
        frame.unpersist()


def save_model(spark: SparkSession, model: PipelineModel | Vote | Stumps | Forest | Boosted, plan: RecordPlan, path: str) -> None:
    """The model, and beside it the record's spec and column names, for files without a header."""
    if isinstance(model, Stumps):
        model = Vote(["stumps"], [model])
    if isinstance(model, Vote):
        model.save(spark, f"{path}/vote")
    elif isinstance(model, Forest | Boosted):
        model.save(spark, f"{path}/model")
    else:
        model.write().overwrite().save(f"{path}/model")
    names = ",".join(e.name for e in plan.catalog.entries)
    for part, line in (("spec", plan.spec.to_json()), ("header", names)):
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/{part}")


def load_model(spark: SparkSession, path: str, vote: bool = False) -> tuple[PipelineModel | Vote | Stumps | Forest | Boosted, RecordSpec]:
    """The model and its spec; ``vote`` for ensembles and boosted stumps."""
    spec = RecordSpec.from_json(spark.read.text(f"{path}/spec").first()["value"])
    if not vote:
        own = [kind for kind in (Forest, Boosted) if kind.is_saved(spark, f"{path}/model")]
        return own[0].load(spark, f"{path}/model") if own else PipelineModel.load(f"{path}/model"), spec
    model = Vote.load(spark, f"{path}/vote")
    return (model.members[0] if model.names == ["stumps"] else model), spec


def saved_header(spark: SparkSession, path: str) -> str:
    return read_header(spark, f"{path}/header")


def split_part(raw: DataFrame, plan: RecordPlan, part: str) -> DataFrame:
    """``train`` or ``validation`` rows of the fixed split, ``all`` rows otherwise."""
    return raw if part == "all" else random_split(raw, plan.key(), SPLIT, SPLIT_SEED).filter(F.col("split") == part)


def train_job(spark: SparkSession, path: str, model_path: str, spec: RecordSpec | None = None, hold_out: bool = True,
              kind: str = "logistic_l1", overrides: dict | None = None, header: str | None = None) -> None:
    """Train a model of any kind on the 80 % part of a wide file, or all of it, and save it."""
    raw, plan = open_wide(spark, path, spec, header=header)
    frame = spread(training_frame(split_part(raw, plan, "train" if hold_out else "all"), plan), plan.spec.key)
    try:
        save_model(spark, fit_kind(kind, frame, **(overrides or {})), plan, model_path)
    finally:
        frame.unpersist()


def ensemble_job(spark: SparkSession, path: str, model_path: str, kinds: tuple[str, ...] = ENSEMBLE[:ENSEMBLE_SIZE],
                 overrides: dict[str, dict] | None = None, hold_out: bool = False, header: str | None = None) -> None:
    raw, plan = open_wide(spark, path, header=header)
    frame = spread(training_frame(split_part(raw, plan, "train" if hold_out else "all"), plan), plan.spec.key)
    try:
        save_model(spark, fit_ensemble(frame, kinds, overrides), plan, model_path)
    finally:
        frame.unpersist()


def score_job(spark: SparkSession, path: str, model_path: str, result_path: str, vote: bool = False, single_file: bool = False) -> None:
    """Unlabelled file, with a header line or without one → submission in input order.    """
    model, spec = load_model(spark, model_path, vote)
    raw, plan = open_wide(spark, path, spec, in_order=True, header=header_of(spark, path, model_path))
    order = ("_file", "_block", "_row")
    scored = score_test(model, plan.transform(raw, labelled=False, keep=order), spec.key, *order)
    # The sort samples its input before it shuffles: pin the narrow result, so that rows are scored once.
    scored = materialize(scored, "scored")
    write_submission(scored, result_path, order, spec.key, single_file=single_file)


def header_of(spark: SparkSession, path: str, model_path: str) -> str:
    """The file's own header if it begins with one, that is, names the same key; else that of the training file."""
    own, saved = read_header(spark, path), saved_header(spark, model_path)
    spec = RecordSpec.from_json(spark.read.text(f"{model_path}/spec").first()["value"])
    return own if spec.key in own.split(",") else saved


def validation_job(spark: SparkSession, path: str, model_path: str, result_path: str, vote: bool = False, part: str = "all") -> None:
    """Labelled file → ``id,label,prediction,score`` lines; ``part="validation"`` scores only what training held out."""
    model, spec = load_model(spark, model_path, vote)
    raw, plan = open_wide(spark, path, spec, header=header_of(spark, path, model_path))
    scored = score_validation(model, plan.transform(split_part(raw, plan, part)), spec.key)
    write_lines(scored.select(spec.key, "label", "prediction", "score"), result_path)


def accuracy_job(spark: SparkSession, path: str) -> DataFrame:
    """Confusion counts and accuracy of prediction lines; of lines with a score also its exact area under the curve and the variance."""
    rows = parse_predictions(spark.read.text(path))
    area = grouped_auc(rows).select(F.struct("auc", F.sqrt("variance").alias("deviation"))).scalar()
    return confusion_accuracy(rows).withColumns({"auc": area["auc"], "auc_deviation": area["deviation"]})


def sample_job(spark: SparkSession, path: str, out: str, header: str | None = None, rows: int | None = None) -> None:
    """About 1 % of the data lines, or exactly ``rows`` of them, without the header."""
    raw, plan = open_wide(spark, path, needed=[KEY], header=header)
    if rows is None:
        sample = nested_sample(raw, plan.key(), SAMPLE, SAMPLE, (SAMPLE_SEED, f"{SAMPLE_SEED}b"))
    else:
        sample = quota_sample(raw, F.lit("line"), plan.key(), {"line": rows}, SAMPLE_SEED)
    write_lines(sample.select(F.concat_ws(",", "cells")), out)


def profile_job(spark: SparkSession, path: str, header: str | None = None) -> DataFrame:
    raw, plan = open_wide(spark, path, needed=[TARGET], header=header)
    return target_profile(raw, plan.target())


def categories_job(spark: SparkSession, path: str, out: str, part: str = "0", header: str | None = None, limit: int = 100) -> None:
    """Sketches of every raw column of a wide file, and exact counts of the columns with about ``limit`` values or less.

    A further file of the same columns is a further ``part``; ``category_table`` and ``category_totals`` read all parts together.
    """
    raw, layout = read_wide(spark, path, header=header)
    names = [e.unique_name for e in layout.catalog.entries]
    save_sketches(sketch_cells(raw, "cells", len(names)), f"{out}/sketches", part)
    spark.createDataFrame([(",".join(names),)], "value string").coalesce(1).write.mode("overwrite").text(f"{out}/columns")
    own = read_sketches(spark.read.parquet(f"{out}/sketches/part={part}"), names)
    few = sorted(r.pos for r in own.filter(F.col("distinct") <= limit).select("pos").collect())
    # Cells after the last counted one need not be cut.
    narrow, _ = read_wide(spark, path, needed=lambda _: max(few, default=0), header=header)
    counts = category_counts(narrow, "cells", few, [names[p] for p in few])
    counts.write.mode("overwrite").parquet(f"{out}/counts/part={part}")


def category_table(spark: SparkSession, out: str, k: int = 10) -> DataFrame:
    """(pos, name, n, missing, distinct, frequent) over all parts, estimated."""
    return read_sketches(load_sketches(spark, f"{out}/sketches"), read_header(spark, f"{out}/columns").split(","), k)


def category_totals(spark: SparkSession, out: str, limit: int = 100) -> DataFrame:
    """(name, value, rows) over all parts, exactly, of the columns with about ``limit`` values or less in all parts together."""
    few = category_table(spark, out).filter(F.col("distinct") <= limit).select("name")
    counts = spark.read.schema("name string, value string, rows bigint").parquet(f"{out}/counts/part=*")
    return counts.join(F.broadcast(few), "name").groupBy("name", "value").agg(F.sum("rows").alias("rows"))


def moments_job(spark: SparkSession, path: str, state_path: str, part: str = "0", header: str | None = None) -> None:
    """Moments of all features of a wide file, beside those of the label, added to the folder of states."""
    raw, plan = open_wide(spark, path, header=header)
    save_moments(array_state(plan.to_arrays(raw), "values", plan.width, "label"), f"{state_path}/states", part)
    names = ",".join(plan.feature_names)
    spark.createDataFrame([(names,)], "value string").coalesce(1).write.mode("overwrite").text(f"{state_path}/columns")


def moments_table(spark: SparkSession, state_path: str) -> DataFrame:
    """(pos, name, n, mean, variance, r) of each feature over all files in the folder; ``r`` is its correlation with the label."""
    names = read_header(spark, f"{state_path}/columns").split(",")
    found = moments_of(load_moments(spark, f"{state_path}/states"), labelled=True)
    return found.select("pos", F.get(F.array(*[F.lit(n) for n in names]), F.col("pos")).alias("name"), "n", "mean", "variance", "r")


def correlation_job(spark: SparkSession, path: str, matrix_path: str, pairs_path: str | None = None, header: str | None = None,
                    all_columns: bool = False) -> None:
    """Pearson matrix of the cleaned columns of a sampled file, label first; optionally target pairs. ``all_columns`` drops none."""
    spec = RecordSpec(drop_names=(), drop_prefixes=()) if all_columns else None
    raw, plan = open_wide(spark, path, spec, header=header)
    rows = target_sample(plan.select_rows(raw), plan.target(), plan.key(), CORRELATION, case_sensitive=plan.spec.case_sensitive)
    # Written once: the shift is found from a few of the rows, and the sums from all.
    joint = materialize(plan.to_arrays(rows).select(F.concat(F.array("label"), "values").alias("values")), "arrays")
    write_corr_matrix(corr_matrix_array(joint, "values", plan.width + 1), matrix_path)
    if pairs_path:
        write_corr_pairs(species_pairs(raw, plan), pairs_path)


def species_pairs(raw: DataFrame, plan: RecordPlan) -> DataFrame:
    """(name, r): label against every species, in one pass."""
    return species_only(corr_target_array(plan.to_arrays(raw), "label", "values", plan.width), plan)


def species_only(pairs: DataFrame, plan: RecordPlan) -> DataFrame:
    """(name, r) of the species among (pos, r) of all features."""
    names = plan.feature_names
    species = {e.unique_name for e in plan.catalog.species(without=plan.spec.target)}
    wanted = [i for i, n in enumerate(names) if n in species]
    named = F.get(F.array(*[F.lit(n) for n in names]), F.col("pos")).alias("name")
    return pairs.filter(F.col("pos").between(min(wanted), max(wanted))).select(named, "r").filter(F.col("name").isin(species))


def combined_job(spark: SparkSession, path: str, validation_path: str, model_path: str, prediction_path: str,
                 header: str | None = None) -> DataFrame:
    """Split, train a deep forest, score the validation part, report its accuracy."""
    raw, plan = open_wide(spark, path, RecordSpec(fold_year=True), header=header)
    parts = random_split(raw, plan.key(), SPLIT, SPLIT_SEED)
    held = parts.filter(F.col("split") == "validation")
    write_lines(held.select(F.concat_ws(",", "cells").alias("value")), validation_path)
    frame = spread(training_frame(parts.filter(F.col("split") == "train"), plan, BALANCE_TWO_THIRDS, strict=True), plan.spec.key)
    try:
        model = fit(deep_forest(), frame)
    finally:
        frame.unpersist()
    save_model(spark, model, plan, model_path)
    scored = score_validation(model, plan.transform(held), plan.spec.key)
    write_lines(scored.select(plan.spec.key, "label", "prediction", "score"), prediction_path)
    return accuracy_job(spark, prediction_path)


def number_lines(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """Lines of numbers as columns ``value`` (the line) and one for each name; what is no number is null."""
    split = split_cells(read_lines(spark, path).withColumn("line", F.col("value")), line="line")
    return cast_row(split).select("value", *[F.get("numbers", F.lit(i)).alias(n) for i, n in enumerate(names)])


def linear_fit_job(spark: SparkSession, path: str, state_path: str, names: Sequence[str], part: str = "0", shards: int = 4) -> None:
    """Lines of numbers, the last named column the target → the statistics of ``shards`` linear models, added to those in the folder.

    A further file is a further ``part``; the rows of the files before are not read again.
    """
    rows = number_lines(spark, path, names)
    state = state_of(rows, shard_of(F.col("value"), shards), names[:-1], names[-1])
    save_state(state, names[:-1], names[-1], state_path, part)


def linear_predict_job(spark: SparkSession, path: str, state_path: str, out: str) -> None:
    """Lines of numbers, features first → ``line…,prediction``: the mean of the predictions of all shard models."""
    state, features, _ = load_state(spark, state_path)
    models = solve_states(state, len(features) + 1)
    predicted = mean_linear_prediction(number_lines(spark, path, features), models, features)
    write_lines(predicted.select("value", "prediction"), out)
