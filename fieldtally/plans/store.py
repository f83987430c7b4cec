"""A prepared store: the cleaned record of a wide file written once, read by every later job.

The text is cut and cleaned a single time. Rows are parquet with the key, the raw target and flag cells, the label and the feature array, in
folders by ``bucket``, fifths of the hash that splits training from validation: a job on one part reads that part's folders only, and a
job on the target reads that column only. The record's spec and the file's column names lie beside the rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.catalog import ArrayCells, ColumnCatalog
from fieldtally.functions.cells import hash32
from fieldtally.operators.correlate import corr_matrix_array, corr_target_array
from fieldtally.operators.engineer import LABEL_META, sparse_vector
from fieldtally.operators.profile import target_profile
from fieldtally.operators.sampling import BALANCE, CORRELATION, RANGE, Rates, class_balance, filter_checklist, filter_primary, target_sample
from fieldtally.operators.score import score_validation
from fieldtally.operators.train import fit_kind
from fieldtally.plans import jobs
from fieldtally.plans.record import RecordPlan, RecordSpec
from fieldtally.sources.sinks import write_corr_matrix, write_corr_pairs, write_lines
from fieldtally.sources.text import read_header

BUCKETS = 5  # the first four are the training part of ``jobs.SPLIT``
SCHEMA = "key string, target string, flag string, label double, values array<double>, bucket int"


@dataclass(frozen=True)
class Store:
    rows: DataFrame
    plan: RecordPlan

    def part(self, name: str) -> DataFrame:
        """``train`` or ``validation`` rows of the fixed split, ``all`` rows otherwise."""
        last = BUCKETS - 1
        return {"train": self.rows.filter(F.col("bucket") < last), "validation": self.rows.filter(F.col("bucket") == last)}.get(name, self.rows)

    def vectors(self, rows: DataFrame) -> DataFrame:
        """(key, label, features) under the record's own names."""
        labelled = rows.select(F.col("key").alias(self.plan.spec.key), F.col("label").alias("label", metadata=LABEL_META), "values")
        return sparse_vector(labelled, "values", self.plan.width).drop("values")

    def training_frame(self, part: str = "train", rates: Rates = BALANCE, strict: bool = False) -> DataFrame:
        rows = filter_primary(self.part(part), "flag") if strict else filter_checklist(self.part(part), "flag", "target")
        return self.vectors(class_balance(rows, "target", "key", rates, case_sensitive=self.plan.spec.case_sensitive))


def prepare_job(spark: SparkSession, path: str, store_path: str, spec: RecordSpec | None = None, header: str | None = None) -> None:
    """Read, cut and clean a wide file once."""
    raw, plan = jobs.open_wide(spark, path, spec, header=header)
    flag = plan.cells.cell(plan.spec.primary)
    arrays = plan.to_arrays(raw.withColumns({"_target": plan.target(), "_flag": flag}), keep=("_target", "_flag"))
    key = F.col(plan.spec.key)
    bucket = F.shiftright(hash32(jobs.SPLIT_SEED, key) * BUCKETS, RANGE.bit_length() - 1).cast("int")
    rows = arrays.select(key.alias("key"), F.col("_target").alias("target"), F.col("_flag").alias("flag"), "label", "values", bucket.alias("bucket"))
    rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{store_path}/rows")
    names = ",".join(e.name for e in plan.catalog.entries)
    for part, line in (("spec", plan.spec.to_json()), ("header", names)):
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(f"{store_path}/{part}")


def open_store(spark: SparkSession, store_path: str) -> Store:
    spec = RecordSpec.from_json(spark.read.text(f"{store_path}/spec").first()["value"])
    plan = RecordPlan(spec, ArrayCells(ColumnCatalog.from_header(read_header(spark, f"{store_path}/header"))))
    return Store(spark.read.schema(SCHEMA).parquet(f"{store_path}/rows"), plan)


def profile_prepared(spark: SparkSession, store_path: str) -> DataFrame:
    return target_profile(open_store(spark, store_path).rows, "target")


def train_prepared(spark: SparkSession, store_path: str, model_path: str, kind: str = "logistic_l1", overrides: dict | None = None, hold_out: bool = True) -> None:
    """As ``jobs.train_job``, from the store."""
    store = open_store(spark, store_path)
    frame = jobs.spread(store.training_frame("train" if hold_out else "all"), store.plan.spec.key)
    try:
        jobs.save_model(spark, fit_kind(kind, frame, **(overrides or {})), store.plan, model_path)
    finally:
        frame.unpersist()


def validate_prepared(spark: SparkSession, store_path: str, model_path: str, result_path: str, part: str = "validation", vote: bool = False) -> DataFrame:
    """Score a part of the store, write ``id,label,prediction,score`` lines and report on them. The model must be of the same record."""
    store = open_store(spark, store_path)
    model, spec = jobs.load_model(spark, model_path, vote)
    if spec != store.plan.spec:
        raise ValueError("the model and the store were made with different records")
    scored = score_validation(model, store.vectors(store.part(part)), spec.key)
    write_lines(scored.select(spec.key, "label", "prediction", "score"), result_path)
    return jobs.accuracy_job(spark, result_path)


def correlate_prepared(spark: SparkSession, store_path: str, matrix_path: str, pairs_path: str | None = None) -> None:
    """As ``jobs.correlation_job``, from the store."""
    store = open_store(spark, store_path)
    rows = filter_checklist(store.rows, "flag", "target")
    sample = target_sample(rows, "target", "key", CORRELATION, case_sensitive=store.plan.spec.case_sensitive)
    joint = sample.select(F.concat(F.array("label"), "values").alias("values"))
    write_corr_matrix(corr_matrix_array(joint, "values", store.plan.width + 1), matrix_path)
    if pairs_path:
        pairs = corr_target_array(store.rows, "label", "values", store.plan.width)
        write_corr_pairs(jobs.species_only(pairs, store.plan), pairs_path)
