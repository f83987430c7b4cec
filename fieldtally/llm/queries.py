"""One query for each operator over its whole table, with production parameters, and SQL where it can tell the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import bpe_decode, bpe_encode, token_digests
from .common import table
from .decontaminate import overlaps
from .exact_dedup import exact_dedup
from .fim import FIM_SQL, digests, fill_in_middle, store
from .hard_negatives import HARD_NEGATIVES_SQL, hard_negatives
from .html_text import main_text
from .line_dedup import LINE_DEDUP_SQL, line_dedup, line_report
from .secrets import scan_report, secret_scan
from .ngram_join import ngram_join
from .quality import GRADES, grade, rated, train
from .secrets_sql import SECRETS_SQL
from .substrings import repeated_passages
from .token_counts import token_counts, token_report
from .toxicity import learnable, toxicity

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(line_dedup(table(spark, sf_dir, "documents")))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_report(token_counts(table(spark, sf_dir, "documents"), BYTE_BPE))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_report(secret_scan(table(spark, sf_dir, "documents")))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(bpe_decode(bpe_encode(table(spark, sf_dir, "documents"), BYTE_BPE), BYTE_BPE))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from the label rows that are not held out, and scores all documents."""
    labels = table(spark, sf_dir, "labels").filter(learnable(F.col("doc_id"))).select("doc_id", F.col("toxic").alias("label"))
    found = toxicity(table(spark, sf_dir, "documents"), labels)
    return found.select("doc_id", (~learnable(F.col("doc_id"))).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "evidence")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = grade(docs, train(docs, rated(table(spark, sf_dir, "labels")), GRADES))
    return found.select("doc_id", "expected_grade", F.col("tails")[0].alias("p_fair"), F.col("tails")[1].alias("p_good"), "keep")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(fill_in_middle(store(table(spark, sf_dir, "documents"))))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id = F.col("vec_id")
    rows = table(spark, sf_dir, "embeddings").withColumn("label", F.when(vec_id % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(rows, vec_id % 100 == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_line_dedup, op2_token_counts, op3_secret_scan, op4_bpe, op5_toxicity, op6_substring_dedup, op7_ngram_join, op8_decontamination, op9_quality, op10_exact_dedup, op11_html_text, op12_fill_in_middle, op13_hard_negatives)}


EXACT_DEDUP_SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
WINDOW same AS (PARTITION BY t)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": LINE_DEDUP_SQL, "op3_secret_scan": SECRETS_SQL, "op10_exact_dedup": EXACT_DEDUP_SQL, "op12_fill_in_middle": FIM_SQL, "op13_hard_negatives": HARD_NEGATIVES_SQL}
