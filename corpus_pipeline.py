"""From raw documents to packed training windows: five stages, each written as Parquet and read again.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; all but the last return the columns of ``documents``. Rows with a null
doc_id cannot be told apart: line dedup and near-dedup leave them as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeloom.llm import language, latent, lines, registry, simhash
from gaugeloom.llm.common import stored, table, text_or_empty

#: A document stays if its language has at least this mean probability.
LEAST_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose words fit no language well, go. Without labelled rows none goes."""
    model = language.train(docs.where(~registry.held_out()))
    if model is None:
        return docs
    told = language.identify(docs, model).where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return told.select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; a document that has only such lines goes as a whole."""
    kept = lines.dedupe_lines(docs).where("doc_id IS NULL OR n_left > 0 OR n_removed = 0")
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row stays: that with the smallest doc_id, of several such that with the smallest hash of its text.

    Rows that share a doc_id but not a text are documents of their own, each judged by its own text.
    """
    keyed = docs.withColumn("text_key", F.xxhash64(text_or_empty()))
    near = simhash.grouped(keyed.where("doc_id IS NOT NULL"), carried=["text_key"])
    first = near.groupBy("root").agg(F.min(F.struct("doc_id", "text_key")).alias("row")).select("row.*")
    kept = keyed.join(first, ["doc_id", "text_key"], "left_semi").dropDuplicates(["doc_id", "text_key"])
    return kept.unionByName(keyed.where("doc_id IS NULL")).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that give away an item of the benchmark go."""
    found = latent.contaminated(docs, table(spark, sf_dir, "benchmark"))
    bad = found.select(F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("no_id"), "text_key").distinct()
    keyed = docs.select(*docs.columns, F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("no_id"), F.xxhash64(text_or_empty()).alias("text_key"))
    return keyed.join(bad, ["id", "no_id", "text_key"], "left_anti").select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 4096 token ids."""
    return registry.packed(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: SQL can express neither the trained model nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
