"""Corpus pipeline: quality filter, line dedup, near-duplicate removal, benchmark decontamination, packing.

STAGES holds (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next one's docs. All but the last return the columns of documents.

All stages take nulls in any column, repeated rows, extra columns (which go) and tables without rows, which give none; texts are read whole. What each does with
rows without an id, or that share one, stands in its docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from diurna.llm.common import read, stash
from diurna.llm.decontamination import decontaminate
from diurna.llm.jaccard_join import near_duplicates
from diurna.llm.line_dedup import line_dedup
from diurna.llm.packing import pack
from diurna.llm.quality import LEAST, fit, quality_scores, training_features
from diurna.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text scores 0.5 or more; null counts as empty text. Every row is judged by its own text, whatever its id; with too few labels to fit on all rows stay."""
    positive, unlabelled = training_features(docs, read(spark, sf_dir, "labels"))
    if min(len(positive), len(unlabelled)) < LEAST:
        return docs.select(COLUMNS)
    return quality_scores(docs.select(COLUMNS), fit(positive, unlabelled)).where("score >= 0.5").select(COLUMNS)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without chunks that stand in an earlier document; a document that had text and keeps none of it goes."""
    return line_dedup(docs.select(COLUMNS), keep=["lang", "source"]).where("text <> '' or lines_removed = 0").select("doc_id", "text", "lang", "source", F.char_length("text").cast("long").alias("n_chars"))


def near_duplicate_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one whose id names the group. Rows that share an id stay or go together; rows without an id stay."""
    rows = docs.select(COLUMNS)
    kept = near_duplicates(docs).where("doc_id = class_id").select("doc_id").distinct()
    return rows.join(kept.hint("shuffle_hash"), "doc_id", "left_semi").select(COLUMNS).unionByName(rows.where("doc_id is null"))


def benchmark_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Rows that share an id stay or go together; rows without an id by their text. Null and empty texts hold none; without a benchmark all stay."""
    rows = docs.withColumn("_key", F.coalesce(F.concat(F.lit("i"), F.col("doc_id").cast("string")), F.concat(F.lit("t"), F.col("text")), F.lit("")))
    found = stash(decontaminate(rows, read(spark, sf_dir, "benchmark"), id_col="_key").select("_key").distinct(), "contaminated")
    return rows.join(found.hint("shuffle_hash"), "_key", "left_anti").select(COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in the packed sequences: every row is a document of its own, null and empty texts have the end id alone."""
    return pack(docs, tokenizer_path())


STAGES = [
    ("quality_classifier", quality_filter),
    ("line_dedup", repeated_lines),
    ("ngram_jaccard_join", near_duplicate_removal),
    ("benchmark_decontamination", benchmark_removal),
    ("best_fit_packing", packing),
]

#: SQL can't express the stages; tests/llm/test_pipeline.py compares each with a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stash(docs, name)
    return docs
