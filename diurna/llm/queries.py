"""The queries opN_<name> and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import UPPER, read
from .decontamination import decontaminate
from .exact_dedup import exact_dedup
from .html_extract import extract
from .jaccard_join import near_duplicates
from .licenses import license_report
from .line_dedup import line_dedup
from .packing import pack
from .quality import classify
from .secrets import secret_report
from .toxicity import toxicity

Query = Callable[[SparkSession, str], DataFrame]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(read(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(read(spark, sf_dir, "documents"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_report(read(spark, sf_dir, "documents"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), tokenizer_path())


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_secret_scan": op3_secret_scan,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_toxicity": op5_toxicity,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_license_scan": op7_license_scan,
    "op8_html_extraction": op8_html_extraction,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
}

ORACLE_SQL: dict[str, str] = {
    "op6_exact_dedup": f"""
        with n as (
            select doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')) as h
            from documents)
        select doc_id,
               max(doc_id) over (partition by h) as keep_id,
               count(*) over (partition by h) as group_size,
               doc_id = max(doc_id) over (partition by h) as kept,
               h as text_sha256
        from n""",
}
