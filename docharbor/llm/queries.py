"""The registered queries, one for each operator, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docharbor.llm.bpe import token_report
from docharbor.llm.common import table
from docharbor.llm.conversations import repair_report
from docharbor.llm.conversations import report_sql as conversations_sql
from docharbor.llm.decontamination import contamination_report
from docharbor.llm.jaccard import Join, component_report
from docharbor.llm.language_model import cross_entropy_difference
from docharbor.llm.lines import line_report
from docharbor.llm.neighbours import nearest
from docharbor.llm.quality import quality_report
from docharbor.llm.quality import report_sql as quality_sql
from docharbor.llm.recompression import substring_report
from docharbor.llm.secrets import report_sql, secret_report
from docharbor.llm.suffixes import passage_report
from docharbor.llm.toxicity import toxicity_report
from docharbor.llm.whitening import whitening_report


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(table(spark, sf_dir, "documents"))


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return component_report(table(spark, sf_dir, "documents"), Join(words=3, percent=90))


def op4_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents"))


def op5_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_entropy_difference(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_report(table(spark, sf_dir, "documents"))


def op7_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_report(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_report(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening_report(table(spark, sf_dir, "embeddings"))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_report(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_secrets": op1_secrets,
    "op2_neighbours": op2_neighbours,
    "op3_jaccard": op3_jaccard,
    "op4_lines": op4_lines,
    "op5_cross_entropy": op5_cross_entropy,
    "op6_suffixes": op6_suffixes,
    "op7_recompression": op7_recompression,
    "op8_toxicity": op8_toxicity,
    "op9_bpe": op9_bpe,
    "op10_decontamination": op10_decontamination,
    "op11_whitening": op11_whitening,
    "op12_quality": op12_quality,
    "op13_conversations": op13_conversations,
}
ORACLE_SQL = {"op1_secrets": report_sql(), "op12_quality": quality_sql(), "op13_conversations": conversations_sql()}
