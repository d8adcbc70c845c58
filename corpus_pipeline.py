"""From raw documents to token ids: five stages, each over all that the one before has kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docharbor.llm.bpe import encode_and_decode
from docharbor.llm.common import pick, stored, table
from docharbor.llm.decontamination import drop_contaminated
from docharbor.llm.jaccard import Join, drop_near_duplicates
from docharbor.llm.lines import drop_lines
from docharbor.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; learnt from this stage's input and the labels."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document has, equal or one character apart, go; short lines stay."""
    return drop_lines(docs, length="n_chars", keep_short=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group stays: shingles of five words, a similarity of 0.8 or more."""
    return drop_near_duplicates(docs, Join(words=5, percent=80))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more lies in windows of the benchmark go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded_sha256`` of every document that is left."""
    out = encode_and_decode(pick(docs, "doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return out.select(
        F.col("_doc._0").alias("doc_id"),
        F.size("ids").cast("bigint").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

#: The learnt scores of the first stage and the ids of the last have no SQL form; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is written before the next one starts."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
