"""Corpus pipeline: classify, apply quality rules, drop near-duplicates, cut repeated passages, pack into sequences.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns the columns of documents; the
last returns the packed pieces. Between stages the rows are written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paymart.llm.common import shared_folder, table
from paymart.llm.cotraining import keep_good
from paymart.llm.line_crf import keep_content
from paymart.llm.packing import op9_best_two_fit
from paymart.llm.prob_minhash import keep_representatives
from paymart.llm.suffix_dedup import remove_repeats
from paymart.llm.token_cache import default_tokenizer


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, table(spark, sf_dir, "labels"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_content(docs, table(spark, sf_dir, "labels"), fit_on=table(spark, sf_dir, "documents"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_representatives(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_repeats(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op9_best_two_fit(docs, default_tokenizer())


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", packing),
]

#: Trained models, suffix arrays and the tokenizer have no SQL. The stages' operators are tested against brute force one by
#: one; of run() as a whole the tests check ids, columns and that every sequence fits.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        folder = shared_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
