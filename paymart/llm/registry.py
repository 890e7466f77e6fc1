"""Queries of the training-data operators and, where SQL can express them, their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpus_pipeline import run

from paymart.llm.bpe import op7_bpe
from paymart.llm.common import table
from paymart.llm.cotraining import op10_cotraining
from paymart.llm.count_min_windows import OP12_SQL, op12_count_min_windows
from paymart.llm.line_crf import op5_line_crf
from paymart.llm.merkle import OP13_SQL, op13_merkle_versions
from paymart.llm.packing import op9_best_two_fit
from paymart.llm.prob_minhash import op6_prob_minhash
from paymart.llm.range_coder import op4_range_coder
from paymart.llm.rotated_kmeans import OP11_SQL, op11_rotated_kmeans
from paymart.llm.suffix_dedup import op2_suffix_dedup
from paymart.llm.token_cache import default_tokenizer
from paymart.llm.tool_calls import OP1_SQL, op1_tool_calls
from paymart.llm.warc_zip import OP3_SQL, op3_warc_zip
from paymart.llm.weighted_sampling import op8_weighted_sampling


def load_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_tool_calls": lambda spark, d: op1_tool_calls(table(spark, d, "conversations")),
        "op2_suffix_dedup": lambda spark, d: op2_suffix_dedup(table(spark, d, "documents")),
        "op3_warc_zip": lambda spark, d: op3_warc_zip(table(spark, d, "pages")),
        "op4_range_coder": lambda spark, d: op4_range_coder(table(spark, d, "documents"), default_tokenizer()),
        "op5_line_crf": lambda spark, d: op5_line_crf(table(spark, d, "documents"), table(spark, d, "labels")),
        "op6_prob_minhash": lambda spark, d: op6_prob_minhash(table(spark, d, "documents")),
        "op7_bpe": lambda spark, d: op7_bpe(table(spark, d, "documents"), default_tokenizer()),
        "op8_weighted_sampling": lambda spark, d: op8_weighted_sampling(table(spark, d, "documents")),
        "op9_best_two_fit": lambda spark, d: op9_best_two_fit(table(spark, d, "documents"), default_tokenizer()),
        "op10_cotraining": lambda spark, d: op10_cotraining(table(spark, d, "documents"), table(spark, d, "labels")),
        "op11_rotated_kmeans": lambda spark, d: op11_rotated_kmeans(table(spark, d, "embeddings")),
        "op12_count_min_windows": lambda spark, d: op12_count_min_windows(table(spark, d, "documents")),
        "op13_merkle_versions": lambda spark, d: op13_merkle_versions(table(spark, d, "documents")),
        "pipeline": run,
    }


def load_oracle_sql() -> dict[str, str]:
    return {
        "op1_tool_calls": OP1_SQL,
        "op3_warc_zip": OP3_SQL,
        "op11_rotated_kmeans": OP11_SQL,
        "op12_count_min_windows": OP12_SQL,
        "op13_merkle_versions": OP13_SQL,
    }
