"""The corpus pipeline: five stages, each of which reads what the one before has written.

Language ID drops texts in no language, near-deduplication keeps one document of each group, decontamination
drops documents with benchmark passages, mixing repeats and leaves out documents so that sources meet their
targets, and the token output encodes what is left. Every stage but the last returns the columns of its input.

Defined cases: null and empty texts and those without letters go in the first stage; rows with a null id stay and
are judged like others; of rows that are equal, one is left before the mix, which may repeat it; further columns
are kept, whatever their names, up to the token output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from contrail.llm import decontamination, language, minhash, mixing, token_files
from contrail.llm.common import documents, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.with_known_language(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.deduplicated(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_files.token_table(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language ID", identify_language),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing to target weights", mix_sources),
    ("token-ID binary output", write_tokens),
]
ORACLE_SQL = None  # SQL can express neither the language model nor the tokenizer


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
