"""Corpus pipeline: five stages applied one after another to ``documents``.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet under the shared folder and
read again as the next stage's input. All but the last return the columns of
``documents``; the last returns what was written to the token files.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stratus.llm import decontamination, language_id, lsh_forest, mixing, token_output
from stratus.llm.common import ship, stage, table
from stratus.session import shared_dir


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; those without letters, or in no language clearly, go."""
    ship(spark)
    return language_id.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of smallest id, of each group of near-duplicates."""
    ship(spark)
    return lsh_forest.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is found in the benchmark."""
    return decontamination.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice."""
    ship(spark)
    return mixing.apply_mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as token files, and their index as read back: doc_id, start, n_tokens, ids_crc32."""
    ship(spark)
    path = shared_dir(spark, "pipeline-tokens")
    token_output.write(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_output.read(spark, path)


STAGES = [
    ("language ID", identify_language),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", write_tokens),
]

#: The language model, the draws of the mix and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for _, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), "pipeline")
    return docs
