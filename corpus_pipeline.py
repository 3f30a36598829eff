"""From raw documents to token files: the stages of a training-data pipeline.

Each stage is one operator of leadloom.llm at work on all documents that the stage before it
kept. Its result is written and read again, so a stage never repeats the work of another and
survives executors that are lost.

A stage passes null and empty texts, repeated rows, further columns and empty tables on as its
operator's docstring says: a null text has no votes against it and scores as an empty text does;
texts without words are near duplicates of each other; they are not contaminated, and are mixed
in as documents of no tokens; their tokens are the end alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leadloom.llm import decontaminate, mixing, quality, simhash, token_files
from leadloom.llm.common import written
from leadloom.llm.queries import MIX_SEED, MIX_WEIGHTS, mix_path, table, tokenizer_path
from leadloom.llm.ship import ship

#: Share of the tokens left after filtering that the mix takes; no document is taken twice.
MIX_BUDGET = 0.8


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return quality.keep_good(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return simhash.drop_near_duplicates(docs, shingle=4, max_bits=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), window=10)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    path = mix_path(docs)
    plan = mixing.mix_plan(docs, path, MIX_WEIGHTS, budget=MIX_BUDGET, max_epochs=1, seed=MIX_SEED)
    return mixing.mixed(docs, path, plan, MIX_SEED).where("copies > 0").select("row.*")


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    folder = token_files.shared_folder(spark, "token-shards")
    shards = token_files.write_tokens(docs, folder, tokenizer_path("byte_bpe_50k.json"), end_id=2)
    return token_files.read_tokens(shards, with_ids=False)


STAGES = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources", mix_sources),
    ("token files", write_tokens),
]

#: The classifier and the fingerprints have no form in SQL; tests/llm compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of the documents that all stages keep."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
