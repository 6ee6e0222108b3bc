"""A corpus from raw documents to token ids: each stage works on all that the one before it kept.

Every stage is written as Parquet to the shared folder and read again, so a lost executor costs a stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm.bpe import encode_stage
from gridloom.llm.common import stored, table
from gridloom.llm.language import language_stage
from gridloom.llm.mixing import mix_stage
from gridloom.llm.near_dedup import near_dedup_stage
from gridloom.llm.pii import pii_stage

STAGES = [
    ("language_id", language_stage),
    ("near_dedup", near_dedup_stage),
    ("pii", pii_stage),
    ("mixing", mix_stage),
    ("bpe", encode_stage),
]

#: A trained model, alignment and merges are no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
