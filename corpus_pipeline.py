"""A corpus from raw documents to shards: each stage is written as Parquet into the shared folder and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from genomill.llm.common import cut, discard, table
from genomill.llm.decontaminate import stage_decontaminate
from genomill.llm.langid import stage_langid
from genomill.llm.mixing import stage_mix
from genomill.llm.near_dedup import stage_minhash
from genomill.llm.sharding import stage_shards

#: Name and function (spark, docs, sf_dir) -> DataFrame, in order.
STAGES = [
    ("language_id", stage_langid),
    ("near_dedup", stage_minhash),
    ("decontaminate", stage_decontaminate),
    ("mix", stage_mix),
    ("shard", stage_shards),
]

#: Language ID, MinHash and the search have no SQL form; tests/llm/test_pipeline.py holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of `documents` that all stages keep, with their shards; each stage is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        before, docs = docs, cut(stage(spark, docs, sf_dir))
        discard(before)
    return docs
