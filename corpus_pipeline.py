"""The corpus pipeline: toxicity, near duplicates, benchmark passages, mixing, shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
every stage's rows as Parquet to the shared folder and reads them as the next
stage's documents.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventide.llm.scratch import materialize
from eventide.llm.stages import (drop_benchmark_passages, drop_near_duplicates, drop_toxic, mix_sources,
                                 shard_rows)

STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_passages),
    ("mixing", mix_sources),
    ("sharding", shard_rows),
]

#: Trained scores, signatures and seeded choices are not SQL; tests/llm holds
#: a brute-force version of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
