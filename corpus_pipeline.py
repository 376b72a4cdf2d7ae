"""From raw documents to a training mix, in five stages.

Each stage takes what its predecessor kept; between two stages the documents
are written as Parquet and read again, so a lost executor or driver costs one
stage at most.
"""

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm.circulant_minhash import drop_near_duplicates
from ledgerlake.llm.common import scratch_path
from ledgerlake.llm.factor_machine import reject_low_quality
from ledgerlake.llm.source_mix import mix
from ledgerlake.llm.suffix_dedup import drop_repeats
from ledgerlake.llm.winnowing import drop_contaminated

STAGES = [
    ("quality", reject_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", drop_repeats),
    ("decontamination", drop_contaminated),
    ("mix", mix),
]

# A trained classifier and near-duplicate groups can't be put in SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        path = scratch_path(spark, f"pipeline-{k}-{name}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
