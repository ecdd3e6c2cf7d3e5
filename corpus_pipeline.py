"""From raw documents to a training mix: five stages, each written as Parquet and read again as the next one's documents.

1. language_id drops documents in no language that the network knows;
2. near_duplicates keeps one document of each connected group of near copies;
3. decontaminate drops documents that cover items of the benchmark;
4. pii replaces personal data and secrets by tags;
5. mix lays the rest out as a schedule of equal-token blocks that draws sources by their target weights.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chronogeo.llm import decontaminate, jaccard_join, langid, mixing, pii
from chronogeo.llm.common import table
from chronogeo.storage import delete, delete_on_exit, shared_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language_id", langid.stage),
    ("near_duplicates", jaccard_join.stage),
    ("decontaminate", decontaminate.stage),
    ("pii", pii.stage),
    ("mix", mixing.stage),
]

#: SQL can express neither the trained network nor the boosted trees; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Each stage's result goes to a folder of its own in the cluster's shared directory, and is deleted when
    the next one's is written; the last one's is deleted when the driver ends."""
    docs = table(spark, sf_dir, "documents")
    at = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    delete_on_exit(spark, at)
    last = None
    for name, stage in STAGES:
        path = f"{at}/{name}"
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        if last:
            delete(spark, last)
        docs, last = spark.read.parquet(path), path
    return docs
