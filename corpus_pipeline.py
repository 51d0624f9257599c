"""From raw documents to packed training sequences: quality rules, line and document dedup, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vesselflow.llm import _common as C
from vesselflow.llm.jaccard import near_duplicate_stage
from vesselflow.llm.line_dedup import line_dedup_stage
from vesselflow.llm.mixing import mix_stage
from vesselflow.llm.packing import packing_stage
from vesselflow.llm.quality import quality_stage

#: Each takes (spark, docs, sf_dir); all but the last return the columns of documents.
STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_dedup_stage),
    ("n-gram jaccard join", near_duplicate_stage),
    ("mixing to weights", mix_stage),
    ("best-fit packing", packing_stage),
]

#: Near-duplicate components, the cube method and packing are no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the whole of documents, each one's result written before the next reads it.

    What a stage leaves behind goes when its result is written, and that when the next one's is.
    """
    docs, before = C.table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        with C.scratch(spark):
            docs = C.stage(stage(spark, docs, sf_dir), keep=True)
        if before is not None:
            C.drop(before)
        before = docs
    return docs
