"""The corpus pipeline: stages over whole documents, each written and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridweave.llm.common import Scratch, table
from gridweave.llm.op1_simhash import deduplicate
from gridweave.llm.op2_decontamination import decontaminate
from gridweave.llm.op3_packing import packing_stage
from gridweave.llm.op6_secrets import redact
from gridweave.llm.op8_quality import keep_good

STAGES = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", deduplicate),
    ("benchmark decontamination", decontaminate),
    ("secret scans", redact),
    ("packing", packing_stage),
]

#: Trained scores, fingerprints, and packing aren't within reach of SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, for the documents of sf_dir."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.keep(docs, "stage")
            scratch.drop(before)
    return docs
