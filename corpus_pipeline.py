"""From documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept, and
returns the columns of documents; the last returns packed pieces.  Between stages the
documents are written as Parquet and read again, so a lost executor costs one stage's
tasks and no stage recomputes another.  What a stage wrote goes when the next is written.

Defined cases: null and empty texts are kept by the filtering stages, but near
duplicates of each other, so one of them stays; repeated rows are near duplicates; rows
are told apart by themselves, not by their ids, which may be null or repeat; columns
beyond those of documents stay to the last stage; an empty table gives no piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vexel.llm.common import drop_stage, stage, staged_so_far, sweep
from vexel.llm.decontaminate import decontamination_stage
from vexel.llm.line_dedup import line_dedup_stage
from vexel.llm.packing import packing_stage
from vexel.llm.simhash import simhash_stage
from vexel.llm.toxicity import toxicity_stage

STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("simhash_dedup", simhash_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: No SQL: trained scores, tokenizer ids and a packing heuristic are not expressible.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        mark, before = staged_so_far(), docs
        docs = stage(function(spark, docs, sf_dir), name)
        sweep(spark, mark, keep=docs)
        drop_stage(before)
    return STAGES[-1][1](spark, docs, sf_dir)
