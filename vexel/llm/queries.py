"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vexel.llm.align import op11_token_alignment
from vexel.llm.decontaminate import op5_decontamination
from vexel.llm.langid import op9_language_id
from vexel.llm.line_dedup import op2_line_dedup
from vexel.llm.merkle import OP12_SQL, op12_merkle_manifest
from vexel.llm.ngram_join import OP13_SQL, op13_ngram_join
from vexel.llm.packing import conversation_packing, op1_packing
from vexel.llm.quality import ABLATION_SQL, OP8_SQL, op8_quality_rules, quality_ablation
from vexel.llm.secret_scan import op7_secret_scan
from vexel.llm.simhash import op3_simhash
from vexel.llm.token_codes import op10_token_codes
from vexel.llm.toxicity import op4_toxicity
from vexel.llm.warc import OP6_SQL, op6_warc_revisits

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_line_dedup": op2_line_dedup,
    "op3_simhash": op3_simhash,
    "op4_toxicity": op4_toxicity,
    "op5_decontamination": op5_decontamination,
    "op6_warc_revisits": op6_warc_revisits,
    "op7_secret_scan": op7_secret_scan,
    "op8_quality_rules": op8_quality_rules,
    "op9_language_id": op9_language_id,
    "op10_token_codes": op10_token_codes,
    "op11_token_alignment": op11_token_alignment,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_ngram_join": op13_ngram_join,
    "quality_ablation": quality_ablation,
    "conversation_packing": conversation_packing,
}

ORACLES: dict[str, str] = {
    "op6_warc_revisits": OP6_SQL,
    "op8_quality_rules": OP8_SQL,
    "op12_merkle_manifest": OP12_SQL,
    "op13_ngram_join": OP13_SQL,
    "quality_ablation": ABLATION_SQL,
}
