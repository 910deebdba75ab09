"""The subpackage's queries: each operator over its whole table with production parameters."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from lansight.llm.chat_format import op3_chat_format
from lansight.llm.common import table
from lansight.llm.line_dedup import op4_line_dedup
from lansight.llm.mixing import op2_mixing
from lansight.llm.near_dedup import op5_near_dedup
from lansight.llm.periodic_runs import op13_periodic_runs
from lansight.llm.pii import op6_pii
from lansight.llm.prefix_trie import op11_prefix_trie
from lansight.llm.quality_crf import op10_quality_crf
from lansight.llm.quality_rules import op9_quality_rules
from lansight.llm.sentencepiece_codec import op8_sentencepiece
from lansight.llm.sharding import op12_sharding
from lansight.llm.topk_search import op1_topk_search
from lansight.llm.toxicity import op7_toxicity

QueryFn = Callable[[SparkSession, str], DataFrame]


def _on(name: str, op: Callable[[DataFrame], DataFrame]) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return op(table(spark, sf_dir, name))
    return run


def _labelled(op: Callable[[DataFrame, DataFrame], DataFrame]) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return op(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return run


LLM_QUERIES: dict[str, QueryFn] = {
    "op1_topk_search": _on("documents", op1_topk_search),
    "op2_mixing": _on("documents", op2_mixing),
    "op3_chat_format": _on("conversations", op3_chat_format),
    "op4_line_dedup": _on("documents", op4_line_dedup),
    "op5_near_dedup": _on("documents", op5_near_dedup),
    "op6_pii": _on("documents", op6_pii),
    "op7_toxicity": _labelled(op7_toxicity),
    "op8_sentencepiece": _on("documents", op8_sentencepiece),
    "op9_quality_rules": _on("documents", op9_quality_rules),
    "op10_quality_crf": _labelled(op10_quality_crf),
    "op11_prefix_trie": _on("conversations", op11_prefix_trie),
    "op12_sharding": _on("documents", op12_sharding),
    "op13_periodic_runs": _on("documents", op13_periodic_runs),
}
