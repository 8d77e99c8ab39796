"""Queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidegrid.llm import embeddings, lm, mixing, packing, passages, simhash, spotsigs, toxicity, urls, warc
from tidegrid.llm.common import table, written


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written(mixing.sized(table(spark, sf_dir, "documents")))
    return mixing.plan(rows).select("doc_id", "size", "source_size", "target", "taken", "source")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embeddings": embeddings.op1_embeddings,
    "op2_spotsigs": spotsigs.op2_spotsigs,
    "op3_simhash": op3_simhash,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_mixing": op5_mixing,
    "op6_cross_entropy": lm.op6_cross_entropy,
    "op7_chains": passages.op7_chains,
    "op8_packing": op8_packing,
    "op9_warc": warc.op9_warc,
    "op10_link_graph": urls.op10_link_graph,
}
ORACLES: dict[str, str] = {"op1_embeddings": embeddings.OP1_SQL, "op9_warc": warc.OP9_SQL}
