"""Registered queries of the subpackage: ``QUERIES`` and their DuckDB twins ``ORACLES``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.llm import (decisionlist, dialogrepair, jaccardjoin, linededup, merkle, mincut, mixing, packing,
                             sentencespans, toolcalls, topk, vectorgraph, weaklabel)
from corpusforge.llm.common import load, prepare
from corpusforge.llm.oracles import ORACLES

__all__ = ["QUERIES", "ORACLES"]


def op1_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    calls, results = toolcalls.chat_calls(load(spark, sf_dir, "conversations"))
    return toolcalls.link_calls(calls, results, toolcalls.SCHEMAS)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack(load(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return sentencespans.dedup_spans(load(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return jaccardjoin.link_components(load(spark, sf_dir, "documents").select("doc_id", "text"), k=3, percent=90)


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mincut.extract(load(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op6_maxscore_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    vectors = topk.quantise(load(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mixing.mix(docs, F.concat_ws(":", F.col("doc_id").cast("string"), F.xxhash64("text").cast("string")),
                       mixing.word_count(F.col("text")), F.array("source"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


def op8_vector_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return vectorgraph.near_duplicates(load(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return linededup.dedup_lines(load(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return weaklabel.classify(load(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op11_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    judged, _ = decisionlist.judge(load(spark, sf_dir, "documents").select("doc_id", "text"), load(spark, sf_dir, "labels"))
    return judged.select("doc_id", *decisionlist.BASE, "base_failed", "kept")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    proof = F.sha2(F.array_join("proof", ""), 256).alias("proof_sha256")
    return merkle.document_manifest(load(spark, sf_dir, "documents")).select(
        "doc_id", "leaf", "subroot", "root", proof, "folded_root", "verified")


def op13_dialog_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return dialogrepair.repair_report(load(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_tool_calls, op2_packing, op3_sentence_spans, op4_jaccard_join, op5_main_text, op6_maxscore_topk, op7_mixing,
    op8_vector_graph, op9_line_dedup, op10_quality, op11_decision_list, op12_merkle_manifest, op13_dialog_repair)}
