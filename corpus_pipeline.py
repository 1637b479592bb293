"""From raw documents to packed sequences, in stages that each read what the one before wrote.

A stage takes (spark, docs, sf_dir). All but the last return the columns of ``docs``, whatever
they are besides doc_id and text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm import minhash_icws, packing, quality_ledger, substring_dedup
from tablesync.llm.words import row_keyed, table, written
from tablesync.operators.columns import quoted


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that fail no rule of the policy."""
    ledger = quality_ledger.apply_policy(quality_ledger.measure(docs, _whole(docs)), "v1")
    return ledger.where("kept").select("document.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies one document, that with the least doc_id.

    Rows that share a doc_id, or have none, are documents of their own (see ``row_keyed``): none goes for another's text.
    """
    rows, _ = row_keyed(spark, docs, _whole(docs))
    classes = minhash_icws.classes(spark, rows.select("id", "text"))
    kept = classes.where("id = class_id").select(F.col("id").alias("kept_id"))
    return rows.join(kept, F.col("id") == F.col("kept_id"), "left_semi").select("document.*")


def _whole(docs: DataFrame) -> Column:
    return F.struct(*[quoted(c) for c in docs.columns]).alias("document")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that occur earlier; ``n_chars`` follows the text."""
    others = [c for c in docs.columns if c != "text"]
    rows, _ = row_keyed(spark, docs, F.struct(*[quoted(c) for c in others]).alias("rest"))
    spans = substring_dedup.repeated_spans(spark, rows.select("id", "text"))
    cut = substring_dedup.cut(rows, spans)
    values = {c: F.col("rest")[c] for c in others} | {"text": F.col("text")}
    if "n_chars" in values:
        values["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return cut.select(*[values[c].alias(c) for c in docs.columns])


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as pieces of token sequences."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    # executors still hold the heap of the stages before: workers remember fewer words, and tokenize some of them again
    return packing.op5_best_fit_packing(spark, docs, path, public_tokenizers.PATTERN, remembered=75_000)


STAGES = [
    ("quality rules", quality_rules),
    ("near copies", near_copies),
    ("repeated passages", repeated_passages),
    ("best-fit packing", best_fit),
]
#: SQL cannot express the sampled near copies and the packing: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again; an empty table gives no rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
