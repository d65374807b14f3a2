"""A training-corpus pipeline over ``documents``, stage by stage.

Each stage takes what the one before it kept, decides on all of it, and
returns the kept rows with the columns of ``documents``; the last returns the
encoded corpus. ``run`` writes every stage's result as Parquet in the shared
folder and reads it back for the next.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from idbridge.llm.bpe import round_trip
from idbridge.llm.decontam import contamination
from idbridge.llm.exact import DigestIndex
from idbridge.llm.langid import UND, identify
from idbridge.llm.neardup import near_duplicates
from idbridge.llm.queries import vocabulary
from idbridge.llm.store import Store, held_out


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents without a letter and gives those without ``lang``
    the predicted one. Where no label teaches anything, all texts with a letter
    stay, without ``lang``."""
    found = identify(docs, ~held_out(F.col("doc_id")))
    told = F.col("lang_pred") != UND
    kept = found.where(told | F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    lang = F.coalesce(F.col("lang").cast("string"), F.when(told, F.col("lang_pred"))).alias("lang")
    return kept.select(*[lang if c == "lang" else F.col(f"`{c}`") for c in docs.columns])


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row with the smallest doc_id of each text."""
    index = DigestIndex(spark, f"digest_index_{uuid.uuid4().hex}")
    kept = index.keep_new(docs, "documents", Store(spark, "exact"))
    index.drop()
    return kept


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group (five-word
    shingles, similarity of 0.8 or more). Rows without doc_id stay."""
    store = Store(spark, "neardup")
    near = near_duplicates(docs.select("doc_id", "text"), store)
    gone = near.where("not (doc_id <=> component_id)").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold ten words in a row of a benchmark item
    (or the whole of a shorter item)."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = contamination(docs, items, Store(spark, "decontam"))
    hit = found.where(F.size("windows") > 0).select("doc_id").distinct()
    return docs.join(hit, "doc_id", "left_anti").select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The corpus as byte-level BPE ids, with digests of the ids and of the
    text decoded from them."""
    return round_trip(docs.drop("ids"), vocabulary(), with_ids=True)


STAGES = [("language", language), ("exact dedup", exact_dedup), ("near dedup", near_dedup),
          ("decontaminate", decontaminate), ("tokens", tokens)]

ORACLE_SQL = None  # language, MinHash and BPE are beyond SQL; tests hold run() against plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Store(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = store.put(docs, "stage")
    return docs
