"""The registered queries: one per operator, over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .alignment import agreement, align
from .bpe import count_tokens, round_trip
from .decontam import contamination, words_hit
from .exact import DigestIndex
from .html_extract import extract
from .langid import identify
from .neardup import NearDup, near_duplicates
from .secrets import KINDS, secrets
from .sigtree import jaccard_join
from .spelling import spelling_variants
from .store import Store, held_out
from .substring import repeated_spans, without_repeats
from .token_counts import TokenRollup
from .toxicity import score_toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"),
                          Store(spark, "decontam"))
    return found.select("doc_id", "n_words", words_hit().cast("bigint").alias("n_hit"),
                        F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
                        (F.size("windows") > 0).alias("contaminated"))


def op2_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = near_duplicates(_table(spark, sf_dir, "documents"), Store(spark, "neardup"), NearDup(shingle=4))
    return near.select("doc_id", "n_shingles", "component_id", F.expr("doc_id <=> component_id").alias("kept"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return (identify(docs, ~held_out(F.col("doc_id")))
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    kept = without_repeats(docs, repeated_spans(docs, Store(spark, "substring")))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents stand for repositories, their source for the owner."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", F.col("doc_id").alias("repository"),
                                                     F.col("source").alias("owner"))
    found = secrets(docs, Store(spark, "secrets"))
    joined = "concat_ws(',', transform({0}, s -> concat_ws(':', s.kind, s.start, s.end)))"
    return (found.withColumn("base", F.expr("filter(spans, s -> s.kind != 'owned')"))
            .select("doc_id", *[F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}")
                                for k in KINDS],
                    F.sha2(F.expr(joined.format("base")).cast("binary"), 256).alias("base_sha256"),
                    F.expr(joined.format("spans")).alias("spans"),
                    *[F.expr(f"cast(size(filter(spans, s -> s.verdict = '{v}')) as bigint)").alias(f"n_{v}")
                      for v in ("live", "example")]))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch 1 books every document with an estimate of a token per four
    characters, batch 2 revises all of them by the tokenizer's own counts."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    length = F.coalesce(F.char_length("text"), F.lit(0))
    row = ["doc_id", "source", "lang", F.lit("byte_bpe_50k").alias("tokenizer")]
    rollup = TokenRollup(spark, f"token_rollup_{uuid.uuid4().hex}")
    rollup.commit(1, docs.select(F.lit("insert").alias("op"), *row, F.ceil(length / 4).alias("tokens"),
                                 length.alias("chars")))
    counted = count_tokens(docs.withColumn("chars", length), vocabulary())
    rollup.commit(2, counted.select(F.lit("revise").alias("op"), *row, F.col("n_tokens").alias("tokens"), "chars"))
    totals = Store(spark, "rollup").put(rollup.totals(), "totals")
    rollup.drop()  # a one-off run
    return totals.select("source", "lang", "tokenizer", F.col("docs").alias("n_docs"),
                         F.col("tokens").alias("n_tokens"), F.col("chars").alias("n_chars"))


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = extract(_table(spark, sf_dir, "pages"), Store(spark, "html"))
    return texts.withColumn("n_chars", F.char_length("text").cast("bigint"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    scored = score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"),
                            part != 0, part > 2, Store(spark, "toxicity"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Path of an installed public tokenizer file; the same on all executors."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(_table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary())


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Store(spark, "exact")
    index = DigestIndex(spark, f"digest_index_{uuid.uuid4().hex}")
    rows = index.add(_table(spark, sf_dir, "documents"), "documents", store)
    index.drop()  # a one-off run; the result reads what add() has written
    return rows.select("doc_id", "keep_id", "group_size", F.expr("doc_id <=> keep_id").alias("kept"),
                       F.lower(F.hex("digest")).alias("text_sha256"))


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(_table(spark, sf_dir, "documents"), Store(spark, "jaccard"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Store(spark, "alignment")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    aligned = store.put(align(docs, vocabulary(), vocabulary("piece_bpe_32k.model")), "aligned")
    return agreement(aligned, store)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling_variants(_table(spark, sf_dir, "documents"), Store(spark, "spelling"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_minhash_neardup": op2_minhash_neardup,
    "op3_language_id": op3_language_id,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_secrets": op5_secrets,
    "op6_token_counts": op6_token_counts,
    "op7_toxicity": op7_toxicity,
    "op8_bpe": op8_bpe,
    "op9_html_extract": op9_html_extract,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_jaccard_join": op11_jaccard_join,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_spelling_variants": op13_spelling_variants,
}
