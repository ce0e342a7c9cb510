"""The registered queries of this subpackage: thin bindings of the operators
to the given tables, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import pii, toxicity
from .ann import search
from .chunks import without_repeats
from .common import table
from .decontam import contaminated
from .divergence import divergences
from .linkgraph import judge_urls
from .mixing import mix_sources
from .pieces import encode_decode
from .repair import repair
from .simhash import near_duplicates
from .suffixes import without_repeated_strings
from .tokens import count_tokens


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"), ["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, near=20)


def op4_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_runs", "copied_from", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "similarity", "start_word", "n_words")


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find_spans(docs, pii.fit(docs))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: The rules of the url filter.
URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_urls(table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeated_strings(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_token_counts(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return count_tokens(table(spark, sf_dir, "documents"), vocabulary)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergences(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(table(spark, sf_dir, "conversations"))


def op13_piece_round_trip(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    if model is None:
        import public_tokenizers

        model = public_tokenizers.path("piece_bpe_32k.model")
    return encode_decode(table(spark, sf_dir, "documents"), model).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mix_sources": op1_mix_sources,
        "op2_toxicity": op2_toxicity,
        "op3_nearest_neighbours": op3_nearest_neighbours,
        "op4_chunk_dedup": op4_chunk_dedup,
        "op5_decontamination": op5_decontamination,
        "op6_personal_data": op6_personal_data,
        "op7_simhash_near_dedup": op7_simhash_near_dedup,
        "op8_url_filter": op8_url_filter,
        "op9_suffix_dedup": op9_suffix_dedup,
        "op10_token_counts": op10_token_counts,
        "op11_source_divergence": op11_source_divergence,
        "op12_conversation_repair": op12_conversation_repair,
        "op13_piece_round_trip": op13_piece_round_trip,
    }
