"""The registered queries of this subpackage, with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from benelake.llm.alignment import align_tokenizers
from benelake.llm.byte_bpe import decode_ids, encode_texts
from benelake.llm.decontaminate import find_contamination
from benelake.llm.fingerprints import compare_edited
from benelake.llm.hard_negatives import mine_hard_negatives
from benelake.llm.html_extract import extract_text
from benelake.llm.jaccard_join import near_duplicate_components
from benelake.llm.language_id import fit_languages, predict_languages
from benelake.llm.oracle import ORACLE_SQL  # noqa: F401  registered with the queries
from benelake.llm.packing import pack_documents
from benelake.llm.quality import fit_quality, score_quality, with_statistics
from benelake.llm.substring_dedup import remove_repeats
from benelake.llm.tables import table, written
from benelake.llm.token_files import read_token_files, write_token_files
from benelake.llm.toxicity import fit_toxicity, score_toxicity


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = remove_repeats(docs, window=13, kept_text=None, kept_sha256="kept_sha256")
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def tokenizer_path(name: str) -> str:
    """Place of a vocabulary file of the public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    packed = pack_documents(docs, tokenizer_path("byte_bpe_50k.json"), end=2, most=1024)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    items = F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", items, "contaminated")


def remainder(column: str, divisor: int) -> Column:
    """crc32 of the id as text modulo ``divisor``; of a null id: -1."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % divisor, F.lit(-1))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    held_out = remainder("doc_id", 5) == 0
    stats = written(with_statistics(docs))  # one pass over the texts
    model = fit_quality(stats.where(~held_out).join(labels, "doc_id"))
    found = score_quality(stats, model)
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicate_components(docs, shingle=3, share=90).select("doc_id", "n_shingles", "component_id")


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edited(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    held_out = remainder("doc_id", 3) == 1
    model = fit_toxicity(docs, labels.where(~held_out))
    found = score_toxicity(docs, model, sentences="offending")
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "offending")


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_text(pages).select("page_id", "url", "text", "n_chars")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder, manifest = write_token_files(docs, tokenizer_path("word_bpe_49k.json"), end=2)
    return read_token_files(spark, folder, manifest)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = remainder("doc_id", 3) == 1
    filters = fit_languages(docs.where(~held_out))
    found = predict_languages(docs.drop("lang"), filters)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(rows, "vec_id", label, "embedding", F.col("vec_id") % 100 == 0)


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = align_tokenizers(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranks = tokenizer_path("byte_bpe_50k.tiktoken")
    encoded = encode_texts(docs, ranks, ends=None, ids_sha256="ids_sha256", keep_text=False)
    decoded = decode_ids(encoded, ranks)
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_document_fingerprints": op6_document_fingerprints,
    "op7_toxicity": op7_toxicity,
    "op8_html_extraction": op8_html_extraction,
    "op9_token_files": op9_token_files,
    "op10_language_id": op10_language_id,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_cross_tokenizer_alignment": op12_cross_tokenizer_alignment,
    "op13_byte_bpe": op13_byte_bpe,
}
