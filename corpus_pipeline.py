"""The corpus pipeline: toxic documents go, one document of each group of near
copies stays, long repeated passages are cut, documents with benchmark text go,
and what is left is packed into sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one
before kept; all but the last return the columns of ``documents``. Other
columns are carried, rows without an id are kept unless a stage's own finding
rejects them, and an empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from benelake.llm.decontaminate import find_contamination
from benelake.llm.jaccard_join import near_duplicate_components
from benelake.llm.packing import pack_documents
from benelake.llm.queries import tokenizer_path
from benelake.llm.substring_dedup import remove_repeats
from benelake.llm.tables import free_name, table, written
from benelake.llm.toxicity import fit_toxicity, score_toxicity

TOXIC = 0.7  # score from which a document goes
SHINGLE, SIMILAR = 5, 80  # words; least Jaccard similarity in percent
PASSAGE = 50  # words of the shortest passage that counts as repeated
SEQUENCE = 1024  # tokens


def _beside(docs: DataFrame, results: str) -> tuple[DataFrame, list[Column]]:
    """``docs`` with columns that are named like one of an operator's
    ``results`` set aside, and what gives the columns of ``docs`` back."""
    aside = {c: free_name(docs, f"own_{c}") for c in docs.columns if c.lower() in results.split()}
    return docs.withColumnsRenamed(aside), [F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that score ``TOXIC`` or more, by a model of all
    labelled documents."""
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs, "toxic_score")
    scored = score_toxicity(docs, model, score=score, sentences=None)
    return scored.where(F.col(score) < TOXIC).select([f"`{c}`" for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep of each group of near copies the document with the smallest id. A
    document without words, or without an id, is a group of its own. Of an id
    with several texts each is a document: it goes only for a text like its own."""
    docs, columns = _beside(docs, "n_shingles component_id")
    repeated = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count()
    if repeated:
        return _near_duplicates_of_rows(docs).select(columns)
    found = near_duplicate_components(docs, shingle=SHINGLE, share=SIMILAR)
    return found.where(F.col("component_id").isNull() | (F.col("component_id") == F.col("doc_id"))).select(columns)


def _near_duplicates_of_rows(docs: DataFrame) -> DataFrame:
    """``near_duplicates`` where ids repeat: rows are linked under numbers of
    their own; of a group the row stays that is first by id, text and the rest."""
    row = free_name(docs, "row_number")
    numbered = written(docs.withColumn(row, F.when(F.col("doc_id").isNotNull(), F.monotonically_increasing_id())))
    found = written(near_duplicate_components(numbered, id_column=row, shingle=SHINGLE, share=SIMILAR))
    with_id = found.where(F.col(row).isNotNull())
    group = [F.when(F.col("n_shingles") > 0, F.col("component_id")).alias("g"), F.when(F.col("n_shingles") == 0, F.struct("doc_id", "text")).alias("same")]
    first = F.min(F.struct("doc_id", F.sha2("text", 256).alias("t"), F.xxhash64(*docs.columns).alias("h"), F.col(row).alias("row"))).alias("first")
    kept = with_id.groupBy(*group).agg(first).select(F.col("first.row").alias("kept_row"))
    return found.where(F.col(row).isNull()).select(docs.columns).unionByName(with_id.join(kept, F.col(row) == F.col("kept_row"), "left_semi").select(docs.columns))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of ``PASSAGE`` words or more that a document with a smaller
    id holds too. Other texts stay as they are; a document of which nothing is
    left goes."""
    beside, columns = _beside(docs, "n_words n_removed kept_text")
    found = remove_repeats(beside, window=PASSAGE, kept_text="kept_text")
    cut = F.col("n_removed") > 0
    new = {"text": F.when(cut, F.col("kept_text")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(cut, F.char_length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    left = found.where(~cut | (F.col("n_removed") < F.col("n_words")))
    return left.select(*[new[c].alias(c) if c in new else own for c, own in zip(docs.columns, columns, strict=True)])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold text of a benchmark item."""
    docs, columns = _beside(docs, "n_words hit_spans n_hit item_ids n_items contaminated")
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.where(~F.col("contaminated")).select(columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenise and pack: a row for each piece with its sequence and offset."""
    return pack_documents(docs, tokenizer_path("byte_bpe_50k.json"), end=2, most=SEQUENCE)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Models and exact set joins are not stated in SQL; tests compare each stage
#: with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is written as
    Parquet in the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
