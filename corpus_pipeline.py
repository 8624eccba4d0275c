"""A corpus pipeline over ``documents``: each stage works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlake.llm import decontaminate, near_dup, pieces, store, substrings, toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go; null and empty texts, null and repeated ids stay."""
    model = toxicity.learn(toxicity.labelled_sample(docs, store.table(spark, sf_dir, "labels")))
    return toxicity.score_toxicity(docs, model, score="_toxicity").filter("_toxicity < 0.5").select(*COLUMNS)


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 80 percent) stays: the one with the smallest id.

    Rows that repeat an id are one document, of which one row stays, the least by a hash of the row. Rows without
    an id and documents without words stay.
    """
    found = near_dup.near_duplicates(docs, size=5, percent=80)
    copies = store.written(found.filter("not kept").select("doc_id").distinct(), "copies")
    kept = store.semi(docs, copies, "doc_id", "left_anti").select(*COLUMNS)
    twice = store.written(docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "twice")
    if twice.isEmpty():
        return kept
    one = store.semi(kept, twice, "doc_id").groupBy("doc_id").agg(F.min_by(F.struct(*COLUMNS), F.xxhash64(*COLUMNS)).alias("row"))
    return store.semi(kept, twice, "doc_id", "left_anti").select(*COLUMNS).unionByName(one.select("row.*"))


def repeats_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 13 words or more that an earlier document has are cut; all documents stay, with their new lengths.

    White space between kept words stays. Null and empty texts and rows without an id stay as they are.
    """
    cut = substrings.remove_repeats(docs, carry=("lang", "source", "n_chars"), normalise=False)
    length = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    return cut.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", length.alias("n_chars"))


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; rows without an id and texts without words stay."""
    rows = docs.filter("doc_id is not null")
    found = store.written(decontaminate.contaminated(rows, store.table(spark, sf_dir, "benchmark")).select("doc_id"), "contaminated")
    return store.semi(docs, found, "doc_id", "left_anti").select(*COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents with the ids of the pieces, their number and the round-trip check; null texts have null ids."""
    return pieces.encode_pieces(docs.select(*COLUMNS))


STAGES = [
    ("toxicity", toxic_out),
    ("minhash_near_dedup", near_copies_out),
    ("substring_dedup", repeats_out),
    ("decontamination", benchmark_out),
    ("sentencepiece", encoded),
]

#: Learned scores and merges by rank can't be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written, and what it wrote on the way is deleted."""
    docs = store.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with store.scratch(spark) as made:
            docs = store.written(stage(spark, docs, sf_dir), name)
            made.pop()  # the result stays
    return docs
