"""From documents to packed sequences: the stages of the corpus pipeline and a function that runs them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from waymark.llm import decontamination, near_dedup, packing, pii, quality_rules
from waymark.llm.shared import read_table, scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and their group's cutoffs.

    Null, empty and very short texts go; texts of any length are measured whole; equal rows are kept or go together; a value
    equal to a cutoff passes; null ids, sources and languages are carried; an empty table stays empty; only COLUMNS are read.
    """
    return quality_rules.keep_good(docs).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near-duplicates and copies, that of the least doc_id.

    Of equal rows one stays; empty texts are copies of each other, null texts of none; texts of any length are compared whole;
    null ids never stand for others, and rows without an id are told apart by their texts; an empty table stays empty; only COLUMNS are read.
    """
    return near_dedup.drop_near_duplicates(docs).select(*COLUMNS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null and empty texts and items hold nothing; texts of any length are read whole; equal rows stay or go together; null ids
    are carried; an empty table, or an empty benchmark, leaves all as it is; only COLUMNS are read.
    """
    return decontamination.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def sanitise_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with personal data and what gives it away replaced in its text.

    A null text stays null, an empty one empty; texts of any length are searched whole; equal rows stay equal; null ids are
    carried; no other column changes; an empty table stays empty; only COLUMNS are read.
    """
    return pii.sanitise(docs).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences of at most 1024 token ids.

    A null or empty text is one id; a text of any length is cut into as many pieces as it needs; equal rows are packed each;
    null ids are carried; an empty table gives no pieces; of COLUMNS only doc_id and text are read.
    """
    from public_tokenizers import path

    return packing.pack(docs, path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", keep_quality),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("pii", sanitise_text),
    ("packing", pack_sequences),
]

#: Tokenising and near-duplicates have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
