"""Token counts as delta-maintained rollups.

State is a log of signed changes by source, language and tokenizer version. A batch of inserts, deletes and
revised counts is pre-aggregated to one row per group and committed under its id; a batch id that is committed
already changes nothing, and what a failed attempt left is not read. Totals are sums over committed batches, of which
compaction puts one in place of many.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.batches import folder_of
from ..sources.scratch import delete_folder
from .shared import broadcast_if_small, materialize

KEYS = ["source", "lang", "tokenizer"]
TOTALS = ["n_docs", "n_tokens"]
#: Tokenizer versions that SQL expresses: runs of other than white space; words, and single marks between them.
SQL_TOKENIZERS: dict[str, str] = {"words-1": r"[^\x20\x09-\x0D]+", "marks-1": r"[A-Za-z0-9]+|[^A-Za-z0-9\x20\x09-\x0D]"}


def sql_tokens(text: Column, tokenizer: str) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(SQL_TOKENIZERS[tokenizer])).cast("long")


def bpe_counts(docs: DataFrame, tokenizer_path: str, tokenizer: str) -> DataFrame:
    """doc_id, source, lang, tokenizer, n_tokens by a byte-level BPE tokenizer, in Arrow batches.

    A row for each row of docs. Null and empty texts have no tokens; texts of any length are counted whole; null ids, sources
    and languages are carried; an empty table gives an empty table; columns besides doc_id, text, source and lang are not read.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .packing import byte_bpe

        encode = byte_bpe(tokenizer_path)
        for b in batches:
            n = pa.array([len(encode(t.as_py() or "")) for t in b.column("text")], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("source"), b.column("lang"), n], names=["doc_id", "source", "lang", "n_tokens"])

    told = docs.select("doc_id", "source", "lang", F.col("text").cast("string"))
    kind = told.schema["doc_id"].dataType.simpleString()
    return told.mapInArrow(count, f"doc_id {kind}, source string, lang string, n_tokens long").withColumn("tokenizer", F.lit(tokenizer))


def inserts(counts: DataFrame) -> DataFrame:
    return counts.select(*KEYS, F.lit(1).cast("long").alias("n_docs"), F.col("n_tokens").cast("long").alias("n_tokens"))


def deletes(counts: DataFrame) -> DataFrame:
    return counts.select(*KEYS, F.lit(-1).cast("long").alias("n_docs"), (-F.col("n_tokens")).cast("long").alias("n_tokens"))


def revisions(counts: DataFrame, old: str = "old_tokens") -> DataFrame:
    """Counts that replace the ones in column old; the documents stay."""
    return counts.select(*KEYS, F.lit(0).cast("long").alias("n_docs"), (F.col("n_tokens") - F.col(old)).cast("long").alias("n_tokens"))


class TokenRollup:
    """path/deltas/gen=<n> holds the batches since a compaction, in a folder for each attempt; a folder in path/commits says which attempt counts.

    A batch's id can be any text: folders are named by its digest. What failed attempts leave is never read. A compaction is a batch too,
    with the totals so far; once it counts, its generation is the one that is read, and the folder of the one before is deleted.
    """

    COMMITS = "id string, batch string, gen int"
    SUMS = "source string, lang string, tokenizer string, n_docs long, n_tokens long"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        spark.createDataFrame([], self.COMMITS).write.mode("ignore").parquet(f"{path}/commits/none")

    def committed(self) -> DataFrame:
        return self.spark.read.schema(self.COMMITS).option("recursiveFileLookup", "true").parquet(f"{self.path}/commits")

    def generation(self) -> int:
        return self.committed().agg(F.coalesce(F.max("gen"), F.lit(0))).first()[0]

    def live(self) -> DataFrame:
        """Ids of the batches that totals add up."""
        return self.committed().where(F.col("gen") == self.generation()).select(F.col("id").alias("batch"))

    def _commit(self, batch: str, sums: DataFrame, gen: int) -> bool:
        if self.committed().where(F.col("id") == batch).take(1):
            return False
        attempt = f"{folder_of(batch)}-{uuid.uuid4().hex}"
        sums.write.parquet(f"{self.path}/deltas/gen={gen}/batch={attempt}")
        try:
            self.spark.createDataFrame([(batch, attempt, gen)], self.COMMITS).coalesce(1).write.mode("errorifexists").parquet(f"{self.path}/commits/{folder_of(batch)}")
        except AnalysisException:
            return False
        return True

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """changes: KEYS and signed TOTALS. False if the batch is committed already; nothing is written or counted then. No batch while a compaction runs."""
        sums = changes.groupBy(*KEYS).agg(*[F.sum(F.coalesce(c, F.lit(0).cast("long"))).alias(c) for c in TOTALS])
        return self._commit(batch, sums, self.generation())

    def compact(self, batch: str) -> bool:
        """Puts one batch in place of all before it; their ids stay known, so replaying them still changes nothing."""
        gen = self.generation()
        if not self._commit(batch, self.totals(), gen + 1):
            return False
        delete_folder(self.spark, f"{self.path}/deltas/gen={gen}")
        return True

    def totals(self) -> DataFrame:
        """KEYS and TOTALS over the batches that count, without groups whose totals are all zero."""
        gen = self.generation()
        done = self.committed().where(F.col("gen") == gen).select("batch")
        if not done.take(1):
            return self.spark.createDataFrame([], self.SUMS)
        deltas = self.spark.read.schema(f"{self.SUMS}, batch string").parquet(f"{self.path}/deltas/gen={gen}")
        kept = deltas.join(broadcast_if_small(done), "batch", "left_semi")
        return kept.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in TOTALS]).where((F.col("n_docs") != 0) | (F.col("n_tokens") != 0))


def count_rollup(docs: DataFrame, path: str, tokenizer_path: str, tokenizer: str) -> DataFrame:
    """The totals of one batch, counted by a byte-level BPE tokenizer.

    Odd rows count as bpe_counts() says; equal rows count each; an empty table gives no totals.
    """
    rollup = TokenRollup(docs.sparkSession, path)
    rollup.apply("1-counts", inserts(bpe_counts(docs, tokenizer_path, tokenizer)))
    return rollup.totals()


def sql_counts(docs: DataFrame, tokenizers: list[str]) -> DataFrame:
    """doc_id, KEYS, n_tokens: a row for each row of docs and tokenizer. Null texts count 0; null sources and languages are groups of their own."""
    pairs = F.explode(F.array(*[F.struct(F.lit(t).alias("tokenizer"), sql_tokens(F.col("text"), t).alias("n_tokens")) for t in tokenizers]))
    return docs.select("doc_id", "source", "lang", pairs.alias("c")).select("doc_id", "source", "lang", "c.*")


def maintain(docs: DataFrame, path: str, tokenizers: list[str] | None = None) -> DataFrame:
    """The totals after three batches: estimates from n_chars, counts that revise them, and the deletion of documents without a token.

    A replay of the second batch is refused by its id. Null texts and counts are 0; texts of any length are counted whole; null
    sources and languages are groups of their own; an empty table gives no totals; equal rows count each; columns besides
    doc_id, text, lang, source and n_chars are not read.
    """
    tokenizers = list(tokenizers or SQL_TOKENIZERS)
    rollup = TokenRollup(docs.sparkSession, path)
    estimates = F.explode(F.array(*[F.lit(t) for t in tokenizers])).alias("tokenizer")
    guess = F.coalesce(F.floor(F.col("n_chars") / 4), F.lit(0)).cast("long")
    rollup.apply("1-estimates", inserts(docs.select("source", "lang", estimates, guess.alias("n_tokens"))))
    old = docs.select("doc_id", "source", "lang", "text", guess.alias("old_tokens"))
    pairs = F.explode(F.array(*[F.struct(F.lit(t).alias("tokenizer"), sql_tokens(F.col("text"), t).alias("n_tokens")) for t in tokenizers]))
    revised = materialize(old.select("source", "lang", "old_tokens", pairs.alias("c")).select("source", "lang", "old_tokens", "c.*"), "token-counts")
    gone = revised.where(F.col("n_tokens") == 0)
    rollup.apply("2-counts", revisions(revised))
    rollup.compact("2-compacted")
    rollup.apply("2-counts", revisions(revised))
    rollup.apply("3-blank", deletes(gone))
    return rollup.totals()
