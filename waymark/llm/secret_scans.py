"""Incremental secret scans.

Every historical version of a path is content-addressed. A ledger on shared storage holds, for each blob, the
rule versions it was scanned with and what they found; a run scans only pairs of blob and rule version that the
ledger lacks, and joins findings back to every path and version that has the blob. DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import SPANS, find_spans, scratch_path, text_hash


@dataclass(frozen=True)
class SecretRule:
    """prefilter: a cheap regular expression that every text with a match also matches. least: characters that a match, or its group, has at least."""

    kind: str
    version: int
    pattern: str
    prefilter: str
    group: int = 0
    least: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: In the order of kinds. A run of 32 hex digits is found by its whole length, so that no shorter run is looked at again.
RULES = (
    SecretRule("assign", 1, r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", r"[pPsStTaA](?i:assword|asswd|ecret|oken|pi_?key)", group=1, least=8),
    SecretRule("access", 1, r"AKIA[A-Z0-9]{12,}", r"AKIA"),
    SecretRule("hex", 1, r"[0-9a-f]{32,}", r"[0-9a-f]{32}"),
    SecretRule("pem", 1, r"-----BEGIN (?:[A-Z0-9]+ ){0,3}PRIVATE KEY-----", r"PRIVATE KEY-----"),
    SecretRule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", r"gh[pousr]_"),
    SecretRule("slack", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}", r"xox[abprs]-"),
    SecretRule("jwt", 1, r"eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+", r"eyJ[A-Za-z0-9_-]{10}"),
)

LEDGER = T.StructType([T.StructField("blob_id", T.BinaryType()), T.StructField("rules", T.ArrayType(T.StringType())), T.StructField("spans", SPANS)])


def blob_id(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def rule_spans(text: Column, wanted: Column, rules: tuple[SecretRule, ...]) -> Column:
    """Spans of those rules whose key is in the array wanted, with the key as kind, by start, then in the rules' order."""
    parts = []
    for i, r in enumerate(rules):
        accept = (lambda v, r=r: F.char_length(F.regexp_extract(v, r.pattern, r.group)) >= r.least) if r.least > 1 else None
        parts.append(find_spans(text, r.key, i, r.pattern, F.array_contains(wanted, r.key) & text.rlike(r.prefilter), accept))
    return F.array_sort(F.concat(*parts))


class BlobLedger:
    """A Parquet folder of (blob_id, rules, spans); a blob has a row for each run that scanned it, a span the rule's kind and version as its kind. Reruns of a batch find nothing unseen and add nothing."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        spark.createDataFrame([], LEDGER).write.mode("ignore").parquet(path)

    def rows(self) -> DataFrame:
        return self.spark.read.schema(LEDGER).parquet(self.path)

    def scan(self, versions: DataFrame, rules: tuple[SecretRule, ...] = RULES) -> None:
        """versions: path, version (not null), text. Scans one row for each blob that lacks a rule's version."""
        versions = versions.select("path", "version", F.coalesce("text", F.lit("")).alias("text")).withColumn("blob_id", blob_id(F.col("text")))
        seen = self.rows().groupBy("blob_id").agg(F.flatten(F.collect_list("rules")).alias("seen"))
        one = versions.groupBy("blob_id").agg(F.min(F.struct("path", "version")).alias("at"))
        todo = (
            one.join(seen, "blob_id", "left")
            .select(F.col("blob_id").alias("_blob"), F.col("at.path").alias("_path"), F.col("at.version").alias("_version"), F.array_except(F.array(*[F.lit(r.key) for r in rules]), F.coalesce("seen", F.array().cast("array<string>"))).alias("todo"))
            .where(F.size("todo") > 0)
        )
        same = (F.col("blob_id") == F.col("_blob")) & F.col("path").eqNullSafe(F.col("_path")) & (F.col("version") == F.col("_version"))
        scanned = versions.join(todo, same).select("blob_id", F.col("todo").alias("rules"), rule_spans(F.col("text"), F.col("todo"), rules).alias("spans"))
        once = scanned.groupBy("blob_id").agg(F.max("rules").alias("rules"), F.max("spans").alias("spans"))  # equal rows of one path and version are equal in both
        once.write.mode("append").parquet(self.path)

    def findings(self, versions: DataFrame, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
        """path, version and the spans of the given rules, in these versions, for every row of versions, by start, then in the rules' order."""
        kinds = F.array(*[F.lit(r.key) for r in rules])
        told = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.key), F.struct(F.lit(i).alias("rank"), F.lit(r.kind).alias("kind")))])
        known = self.rows().where(F.arrays_overlap("rules", kinds) & (F.size("spans") > 0)).groupBy("blob_id").agg(F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"))
        ranked = F.array_sort(F.transform(F.filter("spans", lambda s: F.array_contains(kinds, s["kind"])), lambda s: s.withField("rank", told[s["kind"]]["rank"]).withField("kind", told[s["kind"]]["kind"])))
        keyed = versions.select("path", "version", blob_id(F.col("text")).alias("blob_id"))
        return keyed.join(known.select("blob_id", ranked.alias("spans")), "blob_id", "left").withColumn("spans", F.coalesce("spans", F.array().cast(SPANS)))


def scan_documents(docs: DataFrame, ledger_path: str | None = None, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """doc_id, text_hash, spans for every row of docs.

    Null texts are empty and have no spans; texts of any length are scanned whole; spans that begin together stand in the
    rules' order; equal texts are scanned once however often they occur; equal rows get
    equal results; null ids are carried; an empty table gives an empty table; other columns are not read.
    """
    ledger = BlobLedger(docs.sparkSession, ledger_path or scratch_path(docs.sparkSession, "blob-ledger"))
    versions = docs.select(F.col("doc_id").alias("path"), text_hash().alias("version"), F.col("text").cast("string"))
    ledger.scan(versions, rules)
    return ledger.findings(versions, rules).select(F.col("path").alias("doc_id"), F.col("version").alias("text_hash"), "spans")
