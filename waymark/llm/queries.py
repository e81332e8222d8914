"""The registered queries of this subpackage and the SQL that some of them are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, kneser_ney, license_scans, lm_scoring, merkle, mixing, near_dedup, packing, pii, quality_rules, secret_scans, token_counts, whitening
from .shared import count_kind, read_table, scratch_path, span_text


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.quality_verdicts(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", *quality_rules.BASE, "base_failed", "kept", "failed_rules")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(read_table(spark, sf_dir, "documents"))


def digest(found: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """doc_id, a count for each base kind, base_sha256, spans."""
    base = F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return found.select("doc_id", *[count_kind(F.col("spans"), k).alias(f"n_{k}") for k in kinds], F.sha2(span_text(base).cast("binary"), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(secret_scans.scan_documents(read_table(spark, sf_dir, "documents")), ("assign", "access", "hex"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    return packing.pack(read_table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(pii.find_personal_data(read_table(spark, sf_dir, "documents")), pii.KINDS)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("text_hash")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = kneser_ney.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return out.drop("text_hash")


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents")).drop("text_hash")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.maintain(read_table(spark, sf_dir, "documents"), scratch_path(spark, "token-rollup"))


def token_counts_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rollup over a real tokenizer, which SQL does not express."""
    from public_tokenizers import path

    return token_counts.count_rollup(read_table(spark, sf_dir, "documents"), scratch_path(spark, "token-rollup"), path("byte_bpe_50k.json"), "byte-bpe-50k")


def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = license_scans.scan_licences(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_sentences", F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licences", ",").alias("licences"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whiten(read_table(spark, sf_dir, "embeddings"))
    pairs = F.posexplode(F.arrays_zip("whitened", "explained")).alias("i", "c")
    return out.select("vec_id", "n", "deviation", "identity_error", pairs).select("vec_id", (F.col("i") + 1).alias("component"), "n", "deviation", "c.whitened", "c.explained", "identity_error")


def op12_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.planned(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "mix.size", "mix.source_size", "mix.target", (F.col("mix.size") * F.col("mix.copies")).alias("taken"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest, held against documents some of which have lost their newlines."""
    told = merkle.manifest(read_table(spark, sf_dir, "documents"), now=merkle.without_newlines())
    return merkle.verified(told, "now").select("doc_id", "leaf", "subroot", "root", merkle.sha256(merkle.proof(F.col("path"))).alias("proof_sha256"), "folded_root", "verified")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality_rules, op2_lm_scoring, op3_secret_scans, op4_packing, op5_pii, op6_decontamination, op7_quality_classifier, op8_near_dedup, op9_token_counts, op10_license_scans, op11_embedding_whitening, op12_source_mixing, op13_merkle_manifest, token_counts_bpe)}


#: op12: sources in order of what they may take over their weight, and the first whose share does not pass its bound.
MIX_SQL = r"""WITH t AS (SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM t GROUP BY source),
w AS (SELECT *, 2 * source_size::DOUBLE AS bound, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END::DOUBLE AS weight FROM s),
l AS (SELECT *, bound / weight AS ratio, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(bound) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level FROM w WINDOW before AS (ORDER BY bound / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT level FROM l WHERE ratio >= level ORDER BY ratio, source NULLS LAST LIMIT 1),
g AS (SELECT source, source_size, least(bound, coalesce((SELECT level FROM f) * weight, bound)) AS target FROM l),
r AS (SELECT t.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate, ('0x' || md5('mix:' || coalesce(doc_id::VARCHAR, '-') || ':' || md5(coalesce(text, '')))[1:13])::BIGINT / 4503599627370496::DOUBLE AS draw FROM t JOIN g ON t.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, (size * (floor(rate)::BIGINT + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken FROM r"""
#: op13: levels of nodes by recursion, first of each source's leaves, then of the subroots; a CRC-32 bit by bit.
CRC_SQL = "list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)"
UP_SQL = "SELECT level + 1, grp, idx // 3, (n + 2) // 3, sha256(string_agg(hash, '' ORDER BY idx)) FROM {0} WHERE n > 1 GROUP BY level, grp, idx // 3, n"
STEPS_SQL = "SELECT l.grp, l.idx, p.level, p.pre[1:64 * ((l.idx // pow(3, p.level)::BIGINT) % 3)] AS before, p.pre[64 * ((l.idx // pow(3, p.level)::BIGINT) % 3) + 65:] AS after FROM {0} l JOIN (SELECT grp, level, idx // 3 AS parent, string_agg(hash, '' ORDER BY idx) AS pre FROM {0} WHERE n > 1 GROUP BY grp, level, idx // 3) p ON l.level = 0 AND l.grp = p.grp AND p.parent = l.idx // pow(3, p.level + 1)::BIGINT"


def merkle_sql() -> str:
    field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"
    leaf = lambda text: f"sha256({' || '.join(field(text if c == 'text' else c) for c in merkle.FIELDS)})"
    return rf"""WITH RECURSIVE t AS (SELECT doc_id, source, {leaf('text')} AS leaf, CASE WHEN {CRC_SQL} & 1 = 1 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf('text')} END AS now FROM documents),
d AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS grp FROM t),
own AS (SELECT 0 AS level, grp, idx, n, leaf AS hash FROM d UNION ALL {UP_SQL.format('own')}),
subroots AS (SELECT grp, hash AS subroot FROM own WHERE n = 1),
up AS (SELECT 0 AS level, 0::BIGINT AS grp, grp AS idx, count(*) OVER () AS n, subroot AS hash FROM subroots UNION ALL {UP_SQL.format('up')}),
steps AS (SELECT grp, idx, 0 AS part, level, before, after FROM ({STEPS_SQL.format('own')}) UNION ALL SELECT d.grp, d.idx, 1, u.level, u.before, u.after FROM d JOIN ({STEPS_SQL.format('up')}) u ON u.idx = d.grp),
paths AS (SELECT grp, idx, string_agg(before || after, '' ORDER BY part, level) AS proof, list(before || '|' || after ORDER BY part, level) AS path FROM steps GROUP BY grp, idx),
f AS (SELECT d.*, sha256(coalesce(proof, '')) AS proof_sha256, list_reduce(list_concat([now], coalesce(path, [])), lambda h, s: sha256(split_part(s, '|', 1) || h || split_part(s, '|', 2))) AS folded_root FROM d LEFT JOIN paths USING (grp, idx))
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM f JOIN subroots USING (grp), (SELECT hash AS root FROM up WHERE n = 1)"""


def oracle_sql() -> dict[str, str]:
    counts = " UNION ALL ".join(f"SELECT source, lang, '{k}' AS tokenizer, len(regexp_extract_all(coalesce(text, ''), '{p}')) AS n FROM documents" for k, p in token_counts.SQL_TOKENIZERS.items())
    return {"op12_source_mixing": MIX_SQL, "op13_merkle_manifest": merkle_sql(), "op9_token_counts": f"SELECT source, lang, tokenizer, count(*) AS n_docs, sum(n)::BIGINT AS n_tokens FROM ({counts}) WHERE n > 0 GROUP BY source, lang, tokenizer"}
