"""Quality rules with adaptive thresholds.

Every document is measured once; each measure's distribution by language and source is kept as a mergeable
quantile sketch of the documents that pass the base rules. A rule's cutoff lies at the widest jump between the outer
quantiles of a group, where there is one, else at a multiple of the outermost quantile's distance from the median. It is
shrunk towards the cutoff of the group's language, and that towards the corpus's, the more the fewer documents there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import broadcast_if_small, keep_rows, materialize, merge_sketches, sketch, sketch_quantiles, text_hash

SPACE, SYMBOLS, MARKS = b" \t\n\r\x0b\x0c", b"#*$%&|<>", b"!?"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MEASURES = [*BASE, "n_marks", "n_lines"]


#: Outer quantiles between which a jump is looked for. Documents of another kind are seen if they are at least 0.5 % and at most 20 % of a group.
OUTER = (0.80, 0.85, 0.90, 0.925, 0.95, 0.97, 0.98, 0.99, 0.995)
JUMP, REACH = 4.0, 1.5
#: Documents that a parent's cutoff weighs as much as.
PRIOR = 200


@dataclass(frozen=True)
class Rule:
    """Rejects values above the cutoff; low: below it. Distances from the median up to resolution, or up to the quartile's, mean nothing."""

    name: str
    value: str
    resolution: float
    low: bool = False


#: Values are SQL over the measures.
RULES = (
    Rule("symbols", "n_symbols / greatest(n_words, 1)", 0.02),
    Rule("marks", "n_marks / greatest(n_words, 1)", 0.05),
    Rule("dup_lines", "n_dup_lines / greatest(n_lines, 1)", 0.10),
    Rule("repeats", "n_repeat_words / greatest(n_words, 1)", 0.05),
    Rule("long_words", "word_chars / greatest(n_words, 1)", 0.5),
    Rule("short_words", "word_chars / greatest(n_words, 1)", 0.5, low=True),
)
BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"


def repeated_words(words: list[bytes]) -> int:
    """Words within 3-word windows that occur twice or more in the text."""
    ids: dict[bytes, int] = {}
    seq = np.array([ids.setdefault(w, len(ids)) for w in words], dtype=np.int64)
    n, v = len(seq), len(ids)
    if n < 4 or v == n:
        return 0
    pairs = seq[:-1] * v + seq[1:]
    if v > 2_000_000:
        pairs = np.unique(pairs, return_inverse=True)[1]
    keys = pairs[:-1] * v + seq[2:]
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    again = np.zeros(n, dtype=bool)
    starts = np.concatenate([order[1:][same], order[:-1][same]])
    for shift in range(3):
        again[starts + shift] = True
    return int(again.sum())


def measure(text: str) -> tuple[int, ...]:
    """In the order of MEASURES. Takes whole texts of any length, in memory of a few times the text."""
    raw = text.encode("utf-8", "surrogatepass")
    words, lines = raw.split(), raw.split(b"\n")
    seen: set[bytes] = set()
    dup = 0
    if len(lines) > 1:
        for line in lines:
            if line in seen:
                dup += bool(line.strip(SPACE))
            else:
                seen.add(line)
    return (
        len(words),
        len(text) - (len(raw) - len(raw.translate(None, SPACE))),
        len(raw) - len(raw.translate(None, SYMBOLS)),
        dup,
        repeated_words(words),
        len(raw) - len(raw.translate(None, MARKS)),
        len(lines),
    )


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = batch.column(batch.num_columns - 1)
        rows = [measure(t.as_py() or "") for t in text]
        columns = np.array(rows, dtype=np.int64).reshape(len(rows), len(MEASURES)).T
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *[pa.array(c) for c in columns]], names=[*batch.schema.names[:-1], *MEASURES])


def document_measures(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, lang, source (null: '') and the measures, a row for each row of docs; a null text has no words."""
    told = docs.select("doc_id", text_hash().alias("text_hash"), F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), F.col("text").cast("string"))
    kind = told.schema["doc_id"].dataType.simpleString()
    return told.mapInArrow(_measured, f"doc_id {kind}, text_hash long, lang string, source string, " + ", ".join(f"{m} long" for m in MEASURES))


def cutoff() -> Column:
    """Over columns q50, quarter (the quartile on the rule's side), outer (the array of outer quantiles there), resolution and low."""
    noise = F.greatest("resolution", F.abs(F.col("quarter") - F.col("q50")))
    reach = F.transform("outer", lambda x: F.greatest(F.abs(x - F.col("q50")), noise))
    widest = F.array_max(F.zip_with(F.slice(reach, 1, len(OUTER) - 1), F.slice(reach, 2, len(OUTER) - 1), lambda a, b: F.struct((b / a).alias("jump"), F.sqrt(a * b).alias("between"))))
    distance = F.when(widest["jump"] >= JUMP, widest["between"]).otherwise(F.lit(REACH) * F.element_at(reach, -1))
    return F.when(F.col("low"), F.col("q50") - distance).otherwise(F.col("q50") + distance)


def adaptive_thresholds(measures: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """lang, source and a cutoff for each rule. Sketches of sources add up to those of languages, and these to the corpus."""
    values = measures.where(~F.expr(BASE_FAILED)).select("lang", "source", F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.expr(r.value).cast("double").alias("value")) for r in rules])).alias("v")).select("lang", "source", "v.rule", "v.value")
    bins = materialize(sketch(values, ["lang", "source", "rule"]), "quality-sketch")
    asked = {"q25": 0.25, "q50": 0.5, "q75": 0.75} | {f"up{i}": p for i, p in enumerate(OUTER)} | {f"down{i}": 1 - p for i, p in enumerate(OUTER)}
    told = F.create_map(*[x for r in rules for x in (F.lit(r.name), F.struct(F.lit(r.resolution).alias("resolution"), F.lit(r.low).alias("low")))])

    def level(keys: list[str], name: str) -> DataFrame:
        quantiles = sketch_quantiles(merge_sketches(bins, [*keys, "rule"]), [*keys, "rule"], asked).withColumn("told", told[F.col("rule")])
        side = lambda low, high: F.when(F.col("told.low"), low).otherwise(high)
        sided = quantiles.select(*keys, "rule", "n_values", "q50", "told.*", side(F.col("q25"), F.col("q75")).alias("quarter"), side(*[F.array(*[f"{way}{i}" for i in range(len(OUTER))]) for way in ("down", "up")]).alias("outer"))
        return materialize(sided.select(*keys, "rule", cutoff().alias(f"{name}_cut"), F.col("n_values").alias(f"{name}_n")), "quality-cuts")

    shrunk = lambda own, n, parent: (F.col(n) * F.col(own) + F.lit(PRIOR) * parent) / (F.col(n) + F.lit(PRIOR))
    chosen = level(["lang", "source"], "own").join(level(["lang"], "lang"), ["lang", "rule"]).join(level([], "all"), ["rule"])
    chosen = chosen.withColumn("cut", shrunk("own_cut", "own_n", shrunk("lang_cut", "lang_n", F.col("all_cut"))))
    return chosen.groupBy("lang", "source").agg(*[F.max(F.when(F.col("rule") == r.name, F.col("cut"))).alias(f"cut_{r.name}") for r in rules])


def quality_verdicts(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, text_hash, the measures, base_failed, failed_rules (comma-joined), kept; a row for each row of docs.

    Null and empty texts have no words and fail the base rules; texts of any length are measured whole; a value equal to a
    cutoff passes; null languages and sources form a group of their own; a group in which every document fails the base rules
    has no cutoffs and needs none; equal rows get equal verdicts; an empty table gives an empty table; other columns are not read.
    """
    measures = materialize(document_measures(docs), "quality-measures")
    cuts = broadcast_if_small(materialize(adaptive_thresholds(measures, rules), "quality-cuts"))
    failed = F.concat_ws(",", *[F.when((F.expr(r.value) < F.col(f"cut_{r.name}")) if r.low else (F.expr(r.value) > F.col(f"cut_{r.name}")), F.lit(r.name)) for r in rules])
    judged = measures.join(cuts, ["lang", "source"], "left").withColumn("base_failed", F.expr(BASE_FAILED)).withColumn("failed_rules", failed)
    return judged.select("doc_id", "text_hash", *MEASURES, "base_failed", "failed_rules", (~F.col("base_failed") & (F.col("failed_rules") == "")).alias("kept"))


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """Rows of docs that pass, with all their columns."""
    kept = quality_verdicts(docs, **options).where("kept").select("doc_id", "text_hash").distinct()
    return keep_rows(docs, kept)
