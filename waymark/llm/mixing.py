"""Mixing sources to target weights.

Words are summed per source. Targets share a multiple of all words by the sources' weights, and none passes a multiple of
its source's own words: what it would take beyond that goes to the others by weight. A source's repetition rate
is its target over its words. Each document is emitted floor(rate) times, and once more where a draw, which is a hash of a
seed and the document, is below the rate's fraction. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import before_parts, fresh, in_order, join_to_groups, materialize, numbered

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)  # by place among the sources, repeating
SHARE, MOST = 1.5, 2  # of all words; of a source's own
#: A draw is the first 13 hexadecimal digits of an MD5, which a double holds exactly.
DIGITS = 13


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def draw(seed: str) -> Column:
    """In [0, 1), by doc_id and text, so that a rerun draws alike on any partitioning."""
    said = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(said.cast("binary")), 1, DIGITS), 16, 10).cast("double") / float(16**DIGITS)


def source_targets(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, source_size, target, rate for each source; rate is 0 where there is no word.

    Sources are put in order of what they may take over their weight. Those before the first whose share would not
    pass its bound get their bound; the others share what is left by weight. share at most `most`, so that there is room.
    """
    if not 0 <= share <= most or not weights or min(weights) <= 0:
        raise ValueError("weights are above 0, and share is at most what sources may take")
    sizes = docs.groupBy("source").agg(F.sum(n_words(F.col("text"))).alias("source_size"))
    ranked = numbered(sizes, [F.col("source").asc_nulls_last()], "mix-sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("rank", F.lit(len(weights))) + 1).cast("int"))
    told = ranked.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * float(most)).alias("bound"))
    placed = in_order(told.withColumn("ratio", F.col("bound") / F.col("weight")), [F.col("ratio"), F.col("source").asc_nulls_last()], "mix-order")
    upto = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    passed = placed.join(before_parts(placed, {"bounds": F.col("bound"), "weights": F.col("weight")}), "part")
    passed = passed.withColumns({c: F.col(c) + F.coalesce(F.sum(own).over(upto), F.lit(0.0)) for c, own in (("bounds", "bound"), ("weights", "weight"))})
    whole = placed.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("all_weights"))
    # bounds, weights: of the sources before. A level is what a unit of weight gets if these take their bounds.
    level = (F.col("words") * float(share) - F.col("bounds")) / (F.col("all_weights") - F.col("weights"))
    levels = materialize(passed.join(F.broadcast(whole)).withColumn("level", level), "mix-levels")  # whole is one row
    first = levels.where(F.col("ratio") >= F.col("level")).agg(F.min_by("level", F.struct("ratio", "bounds")).alias("level"))
    target = F.least("bound", F.coalesce(F.col("level") * F.col("weight"), F.col("bound")))
    out = levels.drop("level").join(F.broadcast(first)).select("source", "source_size", target.alias("target"))  # first is one row
    return out.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))


def planned(docs: DataFrame, into: str = "mix", seed: str = "mix", **options) -> DataFrame:
    """Every row of docs with all its columns, and into: size, source_size, target and rate of its source, and copies, how often the mix takes it.

    Null and empty texts have no words; they are repeated at their source's rate as its other documents are. Texts of
    any length are counted whole. A null source is one of its own, last in the order. Rows with equal ids and texts
    share a draw, in every run; null ids draw by their texts. An empty table gives an empty table. A column of docs
    named as into is replaced, all others are kept whatever their names.
    """
    kept = docs.drop(into)
    size, own = fresh(kept, "mix_size"), fresh(kept, "mix_source")
    targets = materialize(source_targets(kept, **options), "mix-targets").select("source", F.struct("source_size", "target", "rate").alias(own))
    told = join_to_groups(kept.withColumn(size, n_words(F.col("text"))), targets, "source", F.struct("doc_id", F.char_length("text")))
    rate = F.col(f"{own}.rate")
    copies = F.floor(rate).cast("long") + F.when(draw(seed) < rate - F.floor(rate), 1).otherwise(0)
    return told.withColumn(into, F.struct(F.col(size).alias("size"), f"{own}.source_size", f"{own}.target", f"{own}.rate", copies.alias("copies"))).drop(size, own)


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed rows, with the columns of docs: each as often as planned. Rows are repeated where they lie, without a shuffle."""
    names, plan, again = docs.columns, fresh(docs, "mix_plan"), fresh(docs, "mix_again")
    told = planned(docs, plan, **options)
    return told.withColumn(again, F.explode(F.array_repeat(F.lit(0), F.col(f"{plan}.copies").cast("int")))).select(*names)
