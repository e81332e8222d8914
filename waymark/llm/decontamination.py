"""Benchmark decontamination by templates.

Numbers, mid-sentence names and units after numbers become typed placeholders; windows of template words are
hash-joined with those of the benchmark. Where enough of an item is found, its slots are held against the text's:
each value of the item must stand for one value throughout an alignment of the two, as in a question with other
parameters. Items made of little but slots, and short ones, are looked for by their exact words instead.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import broadcast_if_small, keep_rows, materialize, text_hash

WINDOW, LITERALS, COVERAGE = 8, 4, 0.5
#: Items of fewer words say nothing within a text; they are found where they are the whole text.
LEAST = 4
#: Units, as they follow a number.
UNITS = "kg|g|mg|t|lb|lbs|oz|km|m|cm|mm|mi|miles?|ft|feet|inch|inches|l|ml|s|sec|seconds?|min|minutes?|h|hours?|days?|weeks?|months?|years?|mph|kmh|kwh|kw|w|v|hz|mb|gb|tb|percent|dollars?|euros?|usd|eur|gbp|cents?|degrees?|meters?|metres?|kilometers?|kilograms?|grams?|liters?|litres?"
#: In a marked text a word that begins with __ is a unit, one with _ a name, one with a digit a number.
UNIT, NAME = "__", "_"


def marked_words(text: Column) -> Column:
    """Words of letters and digits, in lower case and marked; a decimal number is one word."""
    numbers = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"(?<=[0-9])%", " percent"), r"[$€£](?=[0-9])", " "), r"(?<=[0-9])[.,](?=[0-9])", "_")
    units = F.regexp_replace(numbers, rf"(?<=[0-9]) ?(?i:({UNITS}))(?![\p{{L}}\p{{N}}])", f" {UNIT}$1")
    typed = F.when(text.rlike("[0-9]"), units).otherwise(text)
    named = F.regexp_replace(typed, r"(?<=[\p{Ll}0-9,] )(?=\p{Lu})", NAME)
    return F.filter(F.split(F.lower(named), r"[^\p{L}\p{N}_]+"), lambda w: w != "")


def template(word: Column) -> Column:
    slot = F.when(word.startswith(UNIT), F.lit("<unit>")).when(word.startswith(NAME), F.lit("<name>"))
    return slot.when((word >= "0") & (word < ":"), F.lit("<num>")).otherwise(word)


def plain(word: Column) -> Column:
    return F.regexp_replace(word, "^_+", "")


def windows(table: DataFrame, keys: list[str], form=template) -> DataFrame:
    """keys, words, pos, hash: a hash for each run of WINDOW words in a form, made of those of its halves, and these of theirs; pos counts from 0.

    Each step is a projection of its own, so that no array is worked out twice.
    """
    cut = table.select(*keys, marked_words(F.coalesce("text", F.lit(""))).alias("words"))
    cut = cut.select(*keys, "words", F.transform("words", lambda w: F.xxhash64(form(w))).alias("hashes"))
    width = 1
    while width < WINDOW:
        cut = cut.select(*keys, "words", F.zip_with("hashes", F.slice("hashes", F.lit(width + 1), F.size("hashes")), lambda a, b: F.xxhash64(a, b)).alias("hashes"))
        width *= 2
    return cut.select(*keys, "words", F.posexplode(F.slice("hashes", F.lit(1), F.greatest(F.size("hashes") - (WINDOW - 1), F.lit(0)))).alias("pos", "hash"))


def item_cuts(benchmark: DataFrame, form=template) -> DataFrame:
    return windows(benchmark, ["item_id"], form).select("item_id", F.col("pos").alias("item_pos"), "hash", F.slice("words", F.col("pos") + 1, WINDOW).alias("item_words"))


def counted(cut: DataFrame) -> DataFrame:
    return cut.join(cut.groupBy("item_id").agg(F.count_distinct("item_pos").alias("n_windows")), "item_id")


def item_windows(benchmark: DataFrame) -> DataFrame:
    """item_id, item_pos, hash, item_words, n_windows: windows with LITERALS words besides slots; the others prove nothing."""
    return counted(item_cuts(benchmark).where(F.size(F.filter("item_words", lambda w: template(w) == w)) >= LITERALS).distinct())


def exact_windows(benchmark: DataFrame, items: DataFrame) -> DataFrame:
    """The same for items that have no such windows: all their windows, by the words themselves."""
    return counted(item_cuts(benchmark, plain).join(items.select("item_id").distinct(), "item_id", "left_anti").distinct())


def runs(table: DataFrame, keys: list[str], length: int) -> DataFrame:
    """keys, n_words, hash: a hash for each run of length words, by the words themselves."""
    cut = table.select(*keys, marked_words(F.coalesce("text", F.lit(""))).alias("words"))
    cut = cut.select(*keys, F.size("words").alias("n_words"), F.transform("words", lambda w: F.xxhash64(plain(w))).alias("own"))
    cut = cut.select(*keys, "n_words", "own", F.col("own").alias("hashes"))
    for k in range(1, length):
        cut = cut.select(*keys, "n_words", "own", F.zip_with("hashes", F.slice("own", F.lit(k + 1), F.size("own")), lambda a, b: F.xxhash64(a, b)).alias("hashes"))
    return cut.select(*keys, "n_words", F.explode(F.slice("hashes", F.lit(1), F.greatest(F.size("hashes") - (length - 1), F.lit(0)))).alias("hash"))


def short_copies(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """contaminated() for items of fewer than WINDOW words: exact copies of them, which are one window without slots."""
    short = benchmark.select("item_id", "text", F.size(marked_words(F.coalesce("text", F.lit("")))).alias("length")).where(F.col("length").between(1, WINDOW - 1))
    short = materialize(short, "short-items")
    told, found = docs.select("doc_id", text_hash().alias("text_hash"), "text"), None
    for length in sorted(r["length"] for r in short.select("length").distinct().collect()):  # WINDOW - 1 at most
        items = broadcast_if_small(runs(short.where(F.col("length") == length), ["item_id"], length).select("item_id", "hash").distinct())
        hits = runs(told, ["doc_id", "text_hash"], length).where(F.lit(length >= LEAST) | (F.col("n_words") == length)).join(items, "hash").select("doc_id", "text_hash", "item_id").distinct()
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        found = told.join(short.select("item_id"), F.lit(False)).select("doc_id", "text_hash", "item_id")
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    return found.select("doc_id", "text_hash", "item_id", one.alias("n_found"), one.alias("n_windows"), none.alias("n_slots"), none.alias("n_changed"))


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, text_hash, item_id, n_found, n_windows, n_slots, n_changed for documents that hold coverage of an item's windows with consistent slots.

    Null and empty texts and items hold nothing; texts of any length are read whole; items under WINDOW words are found
    by exact copies, under LEAST words only where they are the whole text; a passage that several items share
    counts for each; equal rows of docs give one row; null ids are carried; empty tables give an empty table; other
    columns are not read.
    """
    items = materialize(item_windows(benchmark), "template-items")
    exact = materialize(exact_windows(benchmark, items), "exact-items")
    leaks = aligned(docs, items, template, coverage)
    if exact.take(1):
        leaks = leaks.unionByName(aligned(docs, exact, plain, coverage))
    return leaks.unionByName(short_copies(docs, benchmark))


def aligned(docs: DataFrame, items: DataFrame, form, coverage: float) -> DataFrame:
    """contaminated() for the windows of items, in a form. An alignment whose slots are not consistent counts for nothing and bars no other."""
    narrow = broadcast_if_small(items.select("item_id", "item_pos", "hash", "n_windows"))
    hits = windows(docs.select("doc_id", text_hash().alias("text_hash"), "text"), ["doc_id", "text_hash"], form).select("doc_id", "text_hash", "hash").join(narrow, "hash")
    found = hits.groupBy("doc_id", "text_hash", "item_id", "n_windows").agg(F.count_distinct("item_pos").alias("n_found")).where(F.col("n_found") >= F.lit(coverage) * F.col("n_windows"))
    wanted = broadcast_if_small(materialize(found.select("doc_id", "text_hash").distinct(), "template-found"))
    again = windows(keep_rows(docs, wanted).select("doc_id", text_hash().alias("text_hash"), "text").distinct(), ["doc_id", "text_hash"], form)
    pairs = again.join(broadcast_if_small(items), "hash").select("doc_id", "text_hash", "item_id", "n_windows", "item_pos", (F.col("pos") - F.col("item_pos")).alias("shift"), "item_words", F.slice("words", F.col("pos") + 1, WINDOW).alias("doc_words"))
    slots = F.filter(F.arrays_zip("item_words", "doc_words"), lambda p: template(p["item_words"]) != p["item_words"])
    if form is plain:
        slots = F.transform(slots, lambda p: F.struct(plain(p["item_words"]).alias("item_words"), plain(p["doc_words"]).alias("doc_words")))
    # Within a shift an item's window is met once, so that its slots are bounded by the item.
    keys = ["doc_id", "text_hash", "item_id", "n_windows"]
    shifts = pairs.withColumn("slots", slots).groupBy(*keys, "shift").agg(F.collect_set("item_pos").alias("at"), F.array_distinct(F.flatten(F.collect_list("slots"))).alias("slots"))
    consistent = shifts.where(F.size(F.array_distinct(F.col("slots.item_words"))) == F.size("slots"))
    each = consistent.select(*keys, F.size("slots").alias("n_slots"), F.size(F.filter("slots", lambda p: p["item_words"] != p["doc_words"])).alias("n_changed"), F.posexplode("at").alias("i", "item_pos"))
    once = lambda c: F.sum(F.when(F.col("i") == 0, F.col(c)).otherwise(0)).cast("long").alias(c)
    judged = each.groupBy(*keys).agg(F.count_distinct("item_pos").alias("n_found"), once("n_slots"), once("n_changed")).where(F.col("n_found") >= F.lit(coverage) * F.col("n_windows"))
    return judged.select("doc_id", "text_hash", "item_id", "n_found", "n_windows", "n_slots", "n_changed")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Rows of docs that hold no item, with all their columns."""
    leaks = materialize(contaminated(docs, benchmark, **options).select("doc_id", "text_hash").distinct(), "template-leaks")
    return keep_rows(docs, broadcast_if_small(leaks), "left_anti")
