"""Information-theoretic sanitisation of personal data.

Entities are the e-mail addresses, IP addresses, card and phone numbers that patterns find. How far a term gives
an entity away is the pointwise mutual information of the two over the corpus's different texts, as a share of the
entity's own information content: 1 says that who sees the term knows the entity. Terms over one threshold are
generalised (numbers to their shape, names and words to their kind), over a higher one removed, in every document that
uses them. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import SPANS, broadcast_if_small, chunked, cut_out, find_spans, fresh, keep_rows, let, materialize, running, text_hash

KINDS = ("email", "ip", "card", "phone")
#: A match begins where the last one ended or where no earlier character could begin it; possessive runs never give back.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PREFILTERS = {"email": "@", "ip": r"[0-9]\.[0-9]+\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){13}", "phone": r"\+[0-9]"}
#: What stands for a span of each kind in a sanitised text; a generalised term has a stand-in of its own.
PLACEHOLDERS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "cut": ""}
WORD = r"[\p{L}\p{N}]++"
CONTEXT = 120  # characters on either side of an entity in which terms count as said with it


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """number: digits only. From the right, every second digit counts twice, and a sum over 9 is less 9."""
    ds = F.transform(F.split(F.reverse(number), ""), lambda d: F.try_to_number(d, F.lit("9")).cast("int"))
    total = F.aggregate(F.transform(ds, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)), F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return total % 10 == 0


ACCEPT = {
    "email": None,
    "ip": lambda v: F.forall(F.split(v, r"\."), lambda p: F.regexp_replace(p, "^0+", "").rlike("^(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])?$")),
    "card": lambda v: F.char_length(digits(v)).between(14, 19) & luhn(digits(v)),
    "phone": lambda v: F.char_length(digits(v)).between(10, 15),
}


def base_spans(text: Column) -> Column:
    return F.array_sort(F.concat(*[find_spans(text, k, i, PATTERNS[k], text.rlike(PREFILTERS[k]), ACCEPT[k]) for i, k in enumerate(KINDS)]))


def entity_contexts(docs: DataFrame, context: int = CONTEXT) -> DataFrame:
    """text_hash, entity, terms: a row for each entity occurrence. Terms are the runs of letters and digits within context characters; those cut by its ends are left out."""
    found = docs.select(text_hash().alias("text_hash"), F.coalesce("text", F.lit("")).alias("text")).withColumn("spans", base_spans(F.col("text"))).where(F.size("spans") > 0)
    cut = found.select("text_hash", chunked(F.col("text")).alias("chunks"), F.char_length("text").alias("length"), "spans")

    def told(span: Column) -> Column:
        begin = F.greatest(span["start"] - context, F.lit(0))
        before = cut_out(F.col("chunks"), begin, span["start"] - begin)
        before = F.when(begin == 0, before).otherwise(F.regexp_replace(before, r"^\S*+", ""))
        after = F.regexp_replace(cut_out(F.col("chunks"), span["end"], F.least(F.lit(context), F.col("length") - span["end"])), r"\S++$", "")
        return F.struct(F.concat_ws(":", span["kind"], F.lower(span["value"])).alias("entity"), F.lower(F.concat_ws(" ", before, after)).alias("around"))

    each = cut.select("text_hash", F.explode(F.transform("spans", told)).alias("t"))  # the text is not repeated for each
    terms = F.array_distinct(F.filter(F.split("t.around", r"[^\p{L}\p{N}]+"), lambda t: t != ""))
    return each.select("text_hash", "t.entity", terms.alias("terms"))


def words(text: Column) -> Column:
    """The different words of a text, in lower case."""
    return F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+"))


def disclosing_terms(docs: DataFrame, contexts: DataFrame, min_support: int = 3, generalise: float = 0.8, remove: float = 0.95) -> DataFrame:
    """entity, term, support, doc_freq, disclosure, action. All counts are of different texts, so that copies of a document add nothing."""
    told = contexts.select("entity", "text_hash", F.explode("terms").alias("term")).distinct()
    joint = materialize(told.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("support")).where(F.col("support") >= min_support), "pii-joint")
    of_entity = contexts.select("entity", "text_hash").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("n_texts"))
    hashed = docs.select(text_hash().alias("text_hash"), "text")
    texts = materialize(hashed.groupBy("text_hash").agg(F.count(F.lit(1)).alias("copies")), "pii-texts")
    copied = broadcast_if_small(texts.where("copies > 1").select("text_hash"))
    once = hashed.join(copied, "text_hash", "left_anti").unionByName(hashed.join(copied, "text_hash", "left_semi").groupBy("text_hash").agg(F.any_value("text").alias("text")))
    wanted = broadcast_if_small(joint.select("term").distinct())
    counts = once.select(F.explode(words(F.col("text"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("doc_freq"))
    freq = materialize(counts.join(wanted, "term", "left_semi"), "pii-freq")
    size = texts.agg(F.count(F.lit(1)).alias("n_docs"))
    p = lambda c: F.col(c) / F.col("n_docs")
    information = -F.log2(F.least(F.lit(0.5), p("n_texts")))
    pmi = F.log2(F.least(F.lit(1.0), F.col("support") / F.greatest("doc_freq", "support")) / F.least(F.lit(0.5), p("n_texts")))
    scored = joint.join(of_entity, "entity").join(freq, "term").join(F.broadcast(size)).withColumn("disclosure", pmi / information)  # size is one row
    return scored.where(F.col("disclosure") >= generalise).select("entity", "term", "support", "doc_freq", "disclosure", F.when(F.col("disclosure") >= remove, F.lit("cut")).otherwise(F.lit("term")).alias("action"))


def find_personal_data(docs: DataFrame, context: int = CONTEXT, into: str = "spans", **options) -> DataFrame:
    """Every row of docs with all its columns, and into: the spans of patterns and, of kinds term and cut, those of disclosing terms.

    Null texts are empty and have no spans; texts of any length are searched whole; spans are ordered by start, then kind,
    and a term within a pattern's span is not listed; equal rows get equal spans; null ids are carried; an empty table gives an
    empty table; a term gets spans in documents without entities too, by the strongest of its actions. A column of docs
    named as into is replaced, all others are kept whatever their names.
    """
    contexts = materialize(entity_contexts(docs, context), "pii-contexts")
    terms = materialize(disclosing_terms(docs, contexts, **options), "pii-terms")
    # Of the actions "cut" and "term" the lesser is the stronger.
    told = broadcast_if_small(materialize(terms.groupBy("term").agg(F.min("action").alias("action")), "pii-told"))
    hashed = docs.select("doc_id", text_hash().alias("text_hash"), F.col("text"))
    using = materialize(hashed.select("doc_id", "text_hash", F.explode(words(F.col("text"))).alias("term")).join(told, "term", "left_semi").select("doc_id", "text_hash").distinct(), "pii-using")
    # Only texts with such a term are cut into all their words; a word's action comes by a join, whatever the number of terms.
    each = keep_rows(docs, broadcast_if_small(using)).select("doc_id", text_hash().alias("text_hash"), F.coalesce("text", F.lit("")).alias("text")).dropDuplicates(["doc_id", "text_hash"])
    each = each.select("doc_id", "text_hash", F.explode(find_spans(F.col("text"), "term", len(KINDS), WORD, F.lit(True))).alias("s")).withColumn("term", F.lower(F.col("s.value")))
    rank = F.when(F.col("action") == "term", len(KINDS)).otherwise(len(KINDS) + 1).alias("rank")
    span = F.struct("s.start", rank, "s.end", F.col("action").alias("kind"), "s.value")
    marked = materialize(each.join(told, "term").select("doc_id", "text_hash", span.alias("s")).groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list("s")).cast(SPANS).alias("spans")), "pii-marked")
    kept = docs.drop(into)
    own, id_, hash_, more = (fresh(kept, f"pii_{c}") for c in ("own", "id", "hash", "more"))
    marked = broadcast_if_small(marked.select(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_), F.col("spans").alias(more)))
    based = kept.withColumn(own, text_hash()).withColumn(into, base_spans(F.coalesce("text", F.lit(""))))
    out = based.join(marked, based["doc_id"].eqNullSafe(F.col(id_)) & (F.col(own) == F.col(hash_)), "left")
    return out.withColumn(into, F.when(F.size(more) > 0, with_free(F.col(into), F.col(more))).otherwise(F.col(into))).drop(own, id_, hash_, more)


def with_free(base: Column, more: Column) -> Column:
    """base and those of more that overlap none of them, in order. One sweep from either side: how far earlier spans of base reach, and where the next one begins."""
    ours = lambda s: s["rank"] < len(KINDS)
    reach = lambda v: running(F.transform(v, lambda s: F.when(ours(s), s["end"]).otherwise(F.lit(0).cast("long"))), lambda a, b: F.greatest(a, b))
    begins = lambda v: F.reverse(running(F.transform(F.reverse(v), lambda s: F.when(ours(s), s["start"]).otherwise(F.lit((1 << 62)))), lambda a, b: F.least(a, b)))
    swept = lambda v: F.zip_with(F.zip_with(v, reach(v), lambda s, e: F.struct(s.alias("s"), e.alias("reach"))), begins(v), lambda x, b: F.struct(x["s"].alias("s"), (ours(x["s"]) | ((x["reach"] <= x["s"]["start"]) & (b >= x["s"]["end"]))).alias("free")))
    return F.transform(F.filter(let(F.array_sort(F.concat(base, more)), swept), lambda x: x["free"]), lambda x: x["s"])


def stand_in(span: Column) -> Column:
    """A generalised number keeps its shape, with zeros for digits; a name and any other word keep their kind."""
    value = span["value"]
    term = F.when(value.rlike(r"\p{N}"), F.regexp_replace(value, r"\p{N}", "0")).when(value.rlike(r"^\p{Lu}"), F.lit("[NAME]")).otherwise(F.lit("[WORD]"))
    return F.coalesce(F.create_map(*[F.lit(x) for kv in PLACEHOLDERS.items() for x in kv])[span["kind"]], term)


def sanitise(docs: DataFrame, **options) -> DataFrame:
    """docs with every span of its text replaced; a null text stays null. Spans that overlap give way together, to what stands for the first. No other column changes."""
    names, spans = docs.columns, fresh(docs, "pii_spans")
    found = find_personal_data(docs, into=spans, **options)
    chunks, length = fresh(docs, "pii_chunks"), F.char_length("text")
    found = found.withColumn(chunks, F.when(F.size(spans) > 0, chunked(F.col("text"))))
    piece = lambda at, until: cut_out(F.col(chunks), at, until - at)

    def cut_at(ends: Column) -> Column:
        """ends: how far the spans up to each one reach."""
        before = F.concat(F.array(F.lit(0).cast("long")), ends)
        pieces = F.zip_with(spans, F.slice(before, F.lit(1), F.size(spans)), lambda s, at: F.when(s["start"] >= at, F.concat(piece(at, s["start"]), stand_in(s))).otherwise(F.lit("")))
        return F.concat(F.array_join(pieces, ""), piece(F.element_at(before, -1), length))

    built = let(running(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b)), cut_at)
    return found.withColumn("text", F.when(F.size(spans) > 0, built).otherwise(F.col("text"))).select(*names)
