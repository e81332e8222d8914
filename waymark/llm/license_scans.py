"""Licence recognition by sentences.

Texts are cut into sentences whatever their line breaks, sentences are normalised and what varies in them made canonical.
A table maps them to identifiers of known licence sentences, those of whole licence texts and of ways to name a licence.
The identifiers of a document, in order, are matched against licence rules: ordered lists of identifiers between which
others may stand. DataFrame functions only; a document is judged within its row, so nothing is shuffled.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .licence_texts import NAMES, PHRASES, TEXTS
from .shared import let

#: A sentence ends at a blank line, or after . ! ? ; or : before white space; a line break alone ends none. Known texts are cut alike.
SENTENCE_BREAK = r"(?:(?<=[.!?;:])%s\s+|\s*\n\s*\n\s*)"
SENTENCE_END = SENTENCE_BREAK % r"(?<!(?i:identifier:|spdx:|\b(?:v|inc|ltd|corp|co)\.))"
#: Every known sentence has one of these, once in lower case.
HINT = r"licen[cs]e|spdx|unencumbered|(?:released|distributed|published)[^a-z0-9]+under|\bgpl|permission|permitted|copyright|redistribut|warrant|endorse|rights[^a-z0-9]+reserved|public[^a-z0-9]+domain|free[^a-z0-9]+software|may[^a-z0-9]+obtain"
#: In order: what varies between copies of a sentence, and what stands for it.
CANONICAL = (
    (r"licence", "license"),
    (r"^(?:c )?copyright (?:c )?[0-9]{4}.*$", "copyright notice"),
    (r"neither the names? of .+ nor the names of (?:its|their) contributors", "neither the name of holder nor the names of its contributors"),
    (r"provided by .+ as is", "provided by holder as is"),
    (r"(you (?:may|can) obtain (?:a copy of the license|one) at).*$", "$1"),
    (r"\bthis (?:file|library|package|software|work)\b", "this program"),
    (r"\b(?:version|v) ?([0-9])(?: 0\b)?", "v$1"),
    (r"^(?:it|this|the|these)(?: [a-z]+){0,6} (?:is|are) (?:made )?(?=licensed|released|distributed under|available under|dedicated)", ""),
    (r"(?:licensed|released|distributed|available|published) under (?:an? |the )?(?:terms of (?:an? |the )?)?", "licensed under "),
    (r"^(licensed under .*?) the license$", "$1"),
    (r"^(licensed under .*?) (?:as published by the free software foundation|which (?:is available|accompanies)|see (?:the|license|licence|copying|file)|a copy of which|found in|in the license|with the following)\b.*$", "$1"),
    (r" or (?:at your option )?(?:any )?later(?: version)?$", ""),
    (r"^(?:[a-z0-9]+ ){1,6}is free software$", "this program is free software"),
)


def canonical_text(sentence: str) -> str:
    """normal() and canonical() for the known texts, which are ASCII."""
    out = re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()
    for pattern, stand_in in CANONICAL:
        out = re.sub(pattern, stand_in.replace("$", "\\"), out)
    return out


def known_sentences() -> tuple[dict[str, str], list[tuple[str, list[str]]]]:
    """Identifier by canonical sentence, and rules (licence, identifiers): whole texts, longest first, then the first sentence that tells a licence, and names, alone."""
    ids: dict[str, str] = {}
    whole = []
    for licence, texts in TEXTS.items():
        for t, text in enumerate(texts):
            sentences = [canonical_text(s) for s in re.split(SENTENCE_BREAK % r"(?<!\bv\.)", text) if re.search(HINT, s.lower()) and "://" not in s[:10]]
            whole.append((licence, [ids.setdefault(s, f"{licence}:{f'{t + 1}.' if t else ''}{i + 1}") for i, s in enumerate(sentences)]))
    owners = {i: {licence for licence, seq in whole if i in seq} for i in ids.values()}
    telling = [(licence, [next(i for i in seq if len(owners[i]) == 1)]) for licence, seq in whole if any(len(owners[i]) == 1 for i in seq)]
    grant = [("BSD", seq[:1]) for licence, seq in whole if licence == "BSD-2-Clause"]
    named = {f"licensed under {name}": licence for licence, names in NAMES.items() for name in names} | PHRASES
    named |= {canonical_text(f"{the}{name}"): licence for licence, names in NAMES.items() for name in names if "license" in name for the in ("", "the ")}
    by_name = {ids.setdefault(s, f"ref:{licence}"): licence for s, licence in named.items()} | {f"ref:{licence}": licence for licence in [*TEXTS, *NAMES]}
    taken = {seq[0] for _, seq in telling}
    return ids, [*sorted((r for r in whole if len(r[1]) > 1), key=lambda r: -len(r[1])), *telling, *grant, *[(licence, [i]) for i, licence in by_name.items() if i not in taken]]


SENTENCES, RULES = known_sentences()
#: Identifiers as SPDX expressions have them, in capitals, and the licences they stand for.
SPDX = {licence.upper(): licence for licence in [*TEXTS, *NAMES]}
EXPRESSIONS = (r"(?i)\bspdx(?:-license-identifier)?\s*:\s*([a-z0-9.+() -]+)", r"(?i)\blicen[cs]e[\"']?\s*[:=]\s*[\"']([a-z0-9.+() -]+)[\"']")


def expression_ids(sentence: Column) -> Column:
    """Identifiers of the licences that an SPDX expression names: alternatives and parts each, without exceptions; or-later and only are one."""
    said = F.concat(*[F.regexp_extract_all(sentence, F.lit(p), F.lit(1)) for p in EXPRESSIONS])
    names = F.flatten(F.transform(said, lambda e: F.split(e, r"(?i)[()]|(?<![^\s()])(?:and|or)(?![^\s()])")))
    bare = F.transform(names, lambda n: F.upper(F.trim(F.regexp_replace(F.regexp_replace(n, r"(?i)\s+with\s.*$", ""), r"(?i)(?:-only|-or-later|\+)?\s*$", ""))))
    table = F.create_map(*[F.lit(x) for k, v in SPDX.items() for x in (k, f"ref:{v}")])
    return F.filter(F.transform(bare, lambda n: F.try_element_at(table, n)), lambda i: i.isNotNull())


def canonical(sentence: Column) -> Column:
    out = F.trim(F.regexp_replace(F.lower(sentence), r"[^\p{L}\p{N}]+", " "))
    for pattern, stand_in in CANONICAL:
        out = F.regexp_replace(out, pattern, stand_in)
    return out


def sentence_ids(text: Column, sentences: dict[str, str] | None = None) -> Column:
    """Identifiers of the known sentences of a text, in order. In a sentence that is not known, its lines are looked up, as a notice may follow prose without a stop."""
    table = F.create_map(*[F.lit(x) for kv in (sentences or SENTENCES).items() for x in kv])
    hinted = lambda s: F.lower(s).rlike(HINT)
    look = lambda s: F.try_element_at(table, canonical(s))
    found = lambda ids: F.filter(ids, lambda i: i.isNotNull())
    under = "licensed under "
    # Of "licensed under one or another" each name is looked up.
    parts = lambda c: F.when(c.startswith(under) & c.rlike(" (?:or|and) "), F.transform(F.split(F.substr(c, F.lit(len(under) + 1)), " (?:or|and) "), lambda n: F.try_element_at(table, F.concat(F.lit(under), F.regexp_replace(n, "^(?:the|under(?: the)?) ", ""))))).otherwise(F.array().cast("array<string>"))
    line = lambda s: F.when(look(s).isNotNull(), F.array(look(s))).when(F.size(expression_ids(s)) > 0, expression_ids(s)).otherwise(found(parts(canonical(s))))
    lines = lambda s: F.flatten(F.transform(F.filter(F.split(s, r"\n"), hinted), line))
    # A sentence that is not known as a whole, and has neither an expression nor several names, is looked up by lines.
    each = F.transform(F.filter(F.split(text, SENTENCE_END, -1), hinted), lambda s: F.when(look(s).isNotNull(), F.array(look(s))).otherwise(let(lines(s), lambda own: F.when(F.size(own) > 0, own).otherwise(found(parts(canonical(s)))))))
    return F.when(hinted(text), F.flatten(each)).otherwise(F.array().cast("array<string>"))


def follows(ids: Column, rule: Column) -> Column:
    """Whether the rule's identifiers stand in ids in their order, with or without others between."""
    after = lambda at, x: F.array_position(F.slice(ids, (at + 1).cast("int"), F.size(ids)), x)
    return F.aggregate(rule, F.lit(0).cast("long"), lambda at, x: F.when((at >= 0) & (after(at, x) > 0), at + after(at, x)).otherwise(F.lit(-1).cast("long"))) >= 0


def match_licences(ids: Column, rules: list[tuple[str, list[str]]] | None = None) -> Column:
    """Licences whose rules ids follow, each once, in the rules' order; what a rule takes no later rule sees."""
    told = F.array(*[F.struct(F.lit(name).alias("name"), F.array(*map(F.lit, seq)).alias("seq")) for name, seq in rules or RULES])
    state = F.struct(ids.alias("left"), F.array().cast("array<string>").alias("found"))
    taken = lambda acc, r: F.struct(F.filter(acc["left"], lambda i: ~F.array_contains(r["seq"], i)).alias("left"), F.array_union(acc["found"], F.array(r["name"])).alias("found"))
    return F.aggregate(told, state, lambda acc, r: F.when(follows(acc["left"], r["seq"]), taken(acc, r)).otherwise(acc), lambda acc: acc["found"])


def scan_licences(docs: DataFrame, sentences: dict[str, str] | None = None, rules: list[tuple[str, list[str]]] | None = None) -> DataFrame:
    """doc_id, n_sentences, sentence_ids, licences for every row of docs.

    Null and empty texts have no sentences; texts of any length are read whole; of rules that fit, the earlier takes the
    sentences; equal rows get equal results; null ids are carried; an empty table gives an empty table; other columns are not read.
    """
    found = docs.select("doc_id", sentence_ids(F.coalesce("text", F.lit("")), sentences).alias("sentence_ids"))
    licences_of = F.when(F.size("sentence_ids") > 0, match_licences(F.col("sentence_ids"), rules)).otherwise(F.array().cast("array<string>"))
    return found.select("doc_id", F.size("sentence_ids").cast("long").alias("n_sentences"), "sentence_ids", licences_of.alias("licences"))
