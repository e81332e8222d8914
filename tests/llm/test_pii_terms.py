import re
import time
from collections import defaultdict

from pyspark.sql import functions as F

from waymark.llm import pii

MAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")


def plain_terms(texts, context=120, min_support=3, generalise=0.8, remove=0.95):
    """Entities and words around them, counted over different texts, for texts whose only personal data are addresses."""
    from math import log2

    seen, holds, freq = defaultdict(set), defaultdict(set), defaultdict(set)
    for t in set(texts):
        for w in set(re.findall(r"[^\W_]+", t.lower())):
            freq[w].add(t)
        for m in MAIL.finditer(t):
            e = m[0].lower()
            holds[e].add(t)
            at = max(0, m.start() - context)
            before, after = t[at : m.start()], t[m.end() : m.end() + context]
            before = re.sub(r"^\S+", "", before) if at else before
            after = re.sub(r"\S+$", "", after)
            for w in re.findall(r"[^\W_]+", f"{before} {after}".lower()):
                seen[e, w].add(t)
    n, out = len(set(texts)), {}
    for (e, w), own in seen.items():
        p = min(0.5, len(holds[e]) / n)
        score = log2(min(1, len(own) / max(len(freq[w]), len(own))) / p) / -log2(p)
        if len(own) >= min_support and score >= generalise:
            out[w] = min(out.get(w, "term"), "cut" if score >= remove else "term")
    return out


def plain_spans(text, terms):
    base = [(m.start(), m.end(), "email") for m in MAIL.finditer(text)]
    more = [(m.start(), m.end(), terms[m[0].lower()]) for m in re.finditer(r"[^\W_]+", text) if m[0].lower() in terms]
    return sorted([*base, *(s for s in more if all(s[1] <= b[0] or b[1] <= s[0] for b in base))])


def test_term_spans_against_brute_force(spark):
    """Terms that always, mostly and never go with an address, within addresses, at the ends of texts and beyond the context."""
    texts = [f"Zorblat{i % 3} of Kelmar wrote from zed@kel.example about item {i} and {'Vintor' if i % 4 else 'nothing'} ZORBLAT" for i in range(12)]
    texts += [f"some other words {i} with Vintor, kelmar and nobody" for i in range(2)] + [f"plain words {i} and more" for i in range(60)]
    texts += ["zed@kel.example " + "filler " * 60 + "far.away kelmar", "kelmar@kel.example zorblat1", "", "Zorblat2"] + [texts[0]] * 5
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    terms = plain_terms(texts)
    assert {"term", "cut"} == set(terms.values()) and "kelmar" in terms and "about" in terms
    got = {r.doc_id: [(s.start, s.end, s.kind) for s in r.spans] for r in pii.find_personal_data(docs).collect()}
    assert got == {i: plain_spans(t, terms) for i, t in enumerate(texts)}


def test_many_entities_in_a_text_take_little_time(spark):
    """One text with 3,000 addresses among 26 disclosing names each; its sanitised form is whole."""
    rows = [(d, " ".join(f"m{i}@x{i}.example met Per{chr(97 + i % 26)}son at noon{d}" for i in range(3000))) for d in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    began = time.time()
    out = pii.sanitise(docs, min_support=3, generalise=0.1, remove=2.0).orderBy("doc_id").collect()
    assert time.time() - began < 90
    assert all("@" not in r.text and "son" not in r.text and r.text.count("[EMAIL]") == 3000 for r in out)
    assert re.sub(r"\[EMAIL\] \[WORD\] \[NAME\] \[WORD\] \S+ ?", "", out[0].text) == ""


def test_parts_are_cut_out_of_chunks(spark):
    text = "".join(chr(0x1F600 + i % 50) if i % 7 == 0 else chr(97 + i % 26) for i in range(5000))
    cuts = [(0, 0), (0, 5), (1020, 10), (1024, 1024), (1023, 1), (4990, 10), (10, 4000), (5000, 0)]
    df = spark.createDataFrame([(text, *c) for c in cuts], "t string, a int, n int")
    from waymark.llm.shared import chunked, cut_out

    got = df.select(cut_out(chunked(F.col("t")), F.col("a"), F.col("n")).alias("x")).collect()
    assert [r.x for r in got] == [text[a : a + n] for a, n in cuts]
