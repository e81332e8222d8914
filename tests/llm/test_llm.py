import hashlib
import math
import random
import re
import textwrap
import zlib
from collections import Counter
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from waymark.llm import decontamination, kneser_ney, license_scans, lm_scoring, near_dedup, packing, pii, quality_rules, queries, secret_scans, token_counts
from waymark.llm.shared import scratch_path, sketch, sketch_quantiles

#: Besides the columns of documents, names that operators' own results and helpers have.
CLASHES = ["spans", "n_words", "text_hash", "kept", "key_id", "key_hash", "own_hash", "pii_own", "pii_id", "pii_hash", "pii_term", "pii_cut", "pii_spans", "_id", "_hash", "_term", "label", "key", "bucket", "chunk", "code", "cut"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)
PROSE = " ".join(f"word{i % 37} other{i}" for i in range(60))
EDGE = [
    (1, PROSE, "en", "a", 10),
    (1, PROSE, "en", "a", 10),
    (2, PROSE, "en", "a", 10),
    (3, PROSE.replace("other7 ", "else7 "), "en", None, None),
    (4, None, None, None, None),
    (5, "", "", "", 0),
    (None, "password = abcdefgh1 and a.b@c.example", None, "a", 5),
    (6, "x" * 200_000, "de", "b", 200_000),
    (7, "\n".join([PROSE] * 40), "fr", "b", 9),
    (8, " ".join(f"m{i}@x{i}.example token=abcdefgh{i}" for i in range(3000)), "fr", "b", 9),
]
EDGE = [(*r, *("x" for _ in CLASHES)) for r in EDGE]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, SCHEMA)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "A train leaves at 40 km per hour and reaches the far town after 7 hours of travel, said the teacher Anna to the class"), (2, None), (3, "short")], "item_id long, text string")


def runs(docs, benchmark):
    spark = docs.sparkSession
    labels = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")
    from public_tokenizers import path

    return {
        "quality": lambda: quality_rules.quality_verdicts(docs),
        "lm": lambda: lm_scoring.score_documents(docs),
        "secrets": lambda: secret_scans.scan_documents(docs),
        "pack": lambda: packing.pack(docs, path("byte_bpe_50k.json")),
        "pii": lambda: pii.find_personal_data(docs),
        "leaks": lambda: decontamination.contaminated(docs, benchmark),
        "kneser": lambda: kneser_ney.classify(docs, labels),
        "near": lambda: near_dedup.near_duplicates(docs),
        "counts": lambda: token_counts.maintain(docs, scratch_path(spark, "rollup")),
        "licences": lambda: license_scans.scan_licences(docs),
    }


@pytest.mark.parametrize("name", ["quality", "lm", "secrets", "pack", "pii", "leaks", "kneser", "near", "counts", "licences"])
def test_odd_rows_and_empty_tables(edge, benchmark, name):
    rows = runs(edge, benchmark)[name]().collect()
    if name in ("quality", "lm", "secrets", "pii", "kneser", "near", "licences"):
        assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in EDGE)
    assert runs(edge.limit(0), benchmark)[name]().collect() == []


def test_filters_keep_rows_and_columns_whatever_their_names(edge, benchmark):
    told = {r.doc_id: r for r in edge.collect()}
    for out in (quality_rules.keep_good(edge), near_dedup.drop_near_duplicates(edge), decontamination.drop_contaminated(edge, benchmark), pii.sanitise(edge), pii.find_personal_data(edge, into="found").drop("found")):
        rows = out.collect()
        assert out.columns == edge.columns and rows
        assert all(r.asDict() | {"text": None} == told[r.doc_id].asDict() | {"text": None} for r in rows)


def test_measures_against_a_plain_count():
    def plain(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        grams = Counter(zip(w, w[1:], w[2:]))
        again = {j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
        lines, dup = t.split("\n"), 0
        for i, line in enumerate(lines):
            dup += bool(re.search(r"[^\x20\x09-\x0D]", line)) and line in lines[:i]
        return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(again))

    rng = np.random.default_rng(1)
    for _ in range(300):
        t = "".join(rng.choice(list("ab é#\n\t|"), rng.integers(0, 60)))
        assert quality_rules.measure(t)[:5] == plain(t)


def test_cutoffs_follow_each_group_and_junk_goes(spark):
    """Two groups whose clean documents differ: what is far out in one is usual in the other."""
    rng = np.random.default_rng(5)
    word = lambda n: "".join(rng.choice(list("abcdefghij"), n))
    prose = lambda size, marks: " ".join(word(size) + ("#" if k < marks else "") for k in range(100))
    docs = [(i, prose(4, 0), "en", "a") for i in range(400)] + [(1000 + i, prose(9, 20 + i % 8), "de", "b") for i in range(400)]
    junk = [(2000 + i, prose(4, 22), "en", "a") for i in range(30)] + [(3000 + i, prose(9, 95), "de", "b") for i in range(30)]
    frame = spark.createDataFrame(docs + junk, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in quality_rules.quality_verdicts(frame).collect()}
    assert all(got[d[0]].kept for d in docs) and not any(got[d[0]].kept for d in junk)
    cuts = {r.lang: r for r in quality_rules.adaptive_thresholds(quality_rules.document_measures(frame)).collect()}
    assert cuts["en"].cut_symbols < 0.22 < cuts["de"].cut_symbols and cuts["en"].cut_long_words < 9 < cuts["de"].cut_long_words


def test_cutoffs_against_plain_quantiles(spark):
    """The rule stated over sorted values; a sketch is off by half a bin."""
    rng = np.random.default_rng(6)
    rows = [(i, " ".join("a" * int(n) for n in rng.integers(2, 9, 80))) for i in range(500)] + [(500 + i, " ".join(["a" * 40] * 79 + [f"b{i}"])) for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'l' AS lang", "'s' AS source")
    rule = quality_rules.Rule("long_words", "word_chars / greatest(n_words, 1)", 0.5)
    cut = quality_rules.adaptive_thresholds(quality_rules.document_measures(frame), (rule,)).first().cut_long_words
    values = sorted(sum(map(len, t.split())) / 80 for _, t in rows if quality_rules.measure(t)[4] * 2 <= 80)
    at = lambda q: values[math.ceil(len(values) * q) - 1]
    reach = [max(at(q) - at(0.5), 0.5, at(0.75) - at(0.5)) for q in quality_rules.OUTER]
    jump, between = max((b / a, math.sqrt(a * b)) for a, b in zip(reach, reach[1:]))
    assert abs(cut / (at(0.5) + (between if jump >= quality_rules.JUMP else quality_rules.REACH * reach[-1])) - 1) < 0.1


def test_sketches_merge_and_bound_the_error(spark):
    values = spark.range(1, 10001).select(F.lit("k").alias("k"), F.col("id").cast("double").alias("value"))
    got = sketch_quantiles(sketch(values, ["k"]), ["k"], {"m": 0.5, "h": 0.9}).first()
    assert abs(got.m / 5000 - 1) < 0.02 and abs(got.h / 9000 - 1) < 0.02 and got.n_values == 10000


SECRETS = ["token: secret: abcdefghij token=password", 'x API_KEY="abcdefgh" AKIA1234567890ABCD é AKIA12 ' + "0a" * 16 + " " + "f" * 31, "token=abcdefg", "\U0001f600 passwd = 12345678"]
PRIVATE = ["a@b.c_d@e.f é x@y", "1.2.3.4.5 256.1.1.1 001.2.3.4", "4111 1111 1111 1111 and 4111-1111-1111-1112", "\U0001f600 +1 (415) 555-0100 +12 3", "....@a.b-.c 9.9.9.9@x.y"]


def test_base_spans_against_python(spark):
    def luhn(d):
        return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    def digits(m):
        return re.sub("[^0-9]", "", m[0])

    three = [("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[1]) >= 8), ("access", "AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16), ("hex", "[0-9a-f]+", lambda m: len(m[0]) >= 32)]
    five = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))), ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15)]
    texts = SECRETS + PRIVATE
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for rules, found, kinds in ((three, secret_scans.scan_documents(docs), ("assign", "access", "hex")), (five, pii.find_personal_data(docs), pii.KINDS)):
        for r in queries.digest(found, kinds).collect():
            spans = sorted((m.start(), i, f"{k}:{m.start()}:{m.end()}") for i, (k, p, ok) in enumerate(rules) for m in re.finditer(p, texts[r.doc_id]) if ok(m))
            assert r.base_sha256 == hashlib.sha256(",".join(s[2] for s in spans).encode()).hexdigest(), texts[r.doc_id]


def test_ledger_scans_only_what_is_new(spark):
    ledger = secret_scans.BlobLedger(spark, scratch_path(spark, "ledger"))
    v = spark.createDataFrame([("p", 1, "token=abcdefgh"), ("q", 1, "token=abcdefgh"), ("p", 2, "AKIA1234567890ABCD")], "path string, version long, text string")
    first = secret_scans.RULES[:1]
    ledger.scan(v, first)
    assert ledger.rows().count() == 2
    ledger.scan(v, first)
    assert ledger.rows().count() == 2
    ledger.scan(v, secret_scans.RULES[:2])
    assert [r.rules for r in ledger.rows().where("array_contains(rules, 'access@1')").collect()] == [["access@1"]] * 2
    assert {(r.path, r.version): len(r.spans) for r in ledger.findings(v, secret_scans.RULES[:2]).collect()} == {("p", 1): 1, ("q", 1): 1, ("p", 2): 1}


def test_findings_are_those_of_the_asked_version(spark):
    ledger = secret_scans.BlobLedger(spark, scratch_path(spark, "ledger"))
    v = spark.createDataFrame([("p", 1, "token=abcdefgh12")], "path string, version long, text string")
    old = secret_scans.RULES[:1]
    new = (replace(old[0], version=2, pattern="token=([a-z]+)"),)
    ends = lambda rules: [[(s.kind, s.end) for s in r.spans] for r in ledger.findings(v, rules).collect()]
    ledger.scan(v, old)
    assert ends(old) == [[("assign", 16)]] and ends(new) == [[]]
    ledger.scan(v, new)
    assert ends(old) == [[("assign", 16)]] and ends(new) == [[("assign", 14)]]


def test_sanitising_against_a_plain_walk(spark):
    """Random texts of pieces that match, overlap or do neither."""
    rng = random.Random(3)
    pieces = ["a.b@c.example", "10.0.0.1", "+1 415 555 0100", "4111 1111 1111 1111", "word", "é", "9.9.9.9@x.y", "+4111111111111111", "\U0001f600", "300.1.1.1"]
    texts = ["".join(rng.choice(pieces) + rng.choice([" ", ", ", ""]) for _ in range(rng.randint(0, 12))) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in pii.find_personal_data(docs, min_support=10**6).collect()}
    for r in pii.sanitise(docs, min_support=10**6).collect():
        text, out, at = texts[r.doc_id], "", 0
        for s in spans[r.doc_id]:
            assert text[s.start : s.end] == s.value
            if s.start >= at:
                out += text[at : s.start] + pii.PLACEHOLDERS[s.kind]
            at = max(at, s.end)
        assert r.text == out + text[at:]


def test_many_matches_and_all_scripts(spark):
    many = " ".join(f"user{i}@host{i}.example" for i in range(8000))
    found = pii.find_personal_data(spark.createDataFrame([(1, many)], "doc_id long, text string")).first().spans
    assert [(s.start, s.end) for s in found if s.kind == "email"] == [m.span() for m in re.finditer(r"\S+", many)]
    rows = [(i, f"{i} 王 wrote zz@mail.example on day{i}") for i in range(5)] + [(10 + i, f"plain text of many words {i}") for i in range(60)]
    out = {r.doc_id: r.text for r in pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert not any("王" in out[i] for i in range(5))


def test_terms_are_generalised_by_kind(spark):
    rows = [("term", "1987b", "0000b"), ("term", "Ödön", "[NAME]"), ("term", "word", "[WORD]"), ("cut", "x", ""), ("email", "a@b.c", "[EMAIL]")]
    df = spark.createDataFrame(rows, "kind string, value string, want string")
    assert df.where(pii.stand_in(F.struct("kind", "value")) != F.col("want")).count() == 0


def test_sanitising_cuts_what_gives_an_entity_away(spark):
    rows = [(i, f"line {i} Zorblat wrote as zz@mail.example today{i} again") for i in range(5)] + [(10 + i, f"plain text of many words {i}") for i in range(60)]
    out = {r.doc_id: r.text for r in pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all("Zorblat" not in out[i] and "zz@mail" not in out[i] and "[EMAIL]" in out[i] for i in range(5))
    assert all(out[d] == t for d, t in rows if d >= 10)


def test_disclosing_terms_are_found_in_either_case_of_any_alphabet(spark):
    rows = [(i, f"line {i} Ångström wrote as zz@mail.example today{i} again") for i in range(5)] + [(10 + i, f"plain text of many words {i}") for i in range(60)]
    out = {r.doc_id: r.text for r in pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all("Ångström" not in out[i] for i in range(5)) and all(out[d] == t for d, t in rows if d >= 10)


def test_disclosure_counts_texts_and_reaches_every_document(spark):
    told = "Zorblat wrote as zz@mail.example on Monday"
    rows = [(i, f"{told} {i}") for i in range(3)] + [(100 + i, f"{told} 0") for i in range(300)]
    rows += [(1000, "met Zorblat there"), *((2000 + i, f"plain text of many words {i}") for i in range(2000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    terms = {r.term: r for r in pii.disclosing_terms(docs, pii.entity_contexts(docs)).collect()}
    assert (terms["zorblat"].support, terms["zorblat"].doc_freq) == (3, 4)
    out = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert len(out) == len(rows) and not any("Zorblat" in t for t in out.values())
    assert all(out[d] == t for d, t in rows if d >= 2000)


def test_packing_round_trip(spark):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path("byte_bpe_50k.json"))
    texts = ["", "hello world", "Ça va? " * 900, "x", "a b c " * 300, "<|endoftext|> z"] + [f"text {i} " * (i % 50) for i in range(200)]
    rows = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), path("byte_bpe_50k.json")).collect()
    at, filled = {}, Counter()
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        ids = t.encode(texts[r.doc_id], add_special_tokens=False).ids + [0]
        assert r.start == at.get(r.doc_id, 0) and r.doc_tokens == len(ids)
        at[r.doc_id] = r.start + r.length
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], dtype="<u4").tobytes())
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled[r.sequence_id]
        filled[r.sequence_id] += r.length
    assert len(at) == len(texts) and max(filled.values()) <= 1024 and sum(v < 1024 for v in filled.values()) <= 1


def test_packing_ends_on_many_short_documents(spark):
    from public_tokenizers import path

    rows = [(i, "hi there") for i in range(20_000)] + [(20_000 + i, "a longer text of some words " * (i % 9)) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    for size, open_windows in ((1024, 16), (16, 2)):
        out = packing.pack(docs, path("byte_bpe_50k.json"), size, open_windows)
        filled = {r.sequence_id: r.n for r in out.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()}
        assert max(filled.values()) <= size and sum(n < size for n in filled.values()) <= 1
        assert out.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t")).where("n = t").count() == len(rows)


def test_other_parameters_are_caught_and_loose_slots_are_not(spark, benchmark):
    item = benchmark.where("item_id = 1").first().text
    docs = [(1, "Before it. " + item), (2, item.replace("40", "95").replace("7 hours", "12 hours").replace("Anna", "Berta")), (3, "a train is not in this text at all but many other words are here"), (None, item)]
    got = {(r.doc_id, r.item_id): r for r in decontamination.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), benchmark).collect()}
    assert set(got) == {(1, 1), (2, 1), (None, 1)} and got[2, 1].n_changed >= 2 and got[1, 1].n_changed == 0


def test_a_loose_copy_hides_no_exact_one_and_slots_alone_are_found(spark):
    one = "a bus needs 30 minutes for the way to the old mill and a car needs 30 minutes for the way back to the town"
    two = one.replace("30", "12", 1)
    numbers = "17 23 99 41 57 63 88 12 75 31"
    benchmark = spark.createDataFrame([(1, one), (2, numbers)], "item_id long, text string")
    rows = [(1, f"{one}. Also: {two}."), (2, two), (3, f"see {numbers} there"), (4, "see 18 24 98 42 58 64 89 13 76 32 there")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, benchmark).collect()} == {(1, 1), (3, 2)}


def test_short_items_are_found_by_exact_copies(spark):
    benchmark = spark.createDataFrame([(1, "What is 7 times 8 plus 9?"), (2, "yes"), (3, None)], "item_id long, text string")
    rows = [(1, "so: what is 7 times 8 plus 9, said he"), (2, "Yes"), (3, "yes it is"), (4, None), (5, "what is 7 times 9 plus 9")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, benchmark).collect()} == {(1, 1), (2, 2)}


def plain_leaks(docs, items):
    """The rule for texts of lower-case words and whole numbers: windows, slots and coverage by loops."""
    number, form = re.compile(r"[0-9]+$"), lambda w: "#" if w.isdigit() else w
    out = set()
    for item_id, item in items:
        q = item.split()
        telling = [i for i in range(len(q) - 7) if sum(not number.match(w) for w in q[i : i + 8]) >= 4]
        for doc_id, text in docs:
            t, found = text.split(), set()
            for shift in range(-len(q), len(t)):
                at = [i for i in telling if 0 <= i + shift <= len(t) - 8 and [form(w) for w in q[i : i + 8]] == [form(w) for w in t[i + shift : i + shift + 8]]]
                slots = {(q[k], t[k + shift]) for i in at for k in range(i, i + 8) if number.match(q[k])}
                if at and len({a for a, _ in slots}) == len(slots):
                    found |= set(at)
            if telling and len(found) >= 0.5 * len(telling):
                out.add((doc_id, item_id))
    return out


def test_leaks_against_plain_loops(spark):
    rng = random.Random(11)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "so") for b in ("ra", "te", "pi", "du")]
    item = lambda: " ".join(str(rng.randint(1, 30)) if rng.random() < 0.2 else rng.choice(words) for _ in range(rng.randint(9, 24)))
    items = [(i, item()) for i in range(25)]
    docs = []
    for d in range(300):
        t = rng.choice(items)[1].split()
        swap = {w: str(rng.randint(1, 30)) for w in t if w.isdigit()}
        kind = rng.random()
        t = [swap.get(w, w) if kind < 0.4 else str(rng.randint(1, 30)) if w.isdigit() and kind < 0.6 else w for w in t][: rng.randint(6, 24)]
        docs.append((d, " ".join([rng.choice(words) for _ in range(rng.randint(0, 9))] + t + [rng.choice(words) for _ in range(rng.randint(0, 9))])))
    got = decontamination.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == plain_leaks(docs, items)


def test_signatures_estimate_weighted_jaccard():
    a = {i: 1 + i % 5 for i in range(300)}
    b = {i: 1 + (i + (i % 7 == 0)) % 5 for i in range(40, 340)}
    both = set(a) | set(b)
    want = sum(min(a.get(k, 0), b.get(k, 0)) for k in both) / sum(max(a.get(k, 0), b.get(k, 0)) for k in both)
    keys = [near_dedup.mix(np.array(list(x), dtype=np.uint64) + np.uint64(1)) for x in (a, b)]
    doc = np.concatenate([np.zeros(len(a), int), np.ones(len(b), int)])
    s = near_dedup.signatures(doc, np.concatenate(keys), np.array([*a.values(), *b.values()]), 2, size=4096)
    assert abs((s[0] == s[1]).mean() - want) < 0.04


def test_near_duplicates_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    texts = []
    for g in range(12):
        words = [f"w{g}_{x}" for x in rng.integers(0, 400, 120)]
        for e in range(6):
            own = list(words)
            for k in rng.integers(0, 120, e):
                own[k] = f"new{e}_{k}"
            texts.append(" ".join(own))
    texts += ["tiny", "tiny", "", ""]
    sets = [Counter(tuple(t.split()[i : i + 5]) for i in range(max(1, len(t.split()) - 4))) if t else Counter() for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if texts[i] == texts[j] or (texts[i] and near_dedup.SIMILARITY <= sum((sets[i] & sets[j]).values()) / max(1, sum((sets[i] | sets[j]).values()))):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs).collect()} == dict(enumerate(label))
    assert sorted(r.doc_id for r in near_dedup.drop_near_duplicates(docs).collect()) == sorted(set(label))


def test_near_duplicates_behind_a_hub_are_found(spark):
    """A and B are at 0.816, each at 0.789 to the hub that sketches put nearer: leader rounds test only pairs with the hub."""
    hub = [f"h{i}" for i in range(300)]
    spots = list(range(6, 294, 6))
    random.Random(16).shuffle(spots)
    a, b = list(hub), list(hub)
    for k in spots[:4]:
        a[k] = b[k] = f"c16_{k}"
    for k in spots[4:7]:
        a[k] = f"a16_{k}"
    for k in spots[7:10]:
        b[k] = f"b16_{k}"
    texts = [" ".join(t) for t in (hub, a, b)]
    sets = [{tuple(t.split()[i : i + 5]) for i in range(296)} for t in texts]
    alike = [(i, j) for i in range(3) for j in range(i) if len(sets[i] & sets[j]) >= near_dedup.SIMILARITY * len(sets[i] | sets[j])]
    assert alike == [(2, 1)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs).collect()} == {0: 0, 1: 1, 2: 1}


def test_chains_of_near_copies_over_many_seeds(spark):
    """Documents of 60 to 120 words that each change a few words of an earlier one: every class against all pairs."""
    docs, want = [], {}
    for seed in range(300):
        rng = random.Random(seed)
        held = [[f"s{seed}w{rng.randint(0, 900)}" for _ in range(rng.randint(60, 120))]]
        for e in range(rng.randint(3, 12)):
            own = list(rng.choice(held))
            for k in rng.sample(range(len(own)), rng.randint(1, 4)):
                own[k] = f"s{seed}e{e}k{k}"
            held.append(own)
        sets = [Counter(tuple(t[i : i + 5]) for i in range(len(t) - 4)) for t in held]
        label = list(range(len(held)))
        for i in range(len(held)):
            for j in range(i):
                if sum((sets[i] & sets[j]).values()) >= near_dedup.SIMILARITY * sum((sets[i] | sets[j]).values()):
                    a, b = label[i], label[j]
                    label = [min(a, b) if x in (a, b) else x for x in label]
        docs += [(seed * 100 + i, " ".join(t)) for i, t in enumerate(held)]
        want |= {seed * 100 + i: seed * 100 + x for i, x in enumerate(label)}
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert [d for d in want if got[d] != want[d]] == []


def test_classes_of_the_corpus_against_all_pairs(spark):
    """Every link of the 1,000 documents, by counting common shingles of all pairs, joins one class, and classes hold nothing else."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    bags = {}
    for i, t in rows.items():
        w = (t or "").encode().split()
        bags[i] = Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()
    holders = {}
    for i, bag in bags.items():
        for g in bag:
            holders.setdefault(g, []).append(i)
    common = Counter()
    for g, at in holders.items():
        for x, a in enumerate(at):
            for b in at[:x]:
                common[a, b] += min(bags[a][g], bags[b][g])
    label = {i: i for i in rows}

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    size = {i: sum(bag.values()) for i, bag in bags.items()}
    links = [(a, b) for (a, b), n in common.items() if n >= near_dedup.SIMILARITY * (size[a] + size[b] - n)]
    links += [(a, b) for a in rows for b in rows if a < b and rows[a] is not None and rows[a] == rows[b]]
    for a, b in links:
        a, b = sorted((top(a), top(b)))
        label[b] = a
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs).collect()}
    assert len(links) > 50 and got == {i: top(i) for i in rows}


def plain_kneser_ney(trained, asked, order=4):
    """Interpolated modified Kneser-Ney by dictionaries: log10 probability of each text."""
    pad = "\0" * (order - 1)
    held = {order: Counter(t[i : i + order] for t in (pad + x for x in trained) for i in range(len(t) - order + 1))}
    for n in range(order - 1, 0, -1):
        held[n] = Counter(g[1:] for g in held[n + 1])
    cuts, totals, freed = {}, {n: Counter() for n in held}, {n: Counter() for n in held}
    for n, counts in held.items():
        of = Counter(counts.values())
        if of[1] and of[2]:
            y = of[1] / (of[1] + 2 * of[2])
            cuts[n] = [0.0] + [max(0.0, min(float(k), k - (k + 1) * y * of[k + 1] / of[k])) if of[k] else k - 0.5 for k in (1, 2, 3)]
        else:
            cuts[n] = [0.0, 0.5, 1.5, 2.5]
        for g, c in counts.items():
            totals[n][g[:-1]] += c
            freed[n][g[:-1]] += cuts[n][min(c, 3)]

    def p(g):
        n = len(g)
        below = p(g[1:]) if n > 1 else 2.0**-16
        total = totals[n][g[:-1]]
        return (held[n][g] - cuts[n][min(held[n][g], 3)] + freed[n][g[:-1]] * below) / total if total else below

    return [sum(math.log10(p((pad + t)[i : i + order])) for i in range(len(t))) for t in asked]


def test_document_scores_against_plain_dictionaries(spark):
    rng = random.Random(2)
    syllable = lambda: rng.choice(["ka", "to", "ми", "ра", "王", "é", "n", " ", ". ", "\n", "\U0001f600"[:1]])
    texts = ["".join(syllable() for _ in range(rng.randint(0, 120))) for _ in range(80)]
    fold = lambda t: "".join(chr(0xE000 + ord(c) % 6400) if ord(c) > 0xFFFF else c for c in t)
    docs = spark.createDataFrame([(i, t, "l") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in kneser_ney.document_scores(docs, kneser_ney.count_ngrams(docs.where("doc_id < 50"))).collect()}
    want = plain_kneser_ney([fold(t) for t in texts[:50]], [fold(t) for t in texts])
    assert all(got[i].n_scored == len(texts[i]) and abs(got[i].log10_prob - w) < 1e-6 for i, w in enumerate(want))


def test_kept_documents_on_unseen_labels(spark):
    """Trained on half of the labels, judged on the other half."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    labels = labels.dropDuplicates(["doc_id"])
    verdicts = kneser_ney.classify(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id")
    rates = {r.quality: r.kept for r in verdicts.groupBy("quality").agg(F.avg(F.col("kept").cast("double")).alias("kept")).collect()}
    assert rates[1] >= 0.95 and rates[0] <= 0.2


def test_kneser_ney_sums_to_one(spark):
    trusted = spark.createDataFrame([("the cat sat on the mat. the dog sat too.",)], "text string")
    codes, _ = kneser_ney.ngram_codes(["the cat"])
    context = int(codes[-1]) >> kneser_ney.BITS
    every = spark.range(1 << kneser_ney.BITS).select((F.col("id") + F.lit(context << kneser_ney.BITS)).alias("code"), F.lit(0).cast("long").alias("n"))
    counts = kneser_ney.count_ngrams(trusted).unionByName(every).groupBy("code").agg(F.sum("n").alias("n"))
    p = kneser_ney.probabilities(counts).where(F.shiftrightunsigned("code", kneser_ney.BITS) == context).agg(F.sum("p")).first()[0]
    assert abs(p - 1) < 1e-9


def test_rollups_of_a_real_tokenizer(spark):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path("byte_bpe_50k.json"))
    want = Counter()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for r in docs.collect():
        want[r.source, r.lang] += len(t.encode(r.text or "", add_special_tokens=False).ids)
    got = {(r.source, r.lang): r.n_tokens for r in queries.token_counts_bpe(spark, "/root/testdata/sf0.001").collect()}
    assert got == {k: n for k, n in want.items() if n}


def test_compaction_keeps_totals_and_ids(spark):
    r = token_counts.TokenRollup(spark, scratch_path(spark, "rollup"))
    counts = spark.createDataFrame([("s", "en", "t", 5), (None, "en", "t", 7)], "source string, lang string, tokenizer string, n_tokens long")
    r.apply("1", token_counts.inserts(counts))
    r.apply("2", token_counts.inserts(counts))
    before = sorted(map(str, r.totals().collect()))
    assert r.compact("c") and not r.compact("c") and r.live().collect()[0].batch == "c"
    assert sorted(map(str, r.totals().collect())) == before and not r.apply("1", token_counts.inserts(counts))
    r.apply("3", token_counts.deletes(counts))
    assert r.compact("d") and sorted((x.n_docs, x.n_tokens) for x in r.totals().collect()) == [(1, 5), (1, 7)]


def test_rollups_ignore_a_second_commit(spark):
    r = token_counts.TokenRollup(spark, scratch_path(spark, "rollup"))
    counts = spark.createDataFrame([("s", "en", "t", 5), ("s", "en", "t", 7)], "source string, lang string, tokenizer string, n_tokens long")
    assert r.apply("1", token_counts.inserts(counts)) and not r.apply("1", token_counts.inserts(counts))
    assert r.apply("2", token_counts.deletes(counts.where("n_tokens = 5")))
    assert [tuple(x) for x in r.totals().collect()] == [("s", "en", "t", 1, 7)]


def test_licence_rules_take_longest_first(spark):
    from waymark.llm.licence_texts import MIT as mit

    rows = [(1, mit), (2, "Words.\nLicensed under CC BY-NC 4.0.\nReleased under the MIT License."), (3, "nothing here")]
    got = {r.doc_id: r.licences for r in license_scans.scan_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: ["MIT"], 2: ["MIT", "CC-BY-NC-4.0"], 3: []}


@pytest.mark.parametrize("mark", ["", "# ", " * "])
def test_licences_as_they_stand_in_files(spark, mark):
    """Wrapped lines, comment marks and a copyright line before each whole text."""
    from waymark.llm import licence_texts

    wrap = lambda text: "\n".join(textwrap.indent(textwrap.fill(b, 70), mark) if b else mark.rstrip() for b in text.split("\n"))
    rows = [(name, f"Some prose.\n\nCopyright (c) 2020 Jane Doe\n\n{wrap(texts[0])}\n") for name, texts in licence_texts.TEXTS.items()]
    rows += [("BSD-3-Clause", wrap(licence_texts.BSD_3.replace("the copyright holder nor", "Foo Inc. nor"))), ("MIT", "// SPDX-License-Identifier: MIT\nint main;")]
    rows += [("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."), ("GPL-2.0", "It is released under the terms of the GNU GPL v2 or later."), ("all-rights-reserved", "x.\nAll rights\nreserved."), ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.")]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    assert {r.doc_id: r.licences for r in license_scans.scan_licences(docs).collect()} == {i: [name] for i, (name, _) in enumerate(rows)}


def test_licence_rules_allow_gaps_and_keep_order(spark):
    rules = [("L", ["a", "b", "c"]), ("M", ["b"])]
    rows = [(["a", "x", "b", "c"], ["L"]), (["b", "a", "c"], ["M"]), (["a", "b", "a", "b", "c"], ["L"]), ([], [])]
    df = spark.createDataFrame(rows, "ids array<string>, want array<string>")
    assert df.where(license_scans.match_licences(F.col("ids"), rules) != F.col("want")).count() == 0


def test_base_scores_against_a_plain_count_and_scores_against_another_dealing(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("A b\tc  a", "en"), (None, None), ("", "de"), (" É é\x0bA", "fr"), ("b b\x1fb \u2028 c", "en")] * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    words = lambda t: [w.lower() for w in re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())] + [b""]
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(w for i, t, _ in rows if not held(i) for w in words(t))
    n, v = sum(c.values()), len(c)
    first = {r.doc_id: r for r in lm_scoring.score_documents(docs).collect()}
    again = {r.doc_id: r for r in lm_scoring.score_documents(docs.repartition(5)).collect()}
    for i, t, _ in rows:
        r = first[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), len(words(t)), sum(c[w] > 0 for w in words(t)), n)
        assert abs(r.base_score - sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words(t))) < 1e-9
        assert abs(r.score - again[i].score) < 1e-4 * abs(r.score)


def test_softmaxes_sum_to_one():
    rng = np.random.default_rng(4)
    observed = [rng.integers(0, 9, shape).astype(float) for shape in lm_scoring.SHAPES_OF_SUMS]
    model = lm_scoring.Model(observed)
    model.class_weights += rng.normal(0, 1, lm_scoring.CLASS_SHAPE).astype(np.float32)
    row = {"lens": [40], "h": rng.integers(0, 65536, 40).astype("<u2").tobytes(), "cls": rng.integers(0, lm_scoring.CLASSES, 40).astype(np.uint8).tobytes()}
    f = lm_scoring.Features(row, "cls")
    assert np.allclose(model.classes(f, slice(0, 40)).sum(axis=1), 1, atol=1e-5) and np.allclose(model.slots(f, slice(0, 40)).sum(axis=1), 1, atol=1e-5)


def test_model_beats_unigrams_on_held_out_documents(spark):
    rows = queries.op2_lm_scoring(spark, "/root/testdata/sf0.001").where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert rows.s > rows.b


def test_lm_held_out_scores_do_not_fall_from_round_to_round(spark):
    """Bits per token over the base score, on documents that training left out."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    gain = lambda n: lm_scoring.score_documents(docs, lm_scoring.RATES[:n]).where("held_out").agg(F.sum(F.col("score") - F.col("base_score")) / F.sum("n_tokens") / math.log10(2)).first()[0]
    by_round = [gain(n + 1) for n in range(len(lm_scoring.RATES))]
    assert by_round[0] > 1 and all(b >= a - 0.005 for a, b in zip(by_round, by_round[1:]))


def test_lm_counts_beyond_32_bits():
    """A word that two chunks have three billion times each."""
    hashes, n = np.array([5], dtype="<u8").tobytes(), np.array([3_000_000_000], dtype="<u4").tobytes()
    table = pa.table({"chunk": pa.array([0, 1], pa.int64()), "part": pa.array([0, 0], pa.int32()), "entries": [hashes] * 2, "kinds": [bytes([3])] * 2, "n": [n] * 2})
    out = lm_scoring._count(table)
    assert [np.frombuffer(c, dtype="<i8").tolist() for c in out.column("c").to_pylist()[1:]] == [[6_000_000_000]] * 2


def test_rollups_take_batch_ids_of_any_text_and_delete_what_a_compaction_covers(spark):
    """Ids that are no folder names count, once, before and after compactions; what a failed attempt left does not."""
    import glob

    path = scratch_path(spark, "rollup")
    r = token_counts.TokenRollup(spark, path)
    one = spark.createDataFrame([("s", "l", "t", 1, 10)], token_counts.TokenRollup.SUMS)
    ids = ["a/b", "a b/c", "__HIVE_DEFAULT_PARTITION__", "", "..", "k=1", "_x", "é\n", "1", "01"]
    assert r.totals().collect() == []
    for i, name in enumerate(ids):
        assert r.apply(name, one)
        if i % 4 == 3:
            assert r.compact(f"compact/{i}")
        assert not r.apply(ids[0], one) and [tuple(x) for x in r.totals().collect()] == [("s", "l", "t", i + 1, 10 * (i + 1))]
    assert len(glob.glob(f"{path.removeprefix('file:')}/deltas/gen=*")) == 1
    one.write.parquet(f"{path}/deltas/gen={r.generation()}/batch=left-by-a-failure")
    assert not r.compact("compact/3") and r.totals().first().n_docs == len(ids)


def test_real_token_counts_on_odd_rows(edge):
    from public_tokenizers import path

    rows = token_counts.bpe_counts(edge, path("byte_bpe_50k.json"), "v").collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in EDGE) and {r.n_tokens for r in rows if r.doc_id in (4, 5)} == {0}
    assert token_counts.bpe_counts(edge.limit(0), path("byte_bpe_50k.json"), "v").collect() == []


def test_classifier_takes_documents_that_are_worked_out_anew(spark):
    """Rows dealt out by chance, which come in other partitions at every reading."""
    rows = [(i, " ".join(PROSE.split()[i % 7 : 60 + i % 11]) if i % 5 else "zqxj " * 60, "en", "a") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(60)], "doc_id long, quality int")
    told = lambda d: sorted((r.doc_id, r.n_scored, round(r.log10_prob, 5), r.kept) for r in kneser_ney.classify(d, labels).collect())
    assert told(docs.repartition(5, F.rand())) == told(docs.coalesce(1))
