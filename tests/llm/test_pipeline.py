import zlib
from collections import Counter, defaultdict

import numpy as np

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ITEM = "A train leaves at 40 km per hour and reaches the far town after 7 hours of travel, said the teacher Anna to the class"


def prose(seed, n=90):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(3, 9))) for _ in range(n))


def tables(spark, folder, docs):
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_stages_take_effect_and_keep_clean_documents(spark, tmp_path):
    """Against the texts that must be left, tokenised plainly: copies, leaks, short and null texts go, an address is replaced."""
    from public_tokenizers import path
    from tokenizers import Tokenizer

    docs = [
        (1, prose(1, 200), "en", "a", 9),
        (2, prose(1, 200), "en", "a", 9),
        (3, prose(1, 200).replace(prose(1, 200).split()[100], "altered"), None, "b", None),
        (4, "too short", "en", "a", 9),
        (5, None, None, None, None),
        (6, prose(6) + " " + ITEM.replace("40", "95").replace("7 hours", "12 hours") + " " + prose(7), "en", "a", 9),
        (7, prose(8) + " write to some.one@mail.example now " + prose(9), "de", "b", 9),
        (8, prose(10, 3000), "de", None, 9),
        (9, " ".join([prose(11, 5)] * 30), "en", "a", 9),
        (None, prose(12), "en", "a", 9),
        (10, "", "en", "a", 0),
    ]
    left = {1: docs[0][1], 7: docs[6][1].replace("some.one@mail.example", "[EMAIL]"), 8: docs[7][1], None: docs[9][1]}
    rows = corpus_pipeline.run(spark, tables(spark, tmp_path, docs)).collect()
    t = Tokenizer.from_file(path("byte_bpe_50k.json"))
    pieces, filled = defaultdict(list), Counter()
    for r in rows:
        pieces[r.doc_id].append(r)
        filled[r.sequence_id] += r.length
    assert set(pieces) == set(left) and max(filled.values()) <= 1024
    for doc_id, text in left.items():
        ids, at = t.encode(text, add_special_tokens=False).ids + [0], 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], dtype="<u4").tobytes())
            at += r.length
        assert at == len(ids)


def test_every_stage_takes_an_empty_table_and_other_columns(spark, tmp_path):
    docs = [(1, prose(1), "en", "a", 9), (None, None, None, None, None)]
    folder = tables(spark, tmp_path, docs)
    wide = spark.createDataFrame([(*d, "x", 1, 2.0) for d in docs], SCHEMA + ", spans string, text_hash long, kept double")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, wide, folder)
        assert name == "packing" or out.columns == corpus_pipeline.COLUMNS
        assert 1 in {r.doc_id for r in out.collect()}, name
        assert stage(spark, wide.limit(0), folder).count() == 0, name


def test_stages_on_an_empty_benchmark_and_very_long_and_repeated_texts(spark, tmp_path):
    """Ten times the longest text of other tests, copies of it, rows that are equal in all columns."""
    long = prose(21, 30_000) + " " + "y" * 300_000 + " reach me at long.one@mail.example now " + prose(22, 2000)
    docs = [(1, long, "en", "a", 9), (2, long, "en", "a", 9), (2, long, "en", "a", 9), (3, prose(23, 200), None, None, None), (3, prose(23, 200), None, None, None), (None, prose(24, 200), "en", "a", 9)]
    folder = tables(spark, tmp_path, docs)
    spark.createDataFrame([], "item_id long, text string").write.mode("overwrite").parquet(f"{folder}/benchmark.parquet")
    frame = spark.createDataFrame(docs, SCHEMA)
    out = {name: stage(spark, frame, folder).collect() for name, stage in corpus_pipeline.STAGES}
    assert [len(out[n]) for n in ("quality_rules", "near_dedup", "decontamination", "pii")] == [6, 3, 6, 6]
    assert Counter(r.doc_id for r in out["near_dedup"]) == Counter([1, 3, None])
    assert {r.text for r in out["pii"] if r.doc_id in (1, 2)} == {long.replace("long.one@mail.example", "[EMAIL]")}
    ids = Counter()
    for r in out["packing"]:
        ids[r.doc_id] += r.length
    by_doc = {r.doc_id: r.doc_tokens for r in out["packing"]}
    assert ids == {d: n * Counter(x[0] for x in docs)[d] for d, n in by_doc.items()} and by_doc[1] > 30_000


def test_classifier_and_leaks_without_labels_or_items(spark):
    from waymark.llm import decontamination, kneser_ney

    docs = spark.createDataFrame([(1, prose(1), "en", "a", 9), (2, None, None, None, None)], SCHEMA)
    assert decontamination.contaminated(docs, spark.createDataFrame([], "item_id long, text string")).collect() == []
    out = kneser_ney.classify(docs, spark.createDataFrame([], "doc_id long, quality int")).collect()
    assert sorted(r.doc_id for r in out) == [1, 2] and not any(r.kept for r in out)
