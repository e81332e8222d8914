"""Near-duplicates by BagMinHash.

Texts are multisets of five-word shingles. For every shingle, Poisson processes over a dyadic hierarchy of weight
intervals yield points in ascending order; a point counts if its weight level is within the shingle's weight, and a
component keeps the least point that it was dealt. Two signatures agree in a component with the probability of
their weighted Jaccard similarity. Bands of components give candidates, and the multisets themselves decide.

Groups are the components of the graph of verified links. Candidates are drawn in rounds: first from each document to
one leader of a bucket, in turn the best connected and a drawn one, then, in buckets that still hold several groups, between documents of
different groups whose longer sketches leave the similarity open.
Pairs within a group are never listed, and none between groups is left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .kneser_ney import chunks
from .shared import broadcast_if_small, drop_scratch, fresh, keep_rows, materialize, text_hash

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 42, 6
SIZE = BANDS * ROWS
#: One bit of each component: two texts at SIMILARITY differ in SIZE * 0.1 of them, give or take 4.8; 4.5 times that more is let through.
SKETCH = ["s0", "s1", "s2", "s3"]
MOST_BITS = 47
#: Texts that leader rounds leave in buckets of several groups get a longer sketch, let through by the same 4.5 deviations (of 9.6).
FINE_SIZE = 1024
FINE = [f"f{i}" for i in range(FINE_SIZE // 64)]
MOST_FINE_BITS = 145
LEADER_ROUNDS = 3
BUCKET_BLOCK = 2000  # members of a bucket that are compared with as many others in one task


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingles:
    """Hashed shingles of texts; words' hashes are kept for the next text, up to a bound."""

    def __init__(self, most: int = 150_000):
        self.words: dict[bytes, int] = {}
        self.most = most

    def of(self, text: str) -> np.ndarray:
        """A hash for each run of SHINGLE words; a shorter text with words is one shingle."""
        words, known = text.encode("utf-8", "surrogatepass").split(), self.words
        if not words:
            return np.empty(0, dtype=np.uint64)
        if len(known) > self.most:
            known.clear()
        out = []
        for w in words:
            h = known.get(w)
            if h is None:
                h = known[w] = xxhash.xxh3_64_intdigest(w)
            out.append(h)
        hashes = np.array(out, dtype=np.uint64)
        if len(hashes) < SHINGLE:
            hashes = np.concatenate([hashes, np.full(SHINGLE - len(hashes), 0x9E37, dtype=np.uint64)])
        n = len(hashes) - SHINGLE + 1
        acc = np.zeros(n, dtype=np.uint64)
        for k in range(SHINGLE):
            acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n])
        return acc


def signatures(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n_docs: int, size: int = SIZE) -> np.ndarray:
    """n_docs x size. doc, shingle, weight: a row for each distinct shingle of a document. Every document has a row."""
    lowest = np.full((n_docs, size), np.inf)
    flat = lowest.reshape(-1)
    parts = []
    level, low, high = 0, 0, 1
    while (inside := weight > low).any():
        d, h, w = doc[inside], shingle[inside], weight[inside]
        parts.append((d, mix(h + np.uint64((level + 1) * 0xD1B54A32D192ED03 % 2**64)), w, np.full(len(d), low), np.full(len(d), high - low)))
        level, low, high = level + 1, high, high * 2
    d, seed, w, low_, length = (np.concatenate(x) for x in zip(*parts))
    at, step = np.zeros(len(d)), np.zeros(len(d), dtype=np.uint64)
    while len(d):
        points = int(np.clip(40_000 // len(d), 1, 128))
        t = step[:, None] + np.arange(1, points + 1, dtype=np.uint64)[None, :]
        r1 = mix(seed[:, None] + t * np.uint64(0x9E3779B97F4A7C15))
        r2 = mix(r1 ^ np.uint64(0xA0761D6478BD642F))
        gaps = -np.log(((r1 >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / length[:, None]
        gaps[:, 0] += at
        x = np.cumsum(gaps, axis=1)
        component = ((r2 >> np.uint64(32)) % np.uint64(size)).astype(np.int64)
        reached = low_[:, None] + 1 + ((r2 & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0**-32 * length[:, None]).astype(np.int64)
        counts = reached <= w[:, None]
        np.minimum.at(flat, (d[:, None] * size + component)[counts], x[counts])
        at, step = x[:, -1], step + np.uint64(points)
        going = at <= lowest.max(axis=1)[d]
        d, seed, w, low_, length, at, step = (v[going] for v in (d, seed, w, low_, length, at, step))
    return lowest


def banded(lowest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band keys (n x BANDS) and bit sketches (n x 4), both int64."""
    bits = mix(lowest.view(np.uint64))
    keys = np.zeros((len(lowest), BANDS), dtype=np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)[None, :]
    for r in range(ROWS):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + bits[:, r::ROWS])
    return keys.view(np.int64), bit_sketch(lowest)


def bit_sketch(lowest: np.ndarray) -> np.ndarray:
    """A bit of each component, 64 to a column."""
    packed = np.packbits((mix(lowest.view(np.uint64)) & np.uint64(1)).astype(np.uint8), axis=1)
    packed = np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8)))
    return np.ascontiguousarray(packed).view("<i8")


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingles, seen = Shingles(), set()
    for b in batches:
        rows = ((k, t.as_py() or "") for k, t in zip(b.column("key").to_pylist(), b.column("text")))
        for part in chunks(rows, 1_000_000):
            keys, doc, found, times = [], [], [], []
            for key, text in part:
                if key in seen:
                    continue
                if len(seen) < 200_000:
                    seen.add(key)
                hashes, counts = np.unique(shingles.of(text), return_counts=True)
                if len(hashes):
                    doc.append(np.full(len(hashes), len(keys)))
                    keys.append(key)
                    found.append(hashes)
                    times.append(counts)
            if keys:
                bands, bits = banded(signatures(np.concatenate(doc), np.concatenate(found), np.concatenate(times), len(keys)))
                offsets = pa.array(np.arange(0, len(keys) * BANDS + 1, BANDS), pa.int32())
                columns = [pa.array(keys, pa.binary()), pa.ListArray.from_arrays(offsets, pa.array(bands.reshape(-1)))]
                yield pa.RecordBatch.from_arrays([*columns, *[pa.array(np.ascontiguousarray(bits[:, i])) for i in range(4)]], names=["key", "buckets", *SKETCH])


def _refined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key and its longer sketch."""
    shingles = Shingles()
    for b in batches:
        for part in chunks(((k, t.as_py()) for k, t in zip(b.column("key").to_pylist(), b.column("text"))), 250_000):
            found = [np.unique(shingles.of(text), return_counts=True) for _, text in part]
            doc = np.repeat(np.arange(len(part)), [len(h) for h, _ in found])
            bits = bit_sketch(signatures(doc, np.concatenate([h for h, _ in found]), np.concatenate([n for _, n in found]), len(part), FINE_SIZE))
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in part], pa.binary()), *[pa.array(np.ascontiguousarray(bits[:, i])) for i in range(len(FINE))]], names=["key", *FINE])


def text_key(text: str = "text") -> Column:
    """Equal for equal texts. A null text has none."""
    return F.unhex(F.md5(F.col(text).cast("binary")))


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets, given as np.unique() gives them."""
    _, at_a, at_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][at_a], b[1][at_b]).sum())
    return both / max(1, int(a[1].sum()) + int(b[1].sum()) - both)


def verified(pairs: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Pairs (a, b) of keys whose multisets have the similarity."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, last = Shingles(), (None, None)
        for b in batches:
            good = []
            for other, mine, theirs in zip(b.column("b").to_pylist(), b.column("text_a"), b.column("text_b")):
                if last[0] != other:
                    last = (other, np.unique(shingles.of(theirs.as_py()), return_counts=True))
                good.append(overlap(np.unique(shingles.of(mine.as_py()), return_counts=True), last[1]) >= similarity)
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    with_a = pairs.join(texts.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a")
    with_both = with_a.join(texts.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b")
    return with_both.select("a", "b", "text_a", "text_b").mapInArrow(check, "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """key, label: the least key of each component of links (a, b). Labels spread to neighbours and are followed until none changes."""
    edges = materialize(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc-edges")
    labels = edges.groupBy(F.col("a").alias("key")).agg(F.least(F.col("a"), F.min("b")).alias("label"))
    labels = materialize(labels, "cc-labels")
    while True:
        near = edges.join(labels.select(F.col("key").alias("b"), F.col("label").alias("near")), "b").groupBy(F.col("a").alias("key")).agg(F.min("near").alias("near"))
        nearer = materialize(labels.join(near, "key").select("key", F.col("label").alias("old"), F.least("label", "near").alias("label")), "cc-near")
        jumps = nearer.select(F.col("key").alias("label"), F.col("label").alias("next"))
        drop_scratch(labels)
        labels = materialize(nearer.join(jumps, "label").select("key", "old", F.least("label", "next").alias("label")), "cc-labels")
        drop_scratch(nearer)
        if not labels.where(F.col("label") != F.col("old")).take(1):
            drop_scratch(edges)
            return labels.select("key", "label")
        labels = labels.select("key", "label")


def differing(a: str, b: str, sketch: list[str] = SKETCH) -> Column:
    return reduce(add, [F.bit_count(F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))) for s in sketch])


def group_texts(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """key, label for the texts that have a near-duplicate among different texts."""
    keyed = docs.where(F.col("text").isNotNull()).select(text_key().alias("key"), F.col("text").cast("string"))
    signed = materialize(keyed.mapInArrow(_signed, "key binary, buckets array<long>, " + ", ".join(f"{s} long" for s in SKETCH)), "bag-signatures")
    banded_ = signed.select(F.explode("buckets").alias("bucket"), "key")
    short = F.xxhash64("key")
    shared = banded_.groupBy("bucket").agg(F.min(short).alias("low"), F.max(short).alias("high"), F.count(F.lit(1)).alias("size")).where("low <> high").select("bucket", "size")
    slots = materialize(banded_.join(shared, "bucket").distinct(), "bag-slots")
    # A text that shares buckets with many others leads: the one that a group's texts were copied from is close to all of them.
    wanted = broadcast_if_small(materialize(slots.groupBy("key").agg(F.sum("size").alias("degree")), "bag-wanted"))
    sketches = signed.select("key", *SKETCH).join(wanted, "key").distinct()
    members = materialize(slots.select("bucket", "key").join(sketches, "key"), "bag-members")
    texts = materialize(keyed.join(wanted.select("key"), "key", "left_semi").groupBy("key").agg(F.any_value("text").alias("text")), "bag-texts")
    labels, tested, spent = None, None, [slots, members, texts]
    for turn in range(LEADER_ROUNDS + 1):
        now = members.withColumn("label", F.col("key")) if labels is None else members.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
        row = F.struct((F.xxhash64(F.lit(turn), "key") if turn % 2 else -F.col("degree")).alias("draw"), "key", "label", *SKETCH)
        now = now.select("bucket", row.alias("m"))
        tag = F.xxhash64("m.label")
        mixed = now.groupBy("bucket").agg(F.min(tag).alias("low"), F.max(tag).alias("high"), F.min("m").alias("l")).where("low <> high")
        if turn < LEADER_ROUNDS:
            drawn = now.join(mixed.select("bucket", "l"), "bucket").where((F.col("m.label") != F.col("l.label")) & (differing("m", "l") <= MOST_BITS))
            best = drawn.groupBy(F.col("m.key").alias("a")).agg(F.min(F.struct(differing("m", "l").alias("bits"), F.col("l.key").alias("b"))).alias("best"))
            pairs = best.select("a", "best.b")
        else:
            # All that is left: members of any group but a bucket's largest, with the members of every other group.
            mixed_members = materialize(now.join(mixed.select("bucket"), "bucket").select("bucket", "m.key", "m.label"), "bag-mixed")
            if not mixed_members.take(1):
                break
            fine = materialize(texts.join(mixed_members.select("key").distinct(), "key", "left_semi").mapInArrow(_refined, "key binary, " + ", ".join(f"{f} long" for f in FINE)), "bag-fine")
            bands = signed.join(mixed_members.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"]).select("key", "buckets")
            spent += [mixed_members, fine]
            held = materialize(mixed_members.join(fine.join(bands, "key"), "key").select("bucket", F.struct("key", "label", "buckets", *FINE).alias("m")), "bag-held")
            spent.append(held)
            largest = held.groupBy("bucket", F.col("m.label").alias("label")).agg(F.count(F.lit(1)).alias("n")).groupBy("bucket").agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("size"))
            # A bucket's members are dealt to blocks, and a task compares two of its blocks, so that none has a whole large bucket.
            blocks = F.ceil(F.col("size") / BUCKET_BLOCK).cast("int")
            sized = held.join(largest, "bucket").select("bucket", "m", F.col("top.label").alias("top"), F.pmod(F.xxhash64("m.key"), blocks).cast("int").alias("own"), F.sequence(F.lit(0), blocks - 1).alias("each"))
            small = sized.where(F.col("m.label") != F.col("top")).select("bucket", "top", F.col("m").alias("l"), F.col("own").alias("i"), F.explode("each").alias("j"))
            others = sized.select("bucket", "m", F.explode("each").alias("i"), F.col("own").alias("j"))
            apart = (F.col("m.label") != F.col("l.label")) & ((F.col("m.label") == F.col("top")) | (F.col("l.key") < F.col("m.key"))) & (differing("m", "l", FINE) <= MOST_FINE_BITS)
            # A pair is taken in the first of the buckets that it shares, and so once.
            before = F.array_position("m.buckets", F.col("x.bucket")).cast("int") - 1
            shared_before = F.exists(F.zip_with(F.slice("m.buckets", F.lit(1), before), F.slice("l.buckets", F.lit(1), before), lambda p, q: p == q), lambda same: same)
            joined = small.alias("x").join(others.alias("y"), (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.i") == F.col("y.i")) & (F.col("x.j") == F.col("y.j")) & apart & ~shared_before)
            pairs = joined.select(F.col("m.key").alias("a"), F.col("l.key").alias("b"))
        pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "bag-pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        links = materialize(verified(pairs, texts, similarity), "bag-links")
        spent += [pairs, links]
        # A leader round without links, or even without pairs, does not show that none are left: the last round decides.
        if not links.take(1):
            continue
        if labels is None:
            labels = components(links)
        else:
            # Links between groups join their labels; texts without a group stand for themselves.
            of = lambda c: labels.select(F.col("key").alias(c), F.col("label").alias(f"{c}_label"))
            between = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("a_label", "a").alias("a"), F.coalesce("b_label", "b").alias("b"))
            merged = components(between).select(F.col("key").alias("label"), F.col("label").alias("top"))
            alone = merged.join(labels.select("label").distinct(), "label", "left_anti").select(F.col("label").alias("key"), F.col("top").alias("label"))
            labels = materialize(labels.join(merged, "label", "left").select("key", F.coalesce("top", "label").alias("label")).unionByName(alone), "bag-labels")
    for table in spent:
        drop_scratch(table)
    return labels if labels is not None else signed.select("key", F.col("key").alias("label")).limit(0)


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, text_hash, class_id (the least doc_id among near-duplicates and copies), copy_of (the least among equal texts).

    A row for each row of docs. Texts of any length are compared whole; empty texts are copies of each other; a null text is in a class with no other row of
    another id; a text under five words is one shingle; ties fall to the least id; null ids are carried and never
    lead a class that has another id; an empty table gives an empty table; other columns are not read.
    """
    keyed = materialize(docs.select("doc_id", text_hash().alias("text_hash"), F.coalesce(text_key(), F.unhex(F.md5(F.concat(F.lit("null "), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")))).alias("key")), "dedup-keys")
    labels = group_texts(docs, similarity)
    grouped = materialize(keyed.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key")), "dedup-grouped")
    copies = grouped.groupBy("key").agg(F.min("doc_id").alias("copy_of"), F.first("label").alias("label"))
    classes = copies.groupBy("label").agg(F.min("copy_of").alias("class_id"))
    leads = materialize(copies.join(classes, "label").select("key", "copy_of", "class_id"), "dedup-leads")
    return keyed.join(leads, "key").select("doc_id", "text_hash", "class_id", "copy_of")


def drop_near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row of docs, with all its columns, for each class: that of the least doc_id."""
    found = materialize(near_duplicates(docs, similarity), "dedup-classes")
    first = materialize(found.where(F.col("class_id").isNotNull()).groupBy("class_id").agg(F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_hash"))).alias("first")).select("first.*"), "dedup-first")
    nameless = found.where(F.col("class_id").isNull()).select("doc_id", "text_hash")
    keys = first.unionByName(nameless)
    kept = keep_rows(docs, keys.distinct())
    repeated = found.join(first, ["doc_id", "text_hash"]).groupBy("doc_id", "text_hash").count().where("count > 1").take(1)
    own = fresh(docs, "own_hash")
    return kept.withColumn(own, text_hash()).dropDuplicates(["doc_id", own]).drop(own) if repeated or nameless.take(1) else kept
