"""Quality by an interpolated modified Kneser-Ney model of trusted text.

The model predicts characters from the ORDER - 1 before them, as they are in any script. Counts are gathered over trusted
documents and sharded by n-gram; joins of counts, contexts and lower orders give the probability of every n-gram that
occurs in the corpus. Chunks of documents ask for their different n-grams once each, the answers are joined to them by
n-gram and go back to the chunks, whose texts they score. Documents whose perplexity is above a quantile of their
language's trusted documents that the model was not trained on are rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import broadcast_if_small, drop_scratch, materialize, merge_sketches, sketch, sketch_quantiles, text_hash

ORDER, BITS = 4, 16  # an n-gram is a long of ORDER characters
PAD = "\0" * (ORDER - 1)  # before a text
PART, CHUNK = 1_000_000, 32_000_000  # characters that are worked on at once, and that ask together
#: Trusted documents whose id's hash is 0 by this number set cutoffs, the others train.
FOLDS = 10
#: Documents that the cutoff of all languages weighs as much as in a language's.
PRIOR = 50


def ngram_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram code that ends at each character, and where each text's codes begin (one more for the end). Characters beyond the first plane share 6,400 places of it, which are private."""
    joined = "".join(PAD + t for t in texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    points = np.where(points >= 1 << BITS, 0xE000 + points % 6400, points).astype(np.uint64)
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    codes = points[ORDER - 1 :].copy()
    for back in range(1, ORDER):
        codes |= points[ORDER - 1 - back : len(points) - back] << np.uint64(BITS * back)
    inside = np.arange(starts[-1]) + np.repeat(len(PAD) * np.arange(len(texts)), lengths)
    return codes.view(np.int64)[inside], starts


def chunks(rows: Iterator[tuple], size: int) -> Iterator[list[tuple]]:
    """Lists of rows whose last members, texts, have about size characters together."""
    held, n = [], 0
    for row in rows:
        held.append(row)
        n += len(row[-1])
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


def counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different codes and how often each occurs."""
    coded = pa.array(codes).dictionary_encode()
    return coded.dictionary.to_numpy(), np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, place = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    return codes, np.bincount(place, weights=np.concatenate([n for _, n in parts]), minlength=len(codes)).astype(np.int64)


def _text_rows(b: pa.RecordBatch) -> Iterator[tuple[str]]:
    return ((x.as_py() or "",) for x in b.column("text"))


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for part in chunks((row for b in batches for row in _text_rows(b)), PART):
        codes, _ = ngram_codes([x for (x,) in part])
        held.append(counted(codes))
        size += len(codes)
        if size >= CHUNK:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in merged(held)], names=["code", "n"])
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in merged(held)], names=["code", "n"])


def count_ngrams(texts: DataFrame) -> DataFrame:
    """code and n, sharded by code."""
    return texts.select(F.col("text").cast("string")).mapInArrow(_gram_counts, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def suffix(order: int) -> Column:
    """The last order characters of code."""
    return F.col("code").bitwiseAND(F.lit((1 << BITS * order) - 1)) if order < ORDER else F.col("code")


def _discounts(counts: DataFrame) -> DataFrame:
    """d1, d2, d3 from the counts of counts, one row; where these are too few, the plain steps."""
    of = [F.sum(F.when(F.col("n") == k, 1).otherwise(0)).alias(f"n{k}") for k in (1, 2, 3, 4)]
    y = "n1 / (n1 + 2 * n2)"
    d = lambda k: F.expr(f"coalesce(greatest(0.0D, least({k}.0D, try_subtract({k}, try_divide({k + 1} * ({y}) * n{k + 1}, n{k})))), {k} - 0.5D)")
    return counts.agg(*of).select(*[F.coalesce(F.when(F.expr("n1 > 0 and n2 > 0"), d(k)), F.lit(k - 0.5)).cast("double").alias(f"d{k}") for k in (1, 2, 3)])


def probabilities(counts: DataFrame) -> DataFrame:
    """code, p for every row of counts (code, n), of the highest order. n is 0 for n-grams that training did not see.

    Order by order from the lowest: an n-gram's own discounted share of its context, and what the context's
    discounts free times the probability of the n-gram without its first character.
    """
    asked = {ORDER: counts.select("code")}
    held = {ORDER: counts.where("n > 0")}
    for order in range(ORDER - 1, 0, -1):
        asked[order] = asked[order + 1].select(suffix(order).alias("code")).distinct()
        held[order] = held[order + 1].groupBy(suffix(order).alias("code")).agg(F.count(F.lit(1)).alias("n"))
    lower = None
    for order in range(1, ORDER + 1):
        have = held[order].join(F.broadcast(_discounts(held[order])))  # one row
        step = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        have = have.select("code", "n", step.alias("cut"))
        context = F.shiftrightunsigned("code", BITS).alias("context")
        of_context = have.groupBy(context).agg(F.sum("n").alias("total"), F.sum("cut").alias("freed"))
        rows = asked[order].join(have, "code", "left").withColumn("context", context).join(of_context, "context", "left")
        if lower is None:
            rows = rows.withColumn("below", F.lit(2.0**-BITS))
        else:
            rows = rows.withColumn("shorter", suffix(order - 1)).join(lower.select(F.col("code").alias("shorter"), F.col("p").alias("below")), "shorter")
        p = F.when(F.col("total") > 0, (F.coalesce("n", F.lit(0)) - F.coalesce("cut", F.lit(0.0))) / F.col("total") + F.col("freed") / F.col("total") * F.col("below")).otherwise(F.col("below"))
        lower = materialize(rows.select("code", p.alias("p")), f"kn-order-{order}")
    return lower


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[list[int], list[str]]], list[pa.RecordBatch]]]:
    """Chunks in the order of rows: their number, parts of (row indices, texts), and the rows' other columns. Reading a partition again gives the same chunks."""
    number, parts, others, size, row = TaskContext.get().partitionId() << 24, [], [], 0, 0
    for b in batches:
        others.append(b.drop_columns(["text"]))
        for part in chunks(_text_rows(b), PART):
            texts = [x for (x,) in part]
            parts.append((list(range(row, row + len(texts))), texts))
            row, size = row + len(texts), size + sum(map(len, texts))
        if size >= CHUNK:
            yield number, parts, others
            number, parts, others, size, row = number + 1, [], [], 0, 0
    if parts:
        yield number, parts, others


def _shipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each chunk: its documents' columns, and their texts, compressed part by part."""
    packer = zstandard.ZstdCompressor(level=9)
    for number, parts, others in _dealt(batches):
        told = pa.Table.from_batches(others)
        blobs = [packer.compress("".join(texts).encode("utf-8", "surrogatepass")) for _, texts in parts]
        lens = [[len(t) for t in texts] for _, texts in parts]
        columns = [[number], *[[told.column(c).to_pylist()] for c in told.column_names], [lens], [blobs]]
        kinds = [pa.int64(), *[pa.list_(f.type) for f in told.schema], pa.list_(pa.list_(pa.int32())), pa.list_(pa.binary())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["chunk", *told.column_names, "lens", "blobs"])


def _texts(lens: list[list[int]], blobs: list[bytes]) -> Iterator[list[str]]:
    """The texts of a chunk, part by part."""
    unpacker = zstandard.ZstdDecompressor()
    for own, blob in zip(lens, blobs):
        joined, ends = unpacker.decompress(blob).decode("utf-8", "surrogatepass"), np.cumsum(own)
        yield [joined[e - n : e] for n, e in zip(own, ends)]


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different n-grams of each chunk."""
    for b in batches:
        for i, number in enumerate(b.column("chunk").to_pylist()):
            codes, _ = merged([counted(ngram_codes(texts)[0]) for texts in _texts(b.column("lens")[i].as_py(), b.column("blobs")[i].as_py())])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(codes), number)), pa.array(codes)], names=["chunk", "code"])


def _scored(left: pa.Table, right: pa.Table) -> pa.Table:
    """A chunk's documents with n_scored and log10_prob."""
    order = np.argsort(right.column("code").to_numpy())
    codes, values = right.column("code").to_numpy()[order], right.column("log10_p").to_numpy()[order]
    sums, sizes = [], []
    for texts in _texts(left.column("lens")[0].as_py(), left.column("blobs")[0].as_py()):
        own, starts = ngram_codes(texts)
        coded = pa.array(own).dictionary_encode()
        at = np.searchsorted(codes, coded.dictionary.to_numpy())
        upto = np.concatenate([[0.0], np.cumsum(values[at][coded.indices.to_numpy()] if len(own) else own)])
        sums.append(upto[starts[1:]] - upto[starts[:-1]])
        sizes.append(np.diff(starts))
    names = [c for c in left.column_names if c not in ("chunk", "lens", "blobs")]
    return pa.table([*[left.column(c).combine_chunks().flatten() for c in names], pa.array(np.concatenate(sizes)), pa.array(np.concatenate(sums))], names=[*names, "n_scored", "log10_prob"])


def document_scores(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """doc_id, text_hash, lang, n_scored, log10_prob by the model of counts.

    Documents are read once, into a scratch table of compressed chunks. A chunk has a row for each of its n-grams, so that
    none of these, however common, has more rows than there are chunks.
    """
    told = docs.select("doc_id", text_hash().alias("text_hash"), F.coalesce("lang", F.lit("")).alias("lang"), F.col("text").cast("string"))
    kind = told.schema["doc_id"].dataType.simpleString()
    shipped = materialize(told.mapInArrow(_shipped, f"chunk long, doc_id array<{kind}>, text_hash array<long>, lang array<string>, lens array<array<int>>, blobs array<binary>"), "kn-shipped")
    asked = materialize(shipped.select("chunk", "lens", "blobs").mapInArrow(_asked, "chunk long, code long"), "kn-asked")
    every = asked.select("code").distinct().join(counts, "code", "full_outer").select("code", F.coalesce("n", F.lit(0)).alias("n"))
    table = probabilities(materialize(every, "kn-counts"))
    values = asked.join(table.select("code", F.log10("p").alias("log10_p")), "code")
    scored = materialize(shipped.groupBy("chunk").cogroup(values.groupBy("chunk")).applyInArrow(_scored, f"doc_id {kind}, text_hash long, lang string, n_scored long, log10_prob double"), "kn-scored")
    drop_scratch(shipped)
    drop_scratch(asked)
    return scored


def classify(docs: DataFrame, labels: DataFrame, quantile: float = 0.995, slack: float = 1.05) -> DataFrame:
    """doc_id, text_hash, lang, n_scored, log10_prob, perplexity, cutoff, kept: a row for each row of docs.

    Trusted are the documents that labels (doc_id, quality) gives quality 1; a FOLDS-th of them, by their ids' hashes, is
    not trained on. A cutoff is slack times the quantile of these documents' perplexities in the language, shrunk towards that
    of all languages; where no trusted document was left out, of those trained on. Null and empty texts have no perplexity
    and are not kept; texts of any length are scored whole; a perplexity equal to the cutoff is kept; null languages are one
    group; without trusted documents nothing is kept; equal rows get equal results; an empty table gives an empty table;
    other columns are not read.
    """
    held = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)) == 0
    trusted = materialize(labels.where("quality = 1").select("doc_id").distinct().withColumn("held", held), "kn-trusted")
    trained = docs.select("doc_id", "text").join(broadcast_if_small(trusted.where("not held").select("doc_id")), "doc_id", "left_semi")
    counts = materialize(count_ngrams(trained), "kn-trained")
    perplexity = F.when(F.col("n_scored") > 0, F.pow(F.lit(10.0), -F.col("log10_prob") / F.col("n_scored"))).alias("perplexity")
    scored = document_scores(docs, counts).select("*", perplexity)
    bins = materialize(sketch(scored.join(trusted, "doc_id"), ["lang", "held"], "perplexity"), "kn-sketch")
    every = lambda df, name: sketch_quantiles(merge_sketches(df.withColumn("all", F.lit(1)), ["all"]), ["all"], {name: quantile}).select("all", name)
    overall = every(bins, "any_cut").join(every(bins.where("held"), "held_cut"), "all", "left").select(F.coalesce("held_cut", "any_cut").alias("all_cut"))
    own = sketch_quantiles(bins.where("held"), ["lang"], {"own_cut": quantile}).withColumnRenamed("n_values", "own_n")
    n = F.coalesce("own_n", F.lit(0))
    cut = F.lit(slack) * (n * F.coalesce("own_cut", F.lit(0.0)) + F.lit(PRIOR) * F.col("all_cut")) / (n + F.lit(PRIOR))
    languages = scored.select("lang").distinct().join(own, "lang", "left").join(F.broadcast(overall), how="left")  # overall is one row
    judged = scored.join(broadcast_if_small(materialize(languages.select("lang", cut.alias("cutoff")), "kn-cuts")), "lang", "left")
    return judged.select("doc_id", "text_hash", "lang", "n_scored", "log10_prob", "perplexity", "cutoff", F.coalesce(F.col("perplexity") <= F.col("cutoff"), F.lit(False)).alias("kept"))
