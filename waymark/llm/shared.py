"""What several operators share: scratch tables, checked broadcasts, text keys, mergeable quantile sketches, spans."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.places import before_parts, in_order, numbered  # noqa: F401
from ..sources.scratch import delete_folder, materialize, scratch_path  # noqa: F401

#: The four readable columns of a document besides its id; what else a table has is carried along or left out, never read.
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_scratch(df: DataFrame) -> None:
    """Delete the folder of a scratch table that nothing reads any more."""
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/waymark/" in name:
            delete_folder(df.sparkSession, name)


def _width(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.aggregate(value, F.lit(16).cast("long"), lambda n, x: n + _width(x, kind.elementType)), F.lit(16))
    return F.lit(8)


def table_bytes(df: DataFrame) -> int:
    """About the bytes of a table in memory, by the lengths of its texts and arrays."""
    return df.select(sum((_width(F.col(f"`{f.name}`"), f.dataType).cast("long") for f in df.schema), F.lit(0)).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def broadcast_if_small(df: DataFrame, max_bytes: int = 32 << 20) -> DataFrame:
    """A broadcast hint only after measuring; a larger table is joined by shuffling. Give it tables that are cheap to work out twice."""
    return F.broadcast(df) if table_bytes(df) <= max_bytes else df


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_hash(text: str = "text") -> Column:
    """With doc_id it tells rows of one id and different texts apart."""
    return F.xxhash64(F.col(text), F.col(text).isNull())


def keep_rows(docs: DataFrame, keys: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows of docs whose (doc_id, text_hash) is among keys; left_anti: is not. A null id equals a null id."""
    id_, hash_ = fresh(docs, "key_id"), fresh(docs, "key_hash")
    keys = keys.select(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_))
    return docs.join(keys, docs["doc_id"].eqNullSafe(F.col(id_)) & (text_hash() == F.col(hash_)), how)


# Mergeable quantile sketch: values fall into bins whose edges are powers of GAMMA, and a sketch is its bins' counts.
# Adding counts merges sketches, in any order and with one result; a quantile is off by half a bin at most.
GAMMA = 1.02
ZERO_BIN = -1_000_000


def sketch_bin(value: Column) -> Column:
    return F.when(value > 0, F.ceil(F.log(value) / F.lit(math.log(GAMMA))).cast("int")).otherwise(F.lit(ZERO_BIN))


def sketch_value(bin_: Column) -> Column:
    return F.when(bin_ == ZERO_BIN, F.lit(0.0)).otherwise(F.pow(F.lit(GAMMA), bin_) * F.lit(2 / (1 + GAMMA)))


def sketch(values: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """keys, bin, n. Null values are not counted."""
    return values.where(F.col(value).isNotNull()).groupBy(*keys, sketch_bin(F.col(value)).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def merge_sketches(bins: DataFrame, keys: list[str]) -> DataFrame:
    return bins.groupBy(*keys, "bin").agg(F.sum("n").alias("n"))


def sketch_quantiles(bins: DataFrame, keys: list[str], quantiles: dict[str, float]) -> DataFrame:
    """keys, n_values and a column per quantile. A group has as many rows as bins, however many values it stands for."""
    by = Window.partitionBy(*keys)
    upto = F.sum("n").over(by.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    ranked = bins.withColumn("upto", upto).withColumn("total", F.sum("n").over(by))
    asked = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), F.lit(q).alias("q")) for name, q in quantiles.items()]))
    reached = ranked.select(*keys, "bin", "upto", "total", asked.alias("a")).where(F.col("upto") >= F.ceil(F.col("total") * F.col("a.q")))
    found = reached.groupBy(*keys, F.col("a.name").alias("name")).agg(F.max("total").alias("total"), sketch_value(F.min("bin")).alias("value"))
    named = found.groupBy(*keys).agg(F.max("total").alias("n_values"), F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("q"))
    return named.select(*keys, "n_values", *[F.col("q")[name].alias(name) for name in quantiles])


# Spans found with SQL functions: split() gives what lies between matches, regexp_extract_all() the matches; running lengths give code point offsets.
SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("rank", T.IntegerType()), T.StructField("end", T.LongType()), T.StructField("kind", T.StringType()), T.StructField("value", T.StringType())])
SPANS = T.ArrayType(SPAN)


def let(value: Column, body) -> Column:
    """body(value), where value is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(values: Column, combine) -> Column:
    """Prefix sums (or what combine makes) of an array of longs, each with its own element. Reach doubles from step to step, so n elements take n log n work."""
    reaches = lambda v: F.filter(F.transform(F.sequence(F.lit(0), F.lit(30)), lambda k: F.pow(F.lit(2), k).cast("int")), lambda reach: reach < F.size(v))
    both = lambda v, reach: F.zip_with(F.slice(v, reach + 1, F.size(v)), F.slice(v, F.lit(1), F.size(v) - reach), combine)
    return let(values, lambda whole: F.aggregate(reaches(whole), whole, lambda v, reach: F.concat(F.slice(v, F.lit(1), reach), both(v, reach))))


CHUNK = 1024


def chunked(text: Column) -> Column:
    """A text in pieces of CHUNK characters, of which cut_out() takes any part without going through the whole text."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{CHUNK}}}"), F.lit(0))


def cut_out(chunks: Column, start: Column, length: Column) -> Column:
    first = F.floor(start / CHUNK)
    n = F.when(length > 0, F.floor((start + length - 1) / CHUNK) - first + 1).otherwise(0)
    near = F.array_join(F.slice(chunks, (first + 1).cast("int"), n.cast("int")), "")
    return F.substring(near, (start - first * CHUNK + 1).cast("int"), length.cast("int"))


def find_spans(text: Column, kind: str, rank: int, pattern: str | Column, prefilter: Column, accept=None) -> Column:
    """Array of spans of the pattern's leftmost non-overlapping matches that accept() takes; empty where the prefilter is not met. Work grows with the text and its matches, not with their square."""
    regex = F.lit(pattern) if isinstance(pattern, str) else pattern
    found = F.regexp_extract_all(text, regex, F.lit(0))
    steps = lambda values: F.zip_with(values, F.slice(F.split(text, regex, -1), F.lit(1), F.size(values)), lambda v, gap: (F.char_length(v) + F.char_length(gap)).cast("long"))
    span = lambda v, end: F.struct((end - F.char_length(v)).alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"), v.alias("value"))
    spans = let(found, lambda values: F.zip_with(values, running(steps(values), lambda a, b: a + b), span))
    spans = F.filter(spans, lambda s: accept(s["value"])) if accept else spans
    return F.when(F.coalesce(prefilter, F.lit(False)), spans).otherwise(F.array()).cast(SPANS)


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined, in the spans' order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


SALTS = 64


def join_to_groups(rows: DataFrame, groups: DataFrame, key: str, spread: Column) -> DataFrame:
    """rows, each beside its group's row of groups; a null key equals a null key. Beyond a broadcast's bound a group's rows are dealt to SALTS places by spread, and groups is repeated for each."""
    salt, own = fresh(rows, "salt"), fresh(rows, "own_key")
    told = groups.withColumnRenamed(key, own)
    if table_bytes(groups) <= 32 << 20:
        return rows.join(F.broadcast(told), rows[key].eqNullSafe(F.col(own))).drop(own)
    told = told.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn(salt, F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    return dealt.join(told, dealt[key].eqNullSafe(F.col(own)) & (dealt[salt] == told[salt])).drop(own, told[salt]).drop(salt)
