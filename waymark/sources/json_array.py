"""JSON arrays that many tasks read and write."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.places import before_parts, numbered

WS = r"[ \t\r\n]"


def marks(text: Column, inside: bool) -> Column:
    """What of a piece of JSON without escapes is not within strings. inside: it begins within one."""
    begun = F.regexp_replace(text, r'^[^"]*+(?:"|$)', "") if inside else text
    return F.regexp_replace(F.regexp_replace(begun, r'"[^"]*+"', ""), r'(?s)".*$', "")


def depth_change(text: Column, inside: bool) -> Column:
    left = marks(text, inside)
    return (F.regexp_count(left, F.lit(r"[\[{]")) - F.regexp_count(left, F.lit(r"[\]}]"))).cast("long")


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """part, at, text, in_string, before, after for the pieces between all commas of a file, or of the files of a folder in their names' order.

    in_string: whether a piece begins within a string; before, after: how many brackets are open where it begins and ends.
    Tasks read their blocks of the file by themselves. A first pass tells of each block how quotes and brackets change over it,
    whether it begins within a string or not; what stands before a block is summed over blocks.
    """
    read = spark.read.option("lineSep", ",").text(path)
    where = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    told = read.select(where.alias("part"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("text"))
    told = told.withColumn("bare", F.regexp_replace("text", r"(?s)\\.", ""))  # no escape goes over a comma
    told = told.withColumns({"quotes": F.regexp_count("bare", F.lit('"')).cast("long"), "out": depth_change(F.col("bare"), False), "in": depth_change(F.col("bare"), True)}).drop("bare")
    upto = Window.partitionBy("part").orderBy("at")
    past = upto.rowsBetween(Window.unboundedPreceding, -1)
    odd = F.coalesce(F.sum("quotes").over(past), F.lit(0)) % 2 == 1  # within a string, if the block begins outside of one
    told = told.withColumn("odd", odd).withColumns({"if_out": F.when(F.col("odd"), F.col("in")).otherwise(F.col("out")), "if_in": F.when(F.col("odd"), F.col("out")).otherwise(F.col("in"))})
    blocks = told.join(before_parts(told, {"quotes_before": F.col("quotes")}), "part").withColumn("change", F.when(F.col("quotes_before") % 2 == 1, F.col("if_in")).otherwise(F.col("if_out")))
    placed = blocks.join(before_parts(blocks, {"depth_before": F.col("change")}), "part")
    after = F.col("depth_before") + F.sum("change").over(upto)
    begins = F.col("odd") != (F.col("quotes_before") % 2 == 1)
    return placed.select("part", "at", "text", begins.alias("in_string"), (begins != (F.col("quotes") % 2 == 1)).alias("ends_in_string"), (after - F.col("change")).alias("before"), after.alias("after"))


def elements(cut: DataFrame, depth: int) -> DataFrame:
    """cut with number: from 0, that of the element that a piece is of, where elements are parted by commas at a depth."""
    told = cut.withColumn("ends", F.when((F.col("after") == depth) & ~F.col("ends_in_string"), 1).otherwise(0).cast("long"))
    past = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    placed = told.join(before_parts(told, {"ends_before": F.col("ends")}), "part")
    return placed.withColumn("number", F.col("ends_before") + F.coalesce(F.sum("ends").over(past), F.lit(0))).drop("ends", "ends_before")


def joined(each: DataFrame, depth: int, opened: str, closed: str) -> DataFrame:
    """number, text of elements() put together, each in one row. What opens the first one and closes the last is taken off."""
    whole = each.groupBy("number").agg(F.array_sort(F.collect_list(F.struct("part", "at", "text"))).alias("p"), (F.min("after") < depth).alias("last"))
    text = F.array_join(F.col("p.text"), ",")
    text = F.when(F.col("number") == 0, F.regexp_replace(text, opened, "")).otherwise(text)
    return whole.select("number", F.when(F.col("last"), F.regexp_replace(text, closed, "")).otherwise(text).alias("text"))


PAIR = T.StructType().add("key", "string").add("kind", "integer").add("rank", "string").add("item", "string")


@F.pandas_udf(PAIR)
def keyed(pair: pd.Series) -> pd.DataFrame:
    """A pair of an object: its key, how keys are ranked (numbers first, padded), and its value where that is an object."""

    def one(text: str) -> tuple:
        for key, value in json.loads(f"{{{text}}}").items():
            return key, *((0, str(int(key)).zfill(12)) if key.isdigit() else (1, key)), json.dumps(value, ensure_ascii=False) if isinstance(value, dict) else None
        return None, None, None, None

    return pd.DataFrame([one(t) for t in pair], columns=PAIR.names)


def read_objects(spark: SparkSession, path: str) -> DataFrame:
    """pos, item_json: the objects of a JSON file, or of a folder of slices of one in their names' order; pos counts them from 0.

    They are those of a list, of the list under data, or an object's values, numbered keys first; other payloads have none.
    Of keys that come again the last counts. Any number of tasks read parts of the file. JSON whose brackets do not match is an error.
    """
    cut = pieces(spark, path)
    first = F.regexp_extract("text", rf"^{WS}*+([^ \t\r\n])", 1)
    head = cut.agg(F.sum(F.col("after") - F.col("before")).alias("left"), F.min_by(first, F.when((F.col("before") == 0) & (first != ""), F.struct("part", "at"))).alias("opens")).first()
    if head.left:
        raise ValueError(f"{path}: brackets do not match")
    if head.opens == "[":
        found = joined(elements(cut, 1), 1, rf"^{WS}*\[", rf"\]{WS}*$")
    elif head.opens == "{":
        tops = elements(cut, 1)
        key = rf'^{WS}*(?:\{{{WS}*)?"data"{WS}*:{WS}*'
        named = tops.where((F.col("before") <= 1) & ~F.col("in_string") & F.col("text").rlike(key))
        data = named.agg(F.max_by(F.struct("number", F.col("text").rlike(key + r"\[").alias("listed")), "number").alias("d")).first().d
        if data is None or not data.listed:
            pairs = joined(tops, 1, rf"^{WS}*\{{", rf"\}}{WS}*$").select("number", keyed("text").alias("k")).where("k.key is not null").select("number", "k.*")
            values = pairs.groupBy("key", "kind", "rank").agg(F.max_by("item", "number").alias("item_json"), F.min("number").alias("number")).where(F.col("item_json").isNotNull())
            return numbered(values, [F.col("kind"), F.col("rank"), F.col("number")], "keyed-items", "pos").select("pos", "item_json")
        found = joined(elements(tops.where(F.col("number") == data.number).drop("number"), 2), 2, key + r"\[", rf"\]{WS}*(?:\}}{WS}*)?$")
    else:
        return spark.createDataFrame([], "pos long, item_json string")
    objects = found.withColumn("text", F.regexp_replace("text", rf"^{WS}+|{WS}+$", "")).where(F.col("text").startswith("{"))
    return numbered(objects, [F.col("number")], "listed-items", "pos").select("pos", F.col("text").alias("item_json"))


def write_array(rows: DataFrame, path: str, order: str = "order", text: str = "text") -> None:
    """A folder of files that, one after the other in their names' order, are one JSON array of the texts in order; rows of one place stand next to each other.

    Rows are numbered and dealt by ranges of their number, so that no task writes all; a row after all others closes the array. The folder counts once its _SUCCESS is there.
    """
    placed = numbered(rows.select(F.col(order).alias("place_of"), F.col(text).alias("value")), [F.col("place_of")], "array-rows", "at")
    each = placed.select(F.lit(0).alias("end"), "at", F.concat(F.when(F.col("at") == 0, "[").otherwise(","), "value").alias("value"))
    last = rows.sparkSession.createDataFrame([(1, 0, "]" if placed.take(1) else "[]")], "end int, at long, value string")
    each.unionByName(last).repartitionByRange("end", "at").sortWithinPartitions("end", "at").select("value").write.mode("overwrite").text(path)
