"""Task tables: reading JSON files, slicing, preparation, images, written results."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.text import strip
from .batches import BatchTable
from .json_array import read_objects, write_array

FIELDS = T.StructType().add("question", "string").add("answer_type", "string").add("image", "string").add("choices", T.ArrayType(T.StringType())).add("answers", T.ArrayType(T.StringType())).add("pid", "string")


def read_tasks(spark: SparkSession, path: str) -> DataFrame:
    """pos, item_json of a JSON file, which any number of tasks read in parts."""
    return read_objects(spark, path)


def _fields(item_json: str) -> dict:
    item = json.loads(item_json)
    choices, gold = item.get("choices"), item.get("answer")
    if isinstance(gold, list):
        answers = [json.dumps(gold, ensure_ascii=False), *map(str, gold)]
    else:
        answers = [] if gold is None or not str(gold).strip() else [str(gold).strip()]
    name = item.get("pid") or item.get("id")
    texts = {c: str(item.get(c, "")) for c in ("question", "answer_type", "image")}
    return texts | {"choices": list(map(str, choices)) if isinstance(choices, list) else [], "answers": answers, "pid": str(name) if name else None}


@F.pandas_udf(FIELDS)
def fields_of(item_json: pd.Series) -> pd.DataFrame:
    """Python's own text of mixed values, which SQL readers do not share."""
    return pd.DataFrame([_fields(x) for x in item_json], columns=FIELDS.names)


def task_fields(items: DataFrame) -> DataFrame:
    """task_id (the position), pid (else sample_<position>) and the raw fields of items (pos, item_json)."""
    return items.select(F.col("pos").alias("task_id"), fields_of("item_json").alias("f")).select("task_id", "f.*").withColumn("pid", F.coalesce("pid", F.concat(F.lit("sample_"), F.col("task_id").cast("string"))))


def slice_tasks(tasks: DataFrame, start: int, end: int, pos: str = "task_id") -> DataFrame:
    """Positions in [start, end), before any filter."""
    return tasks.where((F.col(pos) >= max(start, 0)) & (F.col(pos) < end))


def choices_text(choices: Column) -> Column:
    """'' for no choices; labels A to Z, then C27 and on."""
    label = lambda i: F.when(i < 26, F.chr(i + 65)).otherwise(F.concat(F.lit("C"), (i + 1).cast("string")))
    lines = F.transform(choices, lambda c, i: F.concat(label(i), F.lit(". "), c))
    return F.when(F.size(choices) > 0, F.concat(F.lit("Choices:\n"), F.array_join(lines, "\n"))).otherwise("")


def prepare_tasks(tasks: DataFrame, root: str, skip_list_answers: bool = True) -> DataFrame:
    """task_id, pid, question, instruction, image_path, answers. tasks: also answer_type, image, choices, answers."""
    out = tasks.withColumn("question", strip(F.coalesce("question", F.lit("")))).where(F.col("question") != "")
    if skip_list_answers:
        out = out.where(F.lower(strip(F.coalesce("answer_type", F.lit("")))) != "list")
    choices, image = choices_text(F.col("choices")), strip(F.coalesce("image", F.lit("")))
    placed = F.when(image.startswith("/"), image).otherwise(F.concat(F.lit(f"{root}/"), image))
    return out.select("task_id", "pid", "question", F.when(choices == "", F.col("question")).otherwise(F.concat("question", F.lit("\n"), choices)).alias("instruction"), placed.alias("image_path"), "answers")


def load_tasks(spark: SparkSession, path: str, start: int, end: int, root: str | None = None, skip_list_answers: bool = True) -> DataFrame:
    """Prepared tasks of a slice of a JSON file; a slice without any is an error. Images lie beside the file unless root is given."""
    if end <= start:
        raise ValueError(f"the slice [{start}, {end}) is empty")
    items = slice_tasks(read_tasks(spark, path), start, end, "pos")
    ready = prepare_tasks(task_fields(items), root or path.rpartition("/")[0], skip_list_answers)
    if not ready.take(1):
        raise ValueError(f"no task is left of the slice [{start}, {end})")
    return ready


def shuffled(tasks: DataFrame, seed: int) -> DataFrame:
    """tasks with order: a reproducible permutation numbered from 0.

    Rows fall into 2^16 ranges of a hash; what stands before a range is summed over the ranges' counts, and rows are ranked within theirs.
    """
    draw, place, rank, before = (f"shuffle_{c}" for c in ("draw", "range", "rank", "before"))
    drawn = tasks.withColumn(draw, F.xxhash64(F.lit(seed), "task_id")).withColumn(place, F.shiftright(draw, 48))
    counts = drawn.groupBy(place).agg(F.count(F.lit(1)).alias("n"))  # 2^16 rows at most
    starts = counts.select(place, (F.sum("n").over(Window.orderBy(place)) - F.col("n")).alias(before))
    ranked = drawn.withColumn(rank, F.row_number().over(Window.partitionBy(place).orderBy(draw, "task_id")))
    return ranked.join(F.broadcast(starts), place).withColumn("order", F.col(before) + F.col(rank) - 1).drop(draw, place, rank, before)


#: Types of images by extension; others count as PNG.
MIME = {".svg": "image/svg+xml", ".jpg": "image/jpeg", ".jpeg": "image/jpeg", ".webp": "image/webp", ".gif": "image/gif", ".bmp": "image/bmp", ".tif": "image/tiff", ".tiff": "image/tiff"}


def mime_of(path: Column | str) -> Column:
    mime = F.create_map(*[F.lit(x) for kv in MIME.items() for x in kv])
    return F.coalesce(F.try_element_at(mime, F.lower(F.regexp_extract(path, r"\.[^./]+$", 0))), F.lit("image/png"))


def data_urls(paths: DataFrame, images: DataFrame) -> DataFrame:
    """image_path, image_url for each different image_path of paths. URLs pass; file:// is taken off; '' where images (path, content) has none.

    Only images that are asked for are encoded, once each.
    """
    asked = paths.select("image_path").distinct().withColumn("path", F.regexp_replace(strip(F.col("image_path")), "^file://", ""))
    wanted = images.join(asked.select("path").distinct(), "path", "left_semi")
    encoded = wanted.select("path", F.concat(F.lit("data:"), mime_of("path"), F.lit(";base64,"), F.translate(F.base64("content"), "\r\n", "")).alias("url"))
    passes = strip(F.col("image_path")).rlike("^(data:|https?://)")
    return asked.join(encoded, "path", "left").select("image_path", F.when(passes, strip(F.col("image_path"))).otherwise(F.coalesce("url", F.lit(""))).alias("image_url"))


def attach_images(tasks: DataFrame, images: DataFrame) -> DataFrame:
    """tasks with image_url, the data URL of image_path. The last step, as rows are wide from here on."""
    return tasks.join(data_urls(tasks, images), "image_path", "left").withColumn("image_url", F.coalesce("image_url", F.lit("")))


class ImageStore:
    """Images by content: path/rows holds each different image's data once, under its digest, whatever paths it has and in whatever run it came first."""

    def __init__(self, spark: SparkSession, path: str):
        self.table = BatchTable(spark, path, "digest string, data string, run string")

    def add(self, run: str, images: DataFrame, most_bytes: int = 64 << 20) -> DataFrame:
        """path, digest of images (path, content), after those whose content is not there yet were encoded, in tasks of about most_bytes. A run that was added before adds nothing."""
        told = images.select("path", F.sha2("content", 256).alias("digest"), F.length("content").cast("long").alias("n"))
        new = told.groupBy("digest").agg(F.min("path").alias("path"), F.max("n").alias("n")).join(self.table.read().select("digest"), "digest", "left_anti")
        tasks = -(-(new.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] + 1) // most_bytes)
        wanted = images.join(new.select("path", "digest"), "path").repartition(tasks, "digest")
        self.table.append(run, wanted.select("digest", F.translate(F.base64("content"), "\r\n", "").alias("data"), F.lit(run).alias("run")).dropDuplicates(["digest"]))
        return told.select("path", "digest")

    def urls(self, paths: DataFrame) -> DataFrame:
        """path, image_url, run for paths (path, digest): the type goes by the path, so that one image may have several URLs."""
        return paths.join(self.table.read(), "digest").select("path", F.concat(F.lit("data:"), mime_of("path"), F.lit(";base64,"), "data").alias("image_url"), "run")


@F.pandas_udf(T.StringType())
def result_text(row: pd.Series) -> pd.Series:
    """A result as it is written: arguments as objects, images by their URL, an empty usage where there is none."""

    def calls(each: list) -> None:
        for c in each:
            c["arguments"] = json.loads(c.pop("arguments_json"))

    def one(text: str) -> str:
        o = json.loads(text)
        for t in o.get("turns", []):
            calls(t["parsed"]["tool_calls"])
            calls(t["tool_results"])
            t.setdefault("policy_usage", {})
        for m in o.get("messages", []):
            m["content"] = [{"type": p["type"], "image_url": {"url": p["url"]}} if p["type"] == "image_url" else p for p in m.pop("parts")]
            m.pop("pos", None)
        return json.dumps(o, ensure_ascii=False)

    return row.map(one)


def write_results(results: DataFrame, path: str) -> None:
    """One JSON array of results() in order, as write_array() lays it out. What a result does not have, such as an error or a verdict of a turn, is left out."""
    told = [F.col(c) for c in results.columns if c != "status"]
    write_array(results.select("order", result_text(F.to_json(F.struct(*told))).alias("text")), path)


def write_sft_turns(examples: DataFrame, path: str) -> None:
    """A folder of JSON lines: task_id, pid, turn, prompt, completion, reward."""
    examples.select("task_id", "pid", "turn", "prompt", "completion", "reward").write.mode("overwrite").json(path)
