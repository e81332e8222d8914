"""Answers and verdicts: candidate, format gate, critic JSON, merge, acceptance."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import equivalent_answer, first_filled

ELEMENT = ("category", "original_fact", "notebook_claim", "explanation")
VERDICT = T.StructType([T.StructField(c, T.BooleanType()) for c in ("has_object", "has_fields", "has_consistent", "consistent", "format_ok", "is_correct")]).add("normalized", "string").add("elements", T.ArrayType(T.StringType())).add("critique", "string")
FENCE = "`" * 3
#: Feedback texts.
FORMAT_ERROR = "Format error: please include <answer>\\boxed{...}</answer> in your response."
ACCEPTED, REJECTED, INCONSISTENT = "Accepted.", "Answer rejected. Please revise.", "Answer rejected. Please revise notebook and answer."
UNUSABLE = "Answer judge output was invalid. Please revise and try again."


def fenced(text: str) -> Iterator[str]:
    """Blocks between fences that begin with a brace, json before it or not, and end with one."""
    at = text.find(FENCE)
    while at >= 0:
        begin = at + len(FENCE)
        begin += 4 * (text[begin : begin + 4].lower() == "json")
        begin += len(text) - begin - len(text[begin:].lstrip())
        stop = text.find(FENCE, begin) if text.startswith("{", begin) else -1
        while stop >= 0 and not text[begin:stop].rstrip().endswith("}"):
            stop = text.find(FENCE, stop + 1)
        if stop >= 0:
            yield text[begin:stop].rstrip()
        at = text.find(FENCE, stop + len(FENCE) if stop >= 0 else at + 1)


def object_in(text: str) -> dict:
    """The text as a JSON object; else the last fenced object; else the object at the last brace that begins one."""
    text = text.strip()
    try:
        whole = json.loads(text)
        return whole if isinstance(whole, dict) else {}
    except ValueError:
        pass
    for block in reversed(list(fenced(text))):
        try:
            if isinstance(found := json.loads(block), dict):
                return found
        except ValueError:
            continue
    at, decoder = text.rfind("{"), json.JSONDecoder()
    while at >= 0:
        try:
            return decoder.raw_decode(text, at)[0]
        except ValueError:
            at = text.rfind("{", 0, at)
    return {}


def truth(value, default):
    if isinstance(value, bool):
        return value
    said = value.strip().lower() if isinstance(value, str) else None
    return True if said in ("true", "1", "yes", "y") else False if said in ("false", "0", "no", "n") else default


def critique_text(elements: list, consistent: bool) -> str:
    return json.dumps({"hallucination_elements": elements, "is_consistent": consistent}, ensure_ascii=False, indent=2)


def _verdict(text):
    o = object_in(text or "")
    elements = o.get("hallucination_elements")
    elements = elements if isinstance(elements, list) else []
    consistent = truth(o.get("is_consistent"), False)
    return {
        "has_object": bool(o),
        "has_fields": "format_ok" in o or "is_correct" in o,
        "has_consistent": "is_consistent" in o,
        "consistent": consistent,
        "format_ok": truth(o.get("format_ok"), None),
        "is_correct": truth(o.get("is_correct"), False),
        "normalized": str(o.get("normalized_answer") or "").strip(),
        "elements": [json.dumps(e, ensure_ascii=False) for e in elements],
        "critique": critique_text(elements, consistent),
    }


@F.pandas_udf(VERDICT)
def verdict_of(text: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_verdict(t) for t in text], columns=VERDICT.names)


def candidates(parsed: DataFrame, golds: str = "answers") -> DataFrame:
    """parsed with candidate, base_ok (format) and local_ok (equal to one of the golds; none: false)."""
    out = parsed.withColumn("candidate", first_filled(F.col("boxed"), F.col("answer"), F.col("content")))
    out = out.withColumn("base_ok", F.col("has_answer_tag") & (F.col("boxed") != ""))
    return out.withColumn("local_ok", F.exists(golds, lambda g: equivalent_answer(F.col("candidate"), g)))


def with_golds(turns: DataFrame, tasks: DataFrame) -> DataFrame:
    """Turns beside their tasks' question, image and golds; turns of unknown tasks go. Both sides are dealt by task_id, as the windows and groups that follow are."""
    return turns.join(tasks.select("task_id", "pid", "question", "image_path", "answers"), "task_id")


def critique_elements(turns: DataFrame, critic: str = "critic_raw") -> DataFrame:
    """task_id, turn, i (from 0) and the fields of each hallucination element; a field that is missing is null."""
    each = turns.select("task_id", "turn", F.posexplode(verdict_of(critic)["elements"]).alias("i", "e"))
    return each.select("task_id", "turn", "i", *[F.get_json_object("e", f"$.{c}").alias(c) for c in ELEMENT])


def needs_second(v: Column, rendered: Column) -> Column:
    """Whether a verdict lacks what a decision needs: with a render all three keys, without one both."""
    return ~v["has_fields"] & (~rendered | ~v["has_consistent"])


def with_second_verdict(turns: DataFrame, rendered: Column, first: str = "critic_raw", second: str = "critic_again") -> DataFrame:
    """turns whose first verdict is replaced by the second, where one was needed and given."""
    asked = needs_second(verdict_of(first), rendered)
    return turns.withColumn(first, F.when(asked, F.coalesce(second, first)).otherwise(F.col(first)))


def judge(judged: DataFrame, critic: str | None = "critic_raw", rendered: str | None = None) -> DataFrame:
    """candidates() rows with format_ok, is_correct, normalized, consistent, critique, feedback and accepted.

    Without a critic column the local rules decide. rendered: a boolean column; turns without a render are judged without a
    critique, so that with a critic none of them is accepted. None: every turn has a render.
    """
    shown = F.col(rendered) if rendered else F.lit(True)
    if critic is None:
        out = judged.withColumns({"format_ok": F.col("base_ok"), "is_correct": F.col("base_ok") & F.col("local_ok"), "normalized": F.col("candidate"), "consistent": F.lit(True), "critique": F.when(shown, F.lit(critique_text([], True))).otherwise("")})
        unusable = F.lit(False)
    else:
        v = judged.withColumn("v", verdict_of(critic))
        open_ = F.col("base_ok") & ~F.col("local_ok")
        fields, unusable = open_ & F.col("v.has_fields"), open_ & ~F.col("v.has_fields") & ~shown
        format_ok = F.when(fields, F.coalesce("v.format_ok", F.lit(True))).otherwise(F.col("base_ok"))
        correct = F.when(~F.col("base_ok"), False).when(F.col("local_ok"), True).when(fields, format_ok & F.col("v.is_correct")).otherwise(False)
        normalized = F.when(fields, first_filled(F.col("v.normalized"), F.col("candidate"))).otherwise(F.col("candidate"))
        out = v.withColumns({"unusable": unusable, "format_ok": format_ok, "is_correct": correct, "normalized": normalized, "consistent": shown & F.col("v.consistent"), "critique": F.when(shown, F.col("v.critique")).otherwise("")}).drop("v")
        unusable = F.col("unusable")
    good = F.col("format_ok") & F.col("is_correct")
    feedback = F.when(unusable, UNUSABLE).when(~F.col("format_ok"), FORMAT_ERROR).when(good & ~F.col("consistent"), INCONSISTENT).when(F.col("is_correct"), ACCEPTED).otherwise(REJECTED)
    return out.withColumn("feedback", feedback).withColumn("accepted", good & F.col("consistent")).drop("unusable")
