"""Batch requests in place of model calls: policy, critic and judge, and the second question after an unusable verdict."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Texts of a judge request.
QUESTION, REFERENCES, OUTPUT = "Question:\n", "Reference answers:\n", "Assistant final output:\n"
#: What is asked for after a verdict without the keys, with and without a render.
ASK_RENDERED = "Return ONLY strict JSON with keys: hallucination_elements, is_consistent, format_ok, is_correct, normalized_answer. No extra words."
ASK_UNRENDERED = "Return ONLY strict JSON with keys: format_ok, is_correct, normalized_answer. No extra words."
PARTS = "array<struct<type:string,text:string,url:string>>"


@dataclass(frozen=True)
class Call:
    """What a request names besides its messages. Limits that are None or 0 are left out."""

    model: str
    provider: str
    temperature: float = 0.0
    max_tokens: int | None = None
    timeout_sec: int | None = 120

    def fields(self) -> list[Column]:
        limits = {"max_tokens": self.max_tokens, "timeout": self.timeout_sec}
        named = {"model": self.model, "custom_llm_provider": self.provider, "temperature": self.temperature} | {k: v for k, v in limits.items() if v is not None and v > 0}
        return [F.lit(v).alias(k) for k, v in named.items()]


def text_part(text: Column) -> Column:
    return F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("url"))


def image_part(url: Column) -> Column:
    """Null, and so left out of a message, where there is no image."""
    return F.when(F.coalesce(url, F.lit("")) != "", F.struct(F.lit("image_url").alias("type"), F.lit(None).cast("string").alias("text"), url.alias("url")))


def parts(*each: Column) -> Column:
    return F.filter(F.array(*each), lambda p: p.isNotNull()).cast(PARTS)


def as_sent(content: Column) -> Column:
    """Parts as a request has them: an image's URL is a field of image_url."""
    return F.transform(content, lambda p: F.struct(p["type"].alias("type"), p["text"].alias("text"), F.when(p["url"].isNotNull(), F.struct(p["url"].alias("url"))).alias("image_url")))


def message(role: str, *each: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), as_sent(parts(*each)).alias("content"))


def body(call: Call, messages: Column) -> Column:
    return F.to_json(F.struct(*call.fields(), messages.alias("messages")))


def json_array(texts: Column) -> Column:
    """Texts as a JSON array with a space after each comma."""
    one = lambda t: F.regexp_replace(F.to_json(F.array(t)), r"^\[|\]$", "")
    return F.concat(F.lit("["), F.array_join(F.transform(texts, one), ", "), F.lit("]"))


def system_prompt(template: str, tools: list[dict]) -> str:
    """The tool catalogue, as indented JSON, in the place that the template names {provided_tools}."""
    return template.replace("{provided_tools}", json.dumps(tools, ensure_ascii=False, indent=2))


def policy_requests(tasks: DataFrame, call: Call, system: str, first_render: str | None = None) -> DataFrame:
    """task_id, body: the first request of each task. first_render: the column with the path of turn 0's render, '' where it failed."""
    user = message("user", text_part(F.col("instruction")), image_part(F.col("image_path")), image_part(F.col(first_render) if first_render else F.lit("")))
    return tasks.select("task_id", body(call, F.array(message("system", text_part(F.lit(system))), user)).alias("body"))


def critic_requests(turns: DataFrame, call: Call, with_image: str, without_image: str, main_rounds: int | None = None) -> DataFrame:
    """task_id, turn, body for turns (question, image_url, last_render, tool_calls, answer_present) whose tools ran, that do not answer and that have a render.

    The system prompt goes by whether the task's image was found. Turns after main_rounds are retries, whose tools do not run.
    """
    ran = (F.size("tool_calls") > 0) & ~F.col("answer_present") & (F.col("last_render") != "") & (F.col("turn") <= main_rounds if main_rounds else F.lit(True))
    found = F.coalesce(F.col("image_url"), F.lit("")) != ""
    user = message("user", text_part(F.col("question")), image_part(F.when(found, F.col("image_path"))), image_part(F.col("last_render")))
    system = message("system", text_part(F.when(found, F.lit(with_image)).otherwise(F.lit(without_image))))
    return turns.where(ran).select("task_id", "turn", body(call, F.array(system, user)).alias("body"))


def judge_messages(system: str, *more: Column) -> Column:
    user = message("user", text_part(F.concat(F.lit(QUESTION), "question")), text_part(F.concat(F.lit(REFERENCES), json_array(F.col("answers")))), text_part(F.concat(F.lit(OUTPUT), "assistant_raw")), image_part(F.col("image_path")), image_part(F.col("last_render")))
    return F.array(message("system", text_part(F.lit(system))), user, *more)


def asked_of_judge(main_rounds: int | None = None) -> tuple[Column, Column]:
    """Whether a turn is judged by a model, and whether as one with a render.

    Answering turns are: with a render always, without one only where the form is good and no gold is equal. Retries, which
    are the turns after main_rounds, are judged as with a render, whether or not they have one or an answer.
    """
    retry = F.col("turn") > main_rounds if main_rounds else F.lit(False)
    shown = (F.col("last_render") != "") | retry
    return (F.col("answer_present") & (shown | (F.col("base_ok") & ~F.col("local_ok")))) | retry, shown


def judge_requests(turns: DataFrame, call: Call, rendered: str, unrendered: str, main_rounds: int | None = None) -> DataFrame:
    """task_id, turn, body for turns (question, answers, assistant_raw, image_path, last_render, and what candidates() tells) that are asked_of_judge()."""
    asked, shown = asked_of_judge(main_rounds)
    messages = F.when(shown, judge_messages(rendered)).otherwise(judge_messages(unrendered))
    return turns.where(asked).select("task_id", "turn", body(call, messages).alias("body"))


def second_requests(turns: DataFrame, call: Call, rendered: str, unrendered: str, main_rounds: int | None = None) -> DataFrame:
    """judge_requests() with one message more, for turns whose verdict needs_second."""
    asked, shown = asked_of_judge(main_rounds)
    ask = lambda text: message("user", text_part(F.lit(text)))
    messages = F.when(shown, judge_messages(rendered, ask(ASK_RENDERED))).otherwise(judge_messages(unrendered, ask(ASK_UNRENDERED)))
    return turns.where(asked & F.col("needs_second")).select("task_id", "turn", body(call, messages).alias("body"))
