"""Registered queries over the given tables and the SQL they are held against."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.parse import content_text, merge_reasoning, parse_response, usage as usage_of
from ..functions.text import equivalent_answer
from ..operators import canvas, judge, rounds, tools, trajectory
from ..sources import json_array, requests
from ..sources import tasks as task_source
from ..sources.scratch import materialize, scratch_path
from .fixtures import VIEWS


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    for table in ("conversations", "events", "pages"):
        if table in VIEWS[name]:
            spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(table)
    if "edits_fx" in VIEWS[name] and name != "edits_fx":
        view(spark, sf_dir, "edits_fx").createOrReplaceTempView("edits_fx")
    return spark.sql(VIEWS[name])


def long(*names: str) -> list:
    return [F.col(n).cast("long").alias(n) for n in names]


def tasks(spark, sf_dir) -> DataFrame:
    """Prepared tasks, with the path of turn 0's render, '' where it failed."""
    raw = view(spark, sf_dir, "tasks_fx")
    ready = task_source.prepare_tasks(raw.withColumns({"choices": F.array(F.lit("yes"), F.lit("no")), "answers": F.array("gold")}), "/data", False)
    return ready.join(raw.select("task_id", "first_ok", "broken"), "task_id").withColumn("first_render", F.when(F.col("first_ok"), tools.first_render_path()).otherwise(""))


def parsed(spark, sf_dir) -> DataFrame:
    return parse_response(view(spark, sf_dir, "turns_fx"))


def turns(spark, sf_dir) -> DataFrame:
    """Parsed turns beside their tasks."""
    own = tasks(spark, sf_dir)
    return judge.with_golds(parsed(spark, sf_dir), own).join(own.select("task_id", "first_render"), "task_id")


def judged(told: DataFrame, critic: str | None = None, main_rounds: int = 6) -> DataFrame:
    """Turns with their calls and a verdict; those without a render, retries apart, are judged without a critique."""
    seen = tools.with_calls(told, main_rounds).withColumn("rendered", (F.col("last_render") != "") | (F.col("turn") > main_rounds))
    return judge.judge(judge.candidates(seen), critic, "rendered")


def task_prep(spark, sf_dir):
    raw = view(spark, sf_dir, "tasks_fx").withColumns({"choices": F.array(F.lit("yes"), F.lit("no")), "answers": F.array("gold")})
    return task_source.prepare_tasks(raw, "/data").select("task_id", "pid", "question", "instruction", "image_path", F.array_join("answers", "|").alias("golds"))


def task_items(spark, sf_dir):
    """Tasks from JSON items: mixed golds and choices, missing and null fields, names that count for nothing."""
    items = task_source.slice_tasks(view(spark, sf_dir, "items_fx"), 3, 60, "pos")
    ready = task_source.prepare_tasks(task_source.task_fields(items), "/data")
    return ready.select(*long("task_id"), "pid", "question", "instruction", "image_path", F.array_join("answers", "|").alias("golds"))


def task_slice(spark, sf_dir):
    return task_source.slice_tasks(view(spark, sf_dir, "tasks_fx"), 10, 40).select("task_id", "pid")


def task_shuffle(spark, sf_dir):
    """Whether the order is a permutation, and how many tasks keep their place, which is few."""
    out = task_source.shuffled(view(spark, sf_dir, "tasks_fx").select("task_id"), 7)
    n = F.count(F.lit(1))
    return out.agg(F.count_distinct("task_id").alias("n_tasks"), F.min("order").alias("first"), F.max("order").alias("last"), F.count_distinct("order").alias("n_orders"), (F.count_if(F.col("order") == F.col("task_id")) * 2 < n).alias("moved"))


def parse_fields(spark, sf_dir):
    return parsed(spark, sf_dir).select(*long("task_id", "turn"), "reasoning", "answer", "boxed", "content", "seed_content", "has_answer_tag", "answer_present", F.size("tool_calls").cast("long").alias("n_calls"), *long("malformed"))


def tool_validation(spark, sf_dir):
    return tools.call_rows(tools.with_calls(turns(spark, sf_dir))).select(*long("task_id", "turn", "call"), "name", "invalid", "result")


def turn_tool_response(spark, sf_dir):
    return tools.with_calls(turns(spark, sf_dir)).select(*long("task_id", "turn"), "tool_response")


def render_carry(spark, sf_dir):
    out = tools.with_calls(turns(spark, sf_dir)).select("task_id", "turn", "last_render", F.explode("ran").alias("c"))
    return out.select(*long("task_id", "turn"), F.col("c.call").cast("long").alias("call"), F.col("c.path").alias("rendered_path"), F.col("c.before").alias("render_before"), "last_render")


ARABIC = "".join(chr(0x660 + i) for i in range(10))  # digits of another script


def answer_equivalence(spark, sf_dir):
    """Every answer against the golds of the tasks that follow: whole, as a decimal and as a fraction."""
    base = view(spark, sf_dir, "turns_fx").select(*long("task_id", "turn"), "gold")
    forms = F.explode(F.array(F.col("gold"), F.concat(F.lit(" "), "gold", F.lit(".0 ")), F.concat((2 * F.col("gold").cast("int")).cast("string"), F.lit("/2")), F.concat(F.lit("1_"), "gold"), F.concat("gold", F.lit("d")), F.concat("gold", F.lit("/0")), F.translate(F.concat("gold", F.lit("/1")), "0123456789", ARABIC))).alias("model")
    return base.select("task_id", "turn", "gold", forms).withColumn("same", equivalent_answer(F.col("model"), F.col("gold")))


def candidate_format(spark, sf_dir):
    return judge.candidates(turns(spark, sf_dir)).select(*long("task_id", "turn"), "candidate", "base_ok", "local_ok")


def critic_verdict(spark, sf_dir):
    out = view(spark, sf_dir, "turns_fx").withColumn("v", judge.verdict_of("critic_raw"))
    return out.select(*long("task_id", "turn"), *[F.col(f"v.{c}").alias(c) for c in ("has_object", "has_fields", "has_consistent", "consistent", "is_correct", "normalized", "critique")], F.size("v.elements").cast("long").alias("n_elements"))


def hallucinations(spark, sf_dir):
    return judge.critique_elements(view(spark, sf_dir, "turns_fx")).select(*long("task_id", "turn", "i"), *judge.ELEMENT)


def reask(spark, sf_dir):
    """Turns whose verdict lacks the fields that a decision needs, with and without a render."""
    v = judge.verdict_of("critic_raw")
    return view(spark, sf_dir, "turns_fx").select(*long("task_id", "turn"), judge.needs_second(v, F.lit(True)).alias("rendered"), judge.needs_second(v, F.lit(False)).alias("unrendered")).where("rendered or unrendered")


JUDGED = ["task_id", "turn", "format_ok", "is_correct", "normalized", "consistent", "feedback", "accepted"]


def judge_merge(spark, sf_dir):
    """Every turn as if it had a render."""
    return judge.judge(judge.candidates(turns(spark, sf_dir)), "critic_raw").select(*long("task_id", "turn"), *JUDGED[2:])


def judge_local(spark, sf_dir):
    return judge.judge(judge.candidates(turns(spark, sf_dir)), None).select(*long("task_id", "turn"), *JUDGED[2:])


def judge_renders(spark, sf_dir):
    """Turns with and without a render, each by its own rules."""
    return judged(turns(spark, sf_dir), "critic_raw").select(*long("task_id", "turn"), "last_render", *JUDGED[2:])


def judge_again(spark, sf_dir):
    """Second verdicts in place of the first where those were unusable."""
    told = judge.with_second_verdict(turns(spark, sf_dir), F.lit(True))
    return judge.judge(judge.candidates(told), "critic_raw").select(*long("task_id", "turn"), *JUDGED[2:])


def trajectory_outcome(spark, sf_dir):
    return trajectory.outcomes(tasks(spark, sf_dir), trajectory.truncated(judged(turns(spark, sf_dir))))


def retry_phase(spark, sf_dir):
    return trajectory.outcomes(tasks(spark, sf_dir), trajectory.with_retries(judged(turns(spark, sf_dir), None, 1), 1, 2))


COUNTERS = ("prompt_tokens", "completion_tokens", "total_tokens")


def usage(spark, sf_dir) -> DataFrame:
    return view(spark, sf_dir, "turns_fx").select("task_id", "turn", usage_of(*map(F.col, COUNTERS)).alias("u")).select("task_id", "turn", "u.*")


def usage_forms(spark, sf_dir):
    """Counters as a mapping and as an object, whose zeros count as no usage."""
    counters = [F.when(F.col("turn") % 2 == 0, F.col(c)) for c in COUNTERS]
    out = view(spark, sf_dir, "turns_fx").select(*long("task_id", "turn"), usage_of(*counters).alias("m"), usage_of(*counters, empty_is_null=True).alias("o"))
    return out.select("task_id", "turn", F.col("m.total_tokens").alias("mapping_total"), F.col("o.total_tokens").alias("object_total"))


def usage_by_task(spark, sf_dir):
    return trajectory.usage_by_task(usage(spark, sf_dir))


def run_summary(spark, sf_dir):
    return trajectory.run_summary(trajectory_outcome(spark, sf_dir), usage(spark, sf_dir))


SYSTEM = "Use the tools: {provided_tools}"


def content(parts) -> Column:
    """A message's parts as one text."""
    return F.array_join(F.transform(parts, lambda p: F.concat(p["type"], F.lit(":"), F.coalesce(p["text"], p["url"]))), "|")


def log(spark, sf_dir, main_rounds: int = 6, retries: int = 0) -> tuple[DataFrame, DataFrame]:
    """The whole log and the turns that it tells of."""
    told = turns(spark, sf_dir)
    kept = judged(told, "critic_raw", main_rounds)
    kept = trajectory.with_retries(kept, main_rounds, retries) if retries else trajectory.truncated(kept, main_rounds)
    return trajectory.message_log(tasks(spark, sf_dir), kept, SYSTEM, main_rounds if retries else None), kept


def messages(spark, sf_dir):
    return trajectory.messages(log(spark, sf_dir)[0]).select(*long("task_id", "pos", "turn"), "role", F.md5(content("parts").cast("binary")).alias("content_md5"))


def messages_retry(spark, sf_dir):
    return trajectory.messages(log(spark, sf_dir, 1, 2)[0]).select(*long("task_id", "pos", "turn"), "role", F.md5(content("parts").cast("binary")).alias("content_md5"))


def sft_turns(spark, sf_dir):
    whole, kept = log(spark, sf_dir, 1, 2)
    out = trajectory.sft_turns(whole, trajectory.outcomes(tasks(spark, sf_dir), kept), 1)
    said = F.array_join(F.transform("prompt", lambda m: F.concat(m["role"], F.lit("="), content(m["parts"]))), "\n")
    return out.select(*long("task_id", "turn"), "pid", F.size("prompt").cast("long").alias("n_prompt"), F.md5(said.cast("binary")).alias("prompt_md5"), F.md5(F.col("completion").cast("binary")).alias("completion_md5"), "reward")


def sft_rewarded(spark, sf_dir):
    whole, kept = log(spark, sf_dir)
    return trajectory.sft_turns(whole, trajectory.outcomes(tasks(spark, sf_dir), kept), only_rewarded=True).groupBy("task_id", "pid").agg(F.count(F.lit(1)).alias("n_examples"), F.sum("reward").alias("reward"))


def turn_text(t: Column) -> Column:
    """All that a result tells of a turn as one text."""
    p, u, j = t["parsed"], t["policy_usage"], t["answer_judge"]
    calls = F.array_join(F.transform(p["tool_calls"], lambda c: F.concat_ws(":", c["name"], c["arguments_json"])), ",")
    ran = F.array_join(F.transform(t["tool_results"], lambda c: F.concat_ws(":", c["index"].cast("string"), c["name"], c["arguments_json"], c["result"])), ",")
    judged = F.when(j.isNull(), F.lit("-")).otherwise(F.concat_ws(":", j["format_ok"].cast("string"), j["is_correct"].cast("string"), j["normalized_answer"], j["feedback"], j["judge_raw"]))
    names = ("answer", "boxed", "content", "seed_content")
    return F.concat_ws("|", t["turn"].cast("string"), t["assistant_raw"], t["assistant_seed_content"], p["raw"], p["think"], calls, p["malformed_tool_calls"].cast("string"), *[p[n] for n in names], p["has_answer_tag"].cast("string"), *[u[c].cast("string") for c in COUNTERS], ran, t["rendered_image_path"], t["tool_response"], t["critic_feedback"], judged)


def results(spark, sf_dir):
    """Nested results in a run's order, tasks that broke among them."""
    whole, kept = log(spark, sf_dir)
    own = tasks(spark, sf_dir).join(task_source.shuffled(tasks(spark, sf_dir).select("task_id"), 7), "task_id")
    errors = own.select("task_id", F.when(F.col("broken"), F.concat(F.lit("cannot open "), "image_path")).alias("error"), F.lit(0.5).alias("elapsed_sec"))
    out = trajectory.results(own, kept.withColumn("usage", usage_of(*map(F.col, COUNTERS))), whole, errors)
    said = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit("="), content(m["parts"]))), "\n")
    told = F.array_join(F.transform("turns", turn_text), "\n")
    return out.select(F.md5(said.cast("binary")).alias("messages_md5"), F.md5(told.cast("binary")).alias("turns_md5"), *long("task_id"), "pid", "error", "final_answer", "reward", "status", "session_id", "render_dir", F.size("messages").cast("long").alias("n_messages"), F.size("turns").cast("long").alias("n_turns"), F.col("order").isNotNull().alias("ordered"))


def message_images(spark, sf_dir):
    """Image parts of the log as data URLs; pages stand in for the images of tasks, and renders are not there."""
    out = trajectory.with_image_data(log(spark, sf_dir)[0], stand_ins(spark, sf_dir))
    return out.select(*long("task_id", "pos"), F.size("parts").cast("long").alias("n_parts"), F.md5(content("parts").cast("binary")).alias("content_md5"))


def reasoning_merge(spark, sf_dir):
    t = view(spark, sf_dir, "turns_fx")
    return t.select(*long("task_id", "turn"), F.md5(merge_reasoning(F.concat(F.lit(" r"), "gold", F.lit(" ")), F.col("assistant_raw")).cast("binary")).alias("merged_md5"))


def content_texts(spark, sf_dir):
    """Each conversation's messages as parts of one content, those of a role that is no text left out."""
    part = F.struct(F.when(F.col("role") == "system", "image_url").otherwise("text").alias("type"), F.col("text").alias("text"), "turn")
    whole = spark.read.parquet(f"{sf_dir}/conversations.parquet").groupBy("conv_id").agg(F.array_sort(F.collect_list(part), lambda a, b: (a["turn"] - b["turn"]).cast("int")).alias("parts"))
    return whole.select("conv_id", F.md5(content_text(F.col("parts")).cast("binary")).alias("text_md5"))


def render_manifest(spark, sf_dir):
    e = view(spark, sf_dir, "edits_fx").select(F.col("session_id").alias("task_id"), F.concat(F.lit("s"), F.col("session_id").cast("string")).alias("pid"), (F.floor((F.col("seq") - 1) / 3) + 1).alias("turn"), ((F.col("seq") - 1) % 3).alias("call"))
    return tools.render_manifest(e).select(*long("task_id", "turn", "call"), "session_id", "path")


def canvas_flat(spark, sf_dir):
    return canvas.replay_flat(view(spark, sf_dir, "edits_fx")).withColumn("pos", F.col("pos").cast("long"))


def canvas_viewport(spark, sf_dir):
    return canvas.viewport(canvas_flat(spark, sf_dir))


def canvas_revert(spark, sf_dir):
    """What a session's edits come to once those that left no trace are dropped."""
    edits = view(spark, sf_dir, "edits_fx").withColumn("invalid", F.when(F.col("target_id") == "e4", "missing args").otherwise(""))
    return canvas.effective(edits).groupBy("session_id", "action").agg(F.count(F.lit(1)).alias("n"), F.max("seq").cast("long").alias("last_seq"))


def canvas_tree(spark, sf_dir):
    return canvas.replay_tree(view(spark, sf_dir, "tree_fx"))


def canvas_groups(spark, sf_dir):
    """The tree's elements below root, which are those of the flat replay in their order."""
    tree = canvas_tree(spark, sf_dir).where("tag = 'g'")
    return tree.select("session_id", F.col("element_id").alias("target_id"), F.row_number().over(Window.partitionBy("session_id").orderBy("pos")).cast("long").alias("pos"))


def canvas_base(spark, sf_dir):
    """Notebooks that begin with their task's image, and have it again after a clear: the elements in it and all others below root."""
    bases = view(spark, sf_dir, "edits_fx").select("session_id").distinct().select("session_id", F.when(F.col("session_id") % 2 == 0, F.concat(F.lit("data:image/png;base64,"), F.col("session_id").cast("string"))).otherwise("").alias("image_url"))
    tree = canvas.replay_tree(view(spark, sf_dir, "tree_fx"), bases)
    return tree.groupBy("session_id").agg(F.count_if(F.col("element_id").isin("base_figure", "base_image")).alias("n_base"), F.count_if(F.col("tag") == "g").alias("n_groups"), F.max(F.when(F.col("element_id") == "base_image", F.get_json_object("attrs", "$.src"))).alias("src"))


def sanitize_html(spark, sf_dir):
    h = view(spark, sf_dir, "html_fx").select("page_id", canvas.sanitize_images(F.col("fragment")).alias("html"))
    note = lambda p: F.regexp_extract("html", p, 1)
    return h.select("page_id", note(r'<div style="([^"]*)">\[blocked external image\]').alias("style"), note(r"\[blocked external image\] ([^<]*)<").alias("url"), note(r'(<text x="3" y="0" fill="#ED2633">)\[blocked external svg image\]').alias("svg"), F.contains("html", F.lit("<img")).alias("has_img"))


def stand_ins(spark, sf_dir) -> DataFrame:
    """Pages as images of tasks: path, content. Tasks without a page have none."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    path = F.when(F.col("page_id") % 4 == 0, F.concat(F.lit("/abs/"), F.col("page_id").cast("string"), F.lit(".png"))).otherwise(F.concat(F.lit("/data/img/"), F.col("page_id").cast("string"), F.lit(".jpg")))
    return pages.select(path.alias("path"), F.col("html").cast("binary").alias("content"))


def image_parts(spark, sf_dir):
    """Data URLs of tasks' images."""
    out = task_source.attach_images(tasks(spark, sf_dir).select("task_id", "image_path"), stand_ins(spark, sf_dir))
    return out.select("task_id", F.md5(F.col("image_url").cast("binary")).alias("url_md5"), F.char_length("image_url").cast("long").alias("n_chars"))


POLICY, CRITIC = requests.Call("policy", "own", 0.5, 256), requests.Call("critic", "own", 1.0, None, 0)
CATALOGUE = [{"name": name, "required": required} for name, required in tools.TOOLS.items()]


def field(path: str):
    return F.get_json_object("body", path)


def policy_requests(spark, sf_dir):
    out = requests.policy_requests(tasks(spark, sf_dir), POLICY, requests.system_prompt(SYSTEM, CATALOGUE), "first_render")
    user = "$.messages[1].content"
    return out.select("task_id", field("$.model").alias("model"), field("$.custom_llm_provider").alias("provider"), field("$.temperature").cast("double").alias("temperature"), field("$.max_tokens").cast("long").alias("max_tokens"), field("$.timeout").cast("long").alias("timeout"), F.contains(field("$.messages[0].content[0].text"), F.lit('"modify_element"')).alias("has_tools"), F.md5(field(f"{user}[0].text").cast("binary")).alias("text_md5"), field(f"{user}[1].image_url.url").alias("image"), field(f"{user}[2].image_url.url").alias("render"))


def critic_requests(spark, sf_dir):
    told = turns(spark, sf_dir)
    seen = task_source.attach_images(tools.with_calls(told), stand_ins(spark, sf_dir))
    out = requests.critic_requests(seen, CRITIC, "with an image", "without one")
    return out.select(*long("task_id", "turn"), field("$.messages[0].content[0].text").alias("system"), F.md5(field("$.messages[1].content[0].text").cast("binary")).alias("question_md5"), field("$.messages[1].content[1].image_url.url").alias("first"), field("$.messages[1].content[2].image_url.url").alias("second"), field("$.timeout").isNull().alias("untimed"))


def judge_requests(spark, sf_dir):
    """Turns after the second are retries."""
    out = requests.judge_requests(judged(turns(spark, sf_dir), "critic_raw", 2), CRITIC, "rendered", "unrendered", 2)
    part = lambda i: field(f"$.messages[1].content[{i}].text")
    return out.select(*long("task_id", "turn"), field("$.messages[0].content[0].text").alias("system"), part(1).alias("golds"), F.md5(F.concat(part(0), part(2)).cast("binary")).alias("said_md5"), field("$.messages[1].content[3].image_url.url").alias("image"), field("$.messages[1].content[4].image_url.url").alias("render"))


def second_requests(spark, sf_dir):
    told = judged(turns(spark, sf_dir), "critic_raw", 2).withColumn("needs_second", judge.needs_second(judge.verdict_of("critic_raw"), F.col("rendered")))
    out = requests.second_requests(told, CRITIC, "rendered", "unrendered", 2)
    return out.select(*long("task_id", "turn"), field("$.messages[2].role").alias("role"), field("$.messages[2].content[0].text").alias("asked"))


def round_requests(spark, sf_dir):
    """The policy's next request of each open task, after all turns that are there; those after the second are retries."""
    whole, kept = log(spark, sf_dir, 2, 2)
    out = rounds.next_requests(tasks(spark, sf_dir), kept, whole, POLICY, 2, 2)
    sent = F.from_json(field("$.messages"), "array<struct<role:string,content:array<struct<type:string,text:string,image_url:struct<url:string>>>>>")
    said = F.array_join(F.transform(sent, lambda m: F.concat(m["role"], F.lit("="), F.array_join(F.transform(m["content"], lambda p: F.concat(p["type"], F.lit(":"), F.coalesce(p["text"], p["image_url"]["url"]))), "|"))), "\n")
    return out.select(*long("task_id", "turn"), field("$.model").alias("model"), F.size(sent).cast("long").alias("n_messages"), F.md5(said.cast("binary")).alias("messages_md5"))


def sft_pointers(spark, sf_dir):
    """Examples as places in the log."""
    return trajectory.prompt_pointers(log(spark, sf_dir, 1, 2)[0], 1).select(*long("task_id", "turn", "upto", "render"), "ask")


EARLY = '{"is_consistent":true,"is_correct":true}'


def reply_verdicts(spark, sf_dir):
    """Judge requests in a ledger: some replies come twice, some never, one answers nothing; steps and batches are run again. Unusable verdicts have a second request."""
    ledger = rounds.RoundLedger(spark, scratch_path(spark, "round-ledger"))
    told = judged(turns(spark, sf_dir), "critic_raw", 2)
    asked = rounds.with_ids(requests.judge_requests(told, CRITIC, "rendered", "unrendered", 2), "judge")
    sent = ledger.issue("judge/1", asked)
    ledger.issue("judge/1", asked.limit(0))
    third, fourth = (F.col("task_id") + F.col("turn")) % 3 == 0, (F.col("task_id") + F.col("turn")) % 4 == 0
    words = sent.select("request_id", "task_id", "turn").join(told.select("task_id", "turn", "critic_raw", "critic_again"), ["task_id", "turn"])
    came = words.select("request_id", F.when(~fourth, F.col("critic_raw")).alias("reply"), F.lit(2).alias("arrived"))
    early = words.where(third).select("request_id", F.lit(EARLY).alias("reply"), F.lit(1).alias("arrived"))
    stray = spark.range(1).select(F.lit("nobody").alias("request_id"), F.lit("{}").alias("reply"), F.lit(1).alias("arrived"))
    ledger.record("first batch", came.unionByName(early).unionByName(stray))
    ledger.record("first batch", early)
    shown = (F.col("last_render") != "") | (F.col("turn") > 2)
    answered = ledger.state().where("kind = 'judge'").join(told.select("task_id", "turn", "last_render", *("question", "answers", "assistant_raw", "image_path", "answer_present", "base_ok", "local_ok")), ["task_id", "turn"])
    lacking = answered.withColumn("needs_second", F.col("reply").isNotNull() & judge.needs_second(judge.verdict_of("reply"), shown))
    second = ledger.issue("judge/2", rounds.with_ids(requests.second_requests(lacking, CRITIC, "rendered", "unrendered", 2), "second"))
    again = second.join(told.where("task_id % 2 = 0").select("task_id", "turn", "critic_again"), ["task_id", "turn"])
    ledger.record("second batch", again.select("request_id", F.col("critic_again").alias("reply"), F.lit(3).alias("arrived")))
    first = answered.drop("reply", "n_replies")
    out = rounds.settled(first, second, ledger.came.read(), shown)
    return out.select(*long("task_id", "turn", "n_replies"), "status", F.md5(F.col("verdict").cast("binary")).alias("verdict_md5"))


def canvas_views(spark, sf_dir):
    """What a render shows after each edit: the last three elements below the body."""
    out = canvas.views_by_edit(canvas.replay_history(view(spark, sf_dir, "body_fx")))
    return out.select("session_id", *long("seq", "place"), "element_id")


def canvas_versions(spark, sf_dir):
    """How many elements stand after each edit that changed any, by the intervals in which each stands as it is."""
    v = canvas.element_versions(canvas.replay_history(view(spark, sf_dir, "body_fx")))
    steps = v.select("session_id", F.explode(F.array(F.struct(F.col("from_seq").alias("seq"), F.lit(1).alias("n")), F.struct(F.col("to_seq").alias("seq"), F.lit(-1).alias("n")))).alias("e")).select("session_id", "e.*").where(F.col("seq").isNotNull())
    each = steps.groupBy("session_id", "seq").agg(F.sum("n").alias("n"))
    return each.select("session_id", *long("seq"), F.sum("n").over(Window.partitionBy("session_id").orderBy("seq")).alias("n_elements"))


def canvas_resume(spark, sf_dir):
    """Trees that go on from stored ones: two batches of edits after the first, the second of which comes twice."""
    edits = materialize(view(spark, sf_dir, "tree_fx"), "canvas-edits")  # read for each batch, and for the sessions it has
    state = materialize(canvas.replay_state(edits.where("seq <= 20")), "canvas-state")
    state = materialize(canvas.resumed(state, edits.where("seq > 20 and seq <= 45")), "canvas-state")
    state = materialize(canvas.resumed(state, edits.where("seq > 45")), "canvas-state")
    return canvas.tree_of(canvas.resumed(state, edits.where("seq > 45")))


def task_file(spark, sf_dir):
    """Items written as one JSON array in parts and read again by parts: conversations in their order, messages whole."""
    told = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    item = F.to_json(F.struct(F.col("text").alias("question"), F.col("conv_id").alias("id"), F.array("role", F.lit("a, b")).alias("choices")))
    path = scratch_path(spark, "task-file")
    json_array.write_array(told.select((F.col("conv_id") * 1000 + F.col("turn")).alias("order"), item.alias("text")), path)
    fields = task_source.task_fields(task_source.read_tasks(spark, path))
    return fields.select(*long("task_id"), "pid", F.md5(F.col("question").cast("binary")).alias("question_md5"), F.array_join("choices", "|").alias("choices"))


def image_store(spark, sf_dir):
    """Two runs over images of which some have equal bytes: each is encoded in the run where it came first."""
    images = stand_ins(spark, sf_dir).withColumn("page", F.regexp_extract("path", r"([0-9]+)\.", 1).cast("long"))
    twins = images.select(F.concat(F.lit("/twin/"), F.col("page").cast("string"), F.lit(".webp")).alias("path"), "content", "page")
    store = task_source.ImageStore(spark, scratch_path(spark, "image-store"))
    store.add("run 1", images.where("page % 2 = 0"))
    known = store.add("run 2", images.unionByName(twins))
    store.add("run 2", twins)
    return store.urls(known).select("path", F.md5(F.col("image_url").cast("binary")).alias("url_md5"), "run")


def image_forms(spark, sf_dir):
    """Addresses with white space of all sorts around them, paths of files and blanks, as data URLs."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    form = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("\t\u00a0"), "url", F.lit(" \n"))).when(F.col("page_id") % 3 == 1, F.concat(F.lit("\n file:///abs/"), F.col("page_id").cast("string"), F.lit(".png\t"))).otherwise(F.lit("\t "))
    asked = pages.select("page_id", form.alias("image_path"))
    out = task_source.attach_images(asked, stand_ins(spark, sf_dir))
    return out.select("page_id", F.md5(F.col("image_url").cast("binary")).alias("url_md5"))


#: Tools as a table: schemas that ask for types and no more arguments than they list.
SCHEMAS = [
    ("insert_element", '{"type":"object","properties":{"fragment":{"type":"string"},"rootId":{"type":["string","null"]}},"required":["fragment"],"additionalProperties":false}'),
    ("modify_element", '{"type":"object","properties":{"targetId":{"type":"string"},"attrs":{"type":"string"}},"required":["targetId","attrs"]}'),
    ("remove_element", '{"type":"object","properties":{"targetId":{"type":"string"}},"required":["targetId"]}'),
    ("clear", '{"type":"object","properties":{},"additionalProperties":false}'),
]


def tool_rules(spark, sf_dir):
    """Calls held against a catalogue that is a table."""
    catalogue = spark.createDataFrame(SCHEMAS, "name string, parameters string")
    return tools.call_rows(tools.with_calls(turns(spark, sf_dir), catalogue=catalogue)).select(*long("task_id", "turn", "call"), "name", "invalid", "result")


QUERIES = (task_prep, task_items, task_slice, task_shuffle, parse_fields, tool_validation, turn_tool_response, render_carry, answer_equivalence, candidate_format, critic_verdict, hallucinations, reask, judge_merge, judge_local, judge_renders, judge_again, trajectory_outcome, retry_phase, usage_forms, usage_by_task, run_summary, messages, messages_retry, sft_turns, sft_rewarded, results, message_images, reasoning_merge, content_texts, render_manifest, canvas_flat, canvas_viewport, canvas_revert, canvas_tree, canvas_groups, canvas_base, sanitize_html, image_parts, policy_requests, critic_requests, judge_requests, second_requests, round_requests, sft_pointers, reply_verdicts, canvas_views, canvas_versions, canvas_resume, task_file, image_store, image_forms, tool_rules)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


# The same rules in DuckDB's SQL, stated over the same views.
WITH = "WITH RECURSIVE " + ", ".join(f"{k} AS ({v})" for k, v in VIEWS.items())
TRIM = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
BOX = r"'(?s)(?:\\boxed|/boxed)\{(.*)\}'"


def trim(x: str) -> str:
    return TRIM.format(x)


TASKS = f"""{WITH}, own AS (SELECT task_id, pid, {trim('question')} AS question, {trim('question')} || chr(10) || 'Choices:' || chr(10) || 'A. yes' || chr(10) || 'B. no' AS instruction, CASE WHEN starts_with(image, '/') THEN image ELSE '/data/' || image END AS image_path, gold, broken, answer_type,
  CASE WHEN first_ok THEN printf('renders/task-%d-pid-%s/rendered-turn-000.png', task_id, pid) ELSE '' END AS first_render FROM tasks_fx WHERE {trim('question')} <> '')"""
PARSED = rf"""{TASKS}, c0 AS (SELECT *, CASE WHEN (length(assistant_raw) - length(replace(assistant_raw, '<think>', ''))) / 7 = 1 AND NOT contains(assistant_raw, '</think>') AND contains(assistant_raw, '<tool_call>')
  THEN regexp_replace(assistant_raw, '<tool_call>', '</think><tool_call>') ELSE assistant_raw END AS raw FROM turns_fx),
c1 AS (SELECT *, {trim("regexp_extract(raw, '(?is)<think>(.*?)</think>', 1)")} AS reasoning, {trim("regexp_extract(raw, '(?is)<answer>(.*?)</answer>', 1)")} AS answer,
  {trim("regexp_replace(regexp_replace(raw, '(?is)<think>.*?</think>', '', 'g'), '(?is)<tool_call>.*?</tool_call>', '', 'g')")} AS content, contains(lower(raw), '<answer>') AS has_answer_tag,
  list_transform(regexp_extract_all(raw, '(?is)<tool_call>(.*?)</tool_call>', 1), lambda b: {trim("b")}) AS blocks FROM c0),
c2 AS (SELECT *, coalesce(nullif(CASE WHEN contains(raw, '</think>') THEN {trim("list_extract(string_split(raw, '</think>'), -1)")} ELSE content END, ''), reasoning) AS seed_content,
  {trim(f"regexp_extract(coalesce(nullif(answer, ''), nullif(content, ''), raw), {BOX}, 1)")} AS boxed,
  list_filter(blocks, lambda b: CASE WHEN json_valid(b) THEN json_type(b) = 'OBJECT' AND coalesce(json_extract_string(b, '$.name'), json_extract_string(b, '$.tool')) IS NOT NULL ELSE false END) AS calls FROM c1),
parsed AS (SELECT c2.*, has_answer_tag OR boxed <> '' AS answer_present, pid, question, image_path, first_render FROM c2 JOIN own USING (task_id))"""


def results_sql(main: int) -> str:
    """Turns after main are retries, whose tools do not run."""
    order = "OVER (PARTITION BY task_id ORDER BY turn, call ROWS BETWEEN UNBOUNDED PRECEDING AND {})"
    before, upto = (f"coalesce(last_value(nullif(rendered_path, '') IGNORE NULLS) {order.format(stop)}, first_render)" for stop in ("1 PRECEDING", "CURRENT ROW"))
    return rf"""{PARSED}, e AS (SELECT task_id, pid, turn, render_ok, render_error, first_render, unnest(calls) AS b, generate_subscripts(calls, 1) - 1 AS call FROM parsed WHERE turn <= {main}),
e1 AS (SELECT *, {trim("coalesce(json_extract_string(b, '$.name'), json_extract_string(b, '$.tool'))")} AS name, json_keys(coalesce(json_extract(b, '$.arguments'), json_extract(b, '$.args'), json_extract(b, '$.kwargs'), '{{}}'::JSON)) AS keys FROM e),
e2 AS (SELECT *, CASE name WHEN 'insert_element' THEN ['fragment', 'rootId'] WHEN 'modify_element' THEN ['targetId', 'attrs'] WHEN 'remove_element' THEN ['targetId'] WHEN 'replace_element' THEN ['targetId', 'fragment'] WHEN 'clear' THEN []::VARCHAR[] END AS req FROM e1),
e3 AS (SELECT *, CASE WHEN req IS NULL THEN 'invalid tool name: ' || name WHEN len(list_filter(req, lambda k: NOT list_contains(keys, k))) > 0 THEN 'missing args for ' || name || ': ' || array_to_string(list_filter(req, lambda k: NOT list_contains(keys, k)), ', ')
  WHEN name = 'clear' AND len(keys) > 0 THEN 'clear arguments must be {{}}' ELSE '' END AS invalid FROM e2),
results AS (SELECT *, CASE WHEN invalid <> '' THEN 'Error: ' || invalid WHEN NOT render_ok THEN 'Error: ' || render_error || '. Reverted to previous successful state.' ELSE 'tool execute success' END AS result FROM e3),
r0 AS (SELECT *, CASE WHEN result = 'tool execute success' THEN printf('renders/task-%d-pid-%s/rendered-turn-%03d-tool-%02d.png', task_id, pid, turn, call) ELSE '' END AS rendered_path FROM results),
renders AS (SELECT *, {before} AS render_before, {upto} AS last_render FROM r0),
t0 AS (SELECT p.*, r.own FROM parsed p LEFT JOIN (SELECT task_id, turn, arg_max(last_render, call) AS own FROM renders GROUP BY task_id, turn) r USING (task_id, turn)),
seen AS (SELECT * EXCLUDE (own), coalesce(last_value(own IGNORE NULLS) OVER (PARTITION BY task_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_render) AS last_render FROM t0)"""


def number(x: str) -> str:
    plain = f"replace({x}, '_', '')"
    return f"CASE WHEN regexp_full_match({x}, '[+-]?[0-9](_?[0-9])*/[0-9](_?[0-9])*') THEN try_cast(split_part({plain}, '/', 1) AS DOUBLE) / nullif(try_cast(split_part({plain}, '/', 2) AS DOUBLE), 0) WHEN regexp_full_match({x}, '[+-]?[0-9](_?[0-9])*(\\.([0-9](_?[0-9])*)?)?') THEN try_cast({plain} AS DOUBLE) END"


def same(model: str, gold: str) -> str:
    m, g = (f"translate(regexp_replace(lower({x}), '\\s', '', 'g'), '{ARABIC}', '0123456789')" for x in (model, gold))
    return f"({m} <> '' AND {g} <> '' AND ({m} = {g} OR coalesce(abs({number(m)} - {number(g)}) <= 1e-9, false)))"


TRUTH = "lower(trim(json_extract_string(obj, '$.{0}')))"


def to_bool(key: str, default: str) -> str:
    t, kind = TRUTH.format(key), f"json_type(obj, '$.{key}')"
    return f"CASE WHEN {kind} IN ('BOOLEAN', 'VARCHAR') AND {t} IN ('true', '1', 'yes', 'y') THEN true WHEN {kind} IN ('BOOLEAN', 'VARCHAR') AND {t} IN ('false', '0', 'no', 'n') THEN false ELSE {default} END"


ELEMENT_TEXT = """'    {' || chr(10) || array_to_string(list_transform(json_keys(e), lambda k: '      "' || k || '": ' || json_extract(e, '$.' || k)::VARCHAR), ',' || chr(10)) || chr(10) || '    }'"""
CRITIQUE = """'{' || chr(10) || '  "hallucination_elements": ' || CASE WHEN len(elements) = 0 THEN '[]' ELSE '[' || chr(10) || array_to_string(list_transform(elements, lambda e: %s), ',' || chr(10)) || chr(10) || '  ]' END || ',' || chr(10) || '  "is_consistent": ' || v_consistent::VARCHAR || chr(10) || '}'""" % ELEMENT_TEXT
NO_CRITIQUE = CRITIQUE.replace("elements)", "[]::JSON[])").replace("(elements,", "([]::JSON[],").replace("v_consistent", "true")


def verdicts(base: str, table: str, critic: str = "critic_raw") -> str:
    return rf"""{base}, v0 AS (SELECT *, {critic} AS said, regexp_extract({critic}, '(?is).*```(?:json)?\s*(\{{.*?\}})\s*```', 1) AS fenced, regexp_extract({critic}, '(?s).*(\{{[^{{}}]*\}})', 1) AS inner_ FROM {table}),
v1 AS (SELECT *, CASE WHEN said <> '' AND json_valid(said) THEN CASE WHEN json_type(said) = 'OBJECT' THEN said ELSE '{{}}' END WHEN fenced <> '' AND json_valid(fenced) THEN fenced WHEN inner_ <> '' AND json_valid(inner_) THEN inner_ ELSE '{{}}' END AS obj FROM v0),
v2 AS (SELECT *, len(json_keys(obj)) > 0 AS has_object, list_contains(json_keys(obj), 'format_ok') OR list_contains(json_keys(obj), 'is_correct') AS has_fields, list_contains(json_keys(obj), 'is_consistent') AS has_consistent, {to_bool('is_consistent', 'false')} AS v_consistent, {to_bool('format_ok', 'NULL')} AS v_format, {to_bool('is_correct', 'false')} AS v_correct,
  coalesce(trim(json_extract_string(obj, '$.normalized_answer')), '') AS v_normalized, CASE WHEN json_type(obj, '$.hallucination_elements') = 'ARRAY' THEN json_extract(obj, '$.hallucination_elements[*]') ELSE [] END AS elements FROM v1),
verdict AS (SELECT *, {CRITIQUE} AS v_critique FROM v2)"""


def judged_sql(critic: bool, main: int = 6, shown: str = "", again: bool = False) -> str:
    """shown: SQL for whether a turn has a render."""
    shown = shown or f"(last_render <> '' OR turn > {main})"
    base = results_sql(main)
    first = ", asked AS (SELECT * FROM seen)"
    if again:
        base = verdicts(base, "seen") + ", first AS (SELECT task_id, turn, NOT has_fields AND NOT has_consistent AS lacking FROM verdict)"
        first = ", asked AS (SELECT s.* REPLACE (CASE WHEN lacking THEN coalesce(critic_again, critic_raw) ELSE critic_raw END AS critic_raw) FROM seen s JOIN first USING (task_id, turn))"
    told = f"{base}{first}, k0 AS (SELECT *, coalesce(nullif(boxed, ''), nullif(answer, ''), content) AS candidate, has_answer_tag AND boxed <> '' AS base_ok, {shown} AS shown FROM asked), cand AS (SELECT *, {same('candidate', 'gold')} AS local_ok FROM k0)"
    feedback = "CASE WHEN unusable THEN 'Answer judge output was invalid. Please revise and try again.' WHEN NOT format_ok THEN 'Format error: please include <answer>' || chr(92) || 'boxed{...}</answer> in your response.' WHEN is_correct AND NOT consistent THEN 'Answer rejected. Please revise notebook and answer.' WHEN is_correct THEN 'Accepted.' ELSE 'Answer rejected. Please revise.' END AS feedback, format_ok AND is_correct AND consistent AS accepted"
    if not critic:
        return f"{told}, l0 AS (SELECT *, false AS unusable, base_ok AS format_ok, base_ok AND local_ok AS is_correct, candidate AS normalized, true AS consistent, CASE WHEN shown THEN {NO_CRITIQUE} ELSE '' END AS critique FROM cand), judged AS (SELECT *, {feedback} FROM l0)"
    second = verdicts("", "cand")
    if again:  # the first verdict's steps keep their names
        second = re.sub(r"\b(v[012]|verdict)\b", r"again_\1", second)
    second = told + second
    verdict = "again_verdict" if again else "verdict"
    return f"""{second}, m0 AS (SELECT *, base_ok AND NOT local_ok AND has_fields AS fields, base_ok AND NOT local_ok AND NOT has_fields AND NOT shown AS unusable FROM {verdict}), m1 AS (SELECT *, CASE WHEN fields THEN coalesce(v_format, true) ELSE base_ok END AS format_ok,
  CASE WHEN NOT base_ok THEN false WHEN local_ok THEN true WHEN fields THEN coalesce(v_format, true) AND v_correct ELSE false END AS is_correct, CASE WHEN fields THEN coalesce(nullif(v_normalized, ''), candidate) ELSE candidate END AS normalized, shown AND v_consistent AS consistent, CASE WHEN shown THEN v_critique ELSE '' END AS critique FROM m0), judged AS (SELECT *, {feedback} FROM m1)"""


def outcome(critic: bool, main: int, where: str) -> str:
    return f"""{judged_sql(critic, main)}, f AS (SELECT *, min(CASE WHEN accepted THEN turn END) OVER (PARTITION BY task_id) AS first_accepted FROM judged WHERE {where}), kept AS (SELECT * FROM f WHERE first_accepted IS NULL OR turn <= first_accepted),
done AS (SELECT task_id, count(*) AS n_turns, arg_max(CASE WHEN accepted THEN {trim("coalesce(nullif(normalized, ''), candidate)")} END, CASE WHEN accepted THEN turn END) AS final_answer, max(accepted::DOUBLE) AS reward FROM kept GROUP BY task_id),
outcomes AS (SELECT t.task_id, t.pid, coalesce(n_turns, 0) AS n_turns, coalesce(final_answer, '') AS final_answer, coalesce(reward, 0.0) AS reward, CASE WHEN reward >= 1 AND n_turns > 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM own t LEFT JOIN done USING (task_id))"""


def log_sql(main: int, retries: int) -> str:
    """Entries with their parts as one text; row_number() gives their place in the whole log."""
    retry = f"turn > {main}" if retries else "false"
    image = "CASE WHEN {0} <> '' THEN '|image_url:' || {0} ELSE '' END"
    leading = "CASE WHEN {0} <> '' THEN 'image_url:' || {0} || '|' ELSE '' END"
    prompt = "'text:Please provide the final answer directly as <answer>' || chr(92) || 'boxed{...}</answer>. Do not output any reasoning or SVG code.'"
    answered, called = f"(answer_present OR {retry})", f"(len(calls) > 0 AND NOT ({retry}))"
    critique = f"CASE WHEN {answered} THEN critique WHEN {called} AND last_render <> '' THEN {trim('critic_raw')} ELSE '' END"
    return f"""{outcome(True, main, f"turn <= {main + retries}")},
entries AS (SELECT task_id, 0 AS turn, 0 AS kind, 0 AS call, 'system' AS role, 'text:Use the tools: {{provided_tools}}' AS content, false AS shown FROM own
  UNION ALL SELECT task_id, 0, 0, 1, 'user', 'text:' || instruction || {image.format('image_path')} || {image.format('first_render')}, false FROM own
  UNION ALL SELECT task_id, turn, 1, 0, 'assistant', 'text:' || coalesce(nullif({trim('assistant_raw')}, ''), nullif(seed_content, ''), content), false FROM kept
  UNION ALL SELECT r.task_id, r.turn, 2, r.call, 'user', CASE WHEN r.rendered_path <> '' THEN 'image_url:' || r.rendered_path ELSE {leading.format('r.render_before')} || 'text:<tool_response>' || r.result || '</tool_response>' END, r.rendered_path <> '' FROM renders r SEMI JOIN (SELECT task_id, turn FROM kept WHERE NOT ({retry})) k USING (task_id, turn)
  UNION ALL SELECT task_id, turn, 3, 0, 'user', 'text:<tool_response><image>This is the state of notebook. Critical Check: ' || ({critique}) || '</tool_response>', false FROM kept WHERE ({answered} AND ({critique}) <> '') OR (NOT {answered} AND {called} AND last_render <> '')
  UNION ALL SELECT task_id, turn, 4, 0, 'user', {leading.format('last_render')} || 'text:<answer_judge>' || feedback || '</answer_judge>' || chr(10) || 'Please revise. Your response must include an explicit <answer>' || chr(92) || 'boxed{{...}}</answer> field.', false FROM kept WHERE {answered} AND NOT accepted
  UNION ALL SELECT task_id, turn, 5, 0, 'user', {prompt}, false FROM kept WHERE NOT {answered} AND NOT {called}),
log AS (SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY turn, kind, call) - 1 AS pos FROM entries),
ended AS (SELECT * EXCLUDE (pos, last), row_number() OVER (PARTITION BY task_id ORDER BY pos) - 1 AS pos FROM (SELECT *, max(CASE WHEN shown THEN pos END) OVER (PARTITION BY task_id) AS last FROM log) WHERE NOT shown OR pos = last),
prompts AS (SELECT a.task_id, a.turn, a.pos, any_value(a.content) AS said, max(CASE WHEN b.shown THEN b.pos END) AS last FROM log a LEFT JOIN log b ON a.task_id = b.task_id AND b.pos < a.pos WHERE a.kind = 1 GROUP BY a.task_id, a.turn, a.pos),
sft AS (SELECT p.task_id, p.turn, count(b.pos) + CASE WHEN {retry.replace('turn', 'p.turn')} THEN 1 ELSE 0 END AS n_prompt, string_agg(b.role || '=' || b.content, chr(10) ORDER BY b.pos) || CASE WHEN {retry.replace('turn', 'p.turn')} THEN chr(10) || 'user=' || {prompt} ELSE '' END AS prompt, any_value(p.said)[6:] AS completion
  FROM prompts p LEFT JOIN log b ON b.task_id = p.task_id AND b.pos < p.pos AND (NOT b.shown OR b.pos = p.last) GROUP BY p.task_id, p.turn)"""


ARGS = """replace(replace(coalesce(json_extract({0}, '$.arguments'), json_extract({0}, '$.args'), json_extract({0}, '$.kwargs'), '{{}}'::JSON)::VARCHAR, '":', '": '), '","', '", "')"""
CALL = """coalesce(json_extract_string({0}, '$.name'), json_extract_string({0}, '$.tool'))"""
TURN_TEXTS = f"""ran AS (SELECT task_id, turn, string_agg(call || ':' || name || ':' || {ARGS.format('b')} || ':' || result, ',' ORDER BY call) AS ran, coalesce(arg_max(result, call) FILTER (result <> 'tool execute success'), 'tool execute success') AS response FROM results GROUP BY task_id, turn),
turn_text AS (SELECT k.task_id, k.turn, concat_ws('|', k.turn, k.assistant_raw, {trim('k.assistant_raw')}, k.raw, k.reasoning, array_to_string(list_transform(k.calls, lambda c: {CALL.format('c')} || ':' || {ARGS.format('c')}), ','), len(k.blocks) - len(k.calls), k.answer, k.boxed, k.content, k.seed_content, k.has_answer_tag, k.prompt_tokens, k.completion_tokens, CASE WHEN k.total_tokens = 0 THEN k.prompt_tokens + k.completion_tokens ELSE k.total_tokens END, coalesce(r.ran, ''), k.last_render, coalesce(r.response, ''),
  CASE WHEN k.answer_present THEN k.critique WHEN len(k.calls) > 0 AND k.last_render <> '' THEN {trim('k.critic_raw')} ELSE '' END,
  CASE WHEN k.answer_present THEN concat_ws(':', k.format_ok, k.is_correct, k.normalized, CASE WHEN k.format_ok AND k.is_correct AND NOT k.consistent THEN 'Accepted.' ELSE k.feedback END, CASE WHEN k.last_render <> '' OR (k.base_ok AND NOT k.local_ok) THEN k.critic_raw ELSE '' END) ELSE '-' END) AS t FROM kept k LEFT JOIN ran r USING (task_id, turn)),
turn_texts AS (SELECT task_id, md5(string_agg(t, chr(10) ORDER BY turn)) AS told FROM turn_text GROUP BY task_id)"""
USAGE = "usage AS (SELECT task_id, prompt_tokens, completion_tokens, CASE WHEN coalesce(total_tokens, 0) = 0 THEN prompt_tokens + completion_tokens ELSE total_tokens END AS total_tokens FROM turns_fx)"
TOKENS = "sum(prompt_tokens)::BIGINT AS prompt_tokens, sum(completion_tokens)::BIGINT AS completion_tokens, sum(total_tokens)::BIGINT AS total_tokens"
FLAT = """live AS (SELECT *, row_number() OVER (PARTITION BY session_id, target_id ORDER BY seq) AS k FROM (SELECT *, max(CASE WHEN action = 'clear' THEN seq END) OVER (PARTITION BY session_id) AS cleared FROM edits_fx WHERE render_ok) WHERE seq > coalesce(cleared, 0)),
fold AS (SELECT session_id, target_id, 0::BIGINT AS k, []::STRUCT(seq BIGINT, fill VARCHAR)[] AS held FROM (SELECT DISTINCT session_id, target_id FROM live)
  UNION ALL SELECT l.session_id, l.target_id, l.k, CASE WHEN l.action = 'insert_element' THEN list_append(held, {'seq': l.seq, 'fill': l.fill}) WHEN len(held) = 0 THEN held WHEN l.action = 'remove_element' THEN held[2:] WHEN l.action IN ('modify_element', 'replace_element') THEN list_prepend({'seq': held[1].seq, 'fill': l.fill}, held[2:]) ELSE held END FROM fold f JOIN live l ON f.session_id = l.session_id AND f.target_id = l.target_id AND l.k = f.k + 1),
ends AS (SELECT session_id, target_id, unnest(arg_max(held, k)) AS e FROM fold GROUP BY session_id, target_id),
flat AS (SELECT session_id, target_id, e.fill AS fill, row_number() OVER (PARTITION BY session_id ORDER BY e.seq) AS pos FROM ends)"""
TREE = FLAT.replace("[]::STRUCT(seq BIGINT, fill VARCHAR)[]", "[]::STRUCT(seq BIGINT, child VARCHAR, val VARCHAR, fill VARCHAR)[]")
TREE = TREE.replace("list_append(held, {'seq': l.seq, 'fill': l.fill})", "list_append(held, {'seq': l.seq, 'child': 'rect', 'val': l.fill, 'fill': NULL::VARCHAR})")
TREE = TREE.replace("WHEN l.action IN ('modify_element', 'replace_element') THEN list_prepend({'seq': held[1].seq, 'fill': l.fill}, held[2:])", "WHEN l.action = 'modify_element' THEN list_prepend({'seq': held[1].seq, 'child': held[1].child, 'val': held[1].val, 'fill': l.fill}, held[2:]) WHEN l.action = 'replace_element' THEN list_prepend({'seq': held[1].seq, 'child': 'b', 'val': l.fill, 'fill': NULL::VARCHAR}, held[2:])")
TREE = TREE.replace("e.fill AS fill, row_number()", "e.fill AS fill, e.child AS child, e.val AS val, row_number()") + """,
tree AS (SELECT DISTINCT session_id, 0::BIGINT AS pos, NULL::BIGINT AS parent, 'div' AS tag, 'root' AS element_id, '{"id": "root"}' AS attrs, '' AS text FROM edits_fx
  UNION ALL SELECT session_id, 2 * pos - 1, 0, 'g', target_id, '{"id": "' || target_id || '"' || coalesce(', "fill": "' || fill || '"', '') || '}', '' FROM flat
  UNION ALL SELECT session_id, 2 * pos, 2 * pos - 1, child, '', CASE child WHEN 'rect' THEN '{"fill": "' || val || '"}' ELSE '{}' END, CASE child WHEN 'b' THEN val ELSE '' END FROM flat)"""
STAND_INS = "stand_ins AS (SELECT CASE WHEN page_id % 4 = 0 THEN '/abs/' || page_id || '.png' ELSE '/data/img/' || page_id || '.jpg' END AS path, CASE WHEN page_id % 4 = 0 THEN 'data:image/png;base64,' ELSE 'data:image/jpeg;base64,' END || base64(encode(html)) AS url FROM pages)"


#: The body's elements after each edit, one edit of a session after the other.
STEPS = """numbered AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY seq) AS k FROM edits_fx WHERE render_ok),
steps AS (SELECT session_id, 0::BIGINT AS k, 0::BIGINT AS seq, []::VARCHAR[] AS held, true AS changed FROM (SELECT DISTINCT session_id FROM edits_fx)
  UNION ALL SELECT n.session_id, n.k, n.seq, CASE WHEN n.action = 'insert_element' THEN list_append(held, n.target_id) WHEN n.action = 'clear' THEN [] WHEN n.action = 'remove_element' AND list_contains(held, n.target_id) THEN list_concat(held[:list_position(held, n.target_id) - 1], held[list_position(held, n.target_id) + 1:]) ELSE held END, n.action IN ('insert_element', 'clear') OR list_contains(held, n.target_id) FROM steps s JOIN numbered n ON s.session_id = n.session_id AND n.k = s.k + 1)"""
RULES = """CASE WHEN name NOT IN ('insert_element', 'modify_element', 'remove_element', 'clear') THEN 'invalid tool name: ' || name WHEN name = 'insert_element' AND NOT list_contains(keys, 'fragment') THEN 'missing args for insert_element: fragment' WHEN name = 'remove_element' AND NOT list_contains(keys, 'targetId') THEN 'missing args for remove_element: targetId' WHEN name = 'clear' AND len(keys) > 0 THEN 'clear arguments must be {}' WHEN name = 'modify_element' THEN 'wrong types for modify_element: attrs' ELSE '' END"""


def replies_sql() -> str:
    """First replies, second ones, and what they come to."""
    base = f"""{judged_sql(True, 2)}, sent AS (SELECT * EXCLUDE (critic_raw, said, fenced, inner_, obj, has_object, has_fields, has_consistent, v_consistent, v_format, v_correct, v_normalized, elements, v_critique), CASE WHEN (task_id + turn) % 3 = 0 THEN '{EARLY}' WHEN (task_id + turn) % 4 = 0 THEN NULL ELSE critic_raw END AS critic_raw, CASE WHEN (task_id + turn) % 3 = 0 THEN 1 ELSE 0 END + CASE WHEN (task_id + turn) % 4 = 0 THEN 0 ELSE 1 END AS n_replies FROM judged WHERE turn > 2 OR (answer_present AND (last_render <> '' OR (base_ok AND NOT local_ok))))"""
    second = re.sub(r"\b(v[012]|verdict)\b", r"reply_\1", verdicts("", "sent"))
    return f"""{base}{second}, st AS (SELECT *, CASE WHEN critic_raw IS NULL THEN 'waiting' WHEN NOT has_fields AND (NOT shown OR NOT has_consistent) THEN CASE WHEN task_id % 2 = 0 AND critic_again IS NOT NULL THEN 'again' ELSE 'reask' END ELSE 'settled' END AS st FROM reply_verdict)
SELECT task_id, turn, n_replies::BIGINT AS n_replies, CASE st WHEN 'again' THEN 'settled' ELSE st END AS status, md5(CASE st WHEN 'again' THEN critic_again WHEN 'settled' THEN critic_raw END) AS verdict_md5 FROM st"""


def oracle_sql() -> dict[str, str]:
    columns = ", ".join(JUDGED)
    seen, local, merged = results_sql(99), judged_sql(False, shown="true"), judged_sql(True, shown="true")
    own, retried, later = log_sql(6, 0), log_sql(1, 2), log_sql(2, 2)
    prompt = "'user=text:Please provide the final answer directly as <answer>' || chr(92) || 'boxed{...}</answer>. Do not output any reasoning or SVG code.'"
    return {
        "round_requests": f"""{later}, open AS (SELECT task_id, n_turns + 1 AS turn FROM outcomes WHERE reward < 1 AND n_turns < 4), said AS (SELECT task_id, count(*) AS n, string_agg(role || '=' || content, chr(10) ORDER BY pos) AS m FROM ended GROUP BY task_id)
SELECT task_id, turn, 'policy' AS model, n + CASE WHEN turn > 2 THEN 1 ELSE 0 END AS n_messages, md5(m || CASE WHEN turn > 2 THEN chr(10) || {prompt} ELSE '' END) AS messages_md5 FROM open JOIN said USING (task_id)""",
        "sft_pointers": f"{retried} SELECT task_id, turn::BIGINT AS turn, pos AS upto, last AS render, turn > 1 AS ask FROM prompts",
        "reply_verdicts": replies_sql(),
        "canvas_views": f"{WITH}, {STEPS}, shown AS (SELECT session_id, seq, list_concat(['root'], held)[-3:] AS s FROM steps WHERE k > 0) SELECT session_id, seq, generate_subscripts(s, 1) AS place, unnest(s) AS element_id FROM shown",
        "canvas_versions": f"{WITH}, {STEPS} SELECT session_id, seq, 1 + 2 * len(held) AS n_elements FROM steps WHERE changed",
        "canvas_resume": f"{WITH}, {TREE} SELECT session_id, pos, parent, tag, element_id, attrs, text FROM tree",
        "task_file": "SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS task_id, CASE WHEN conv_id = 0 THEN 'sample_' || (row_number() OVER (ORDER BY conv_id, turn) - 1) ELSE conv_id::VARCHAR END AS pid, md5(text) AS question_md5, role || '|a, b' AS choices FROM conversations",
        "image_store": """WITH i AS (SELECT page_id, html, CASE WHEN page_id % 4 = 0 THEN '/abs/' || page_id || '.png' ELSE '/data/img/' || page_id || '.jpg' END AS path, CASE WHEN page_id % 4 = 0 THEN 'png' ELSE 'jpeg' END AS kind FROM pages), a AS (SELECT path, kind, html FROM i UNION ALL SELECT '/twin/' || page_id || '.webp', 'webp', html FROM i), f AS (SELECT html, min(page_id % 2) AS odd FROM pages GROUP BY html)
SELECT path, md5('data:image/' || kind || ';base64,' || base64(encode(html))) AS url_md5, CASE WHEN odd = 0 THEN 'run 1' ELSE 'run 2' END AS run FROM a JOIN f USING (html)""",
        "image_forms": "SELECT page_id, md5(CASE page_id % 3 WHEN 0 THEN url WHEN 1 THEN CASE WHEN page_id % 4 = 0 THEN 'data:image/png;base64,' || base64(encode(html)) ELSE '' END ELSE '' END) AS url_md5 FROM pages",
        "tool_rules": f"{results_sql(99)}, ruled AS (SELECT *, {RULES} AS broken FROM results) SELECT task_id, turn, call, name, broken AS invalid, CASE WHEN broken <> '' THEN 'Error: ' || broken WHEN NOT render_ok THEN 'Error: ' || render_error || '. Reverted to previous successful state.' ELSE 'tool execute success' END AS result FROM ruled",
        "task_prep": f"{TASKS} SELECT task_id, pid, question, instruction, image_path, gold AS golds FROM own WHERE lower({trim('answer_type')}) <> 'list'",
        "task_items": f"""{WITH}, i AS (SELECT pos, pos % 5 AS k, item_json FROM items_fx WHERE pos >= 3 AND pos < 60), q AS (SELECT *, CASE k WHEN 2 THEN 'None' ELSE {trim("coalesce(json_extract_string(item_json, '$.question'), '')")} END AS question FROM i)
SELECT pos AS task_id, CASE k WHEN 0 THEN 'i' || pos WHEN 2 THEN pos::VARCHAR ELSE 'sample_' || pos END AS pid, question, CASE k WHEN 0 THEN question || chr(10) || 'Choices:' || chr(10) || 'A. 1' || chr(10) || 'B. b' || chr(10) || 'C. True' ELSE question END AS instruction, CASE k WHEN 0 THEN '/data/x.png' WHEN 2 THEN '/x.png' ELSE '/data/y.jpg' END AS image_path, CASE k WHEN 0 THEN '[1, "a", true, null]|1|a|True|None' WHEN 2 THEN '' ELSE 'True' END AS golds FROM q WHERE k IN (0, 2, 4) AND question <> ''""",
        "task_slice": f"{WITH} SELECT task_id, pid FROM tasks_fx WHERE task_id >= 10 AND task_id < 40",
        "task_shuffle": f"{WITH} SELECT count(*) AS n_tasks, 0 AS first, count(*) - 1 AS last, count(*) AS n_orders, true AS moved FROM tasks_fx",
        "parse_fields": f"{PARSED} SELECT task_id, turn, reasoning, answer, boxed, content, seed_content, has_answer_tag, has_answer_tag OR boxed <> '' AS answer_present, len(calls) AS n_calls, len(blocks) - len(calls) AS malformed FROM c2",
        "tool_validation": f"{results_sql(99)} SELECT task_id, turn, call, name, invalid, result FROM results",
        "turn_tool_response": f"{results_sql(99)} SELECT p.task_id, p.turn, CASE WHEN count(r.call) = 0 THEN '' ELSE coalesce(arg_max(r.result, r.call) FILTER (r.result <> 'tool execute success'), 'tool execute success') END AS tool_response FROM parsed p LEFT JOIN results r USING (task_id, turn) GROUP BY p.task_id, p.turn",
        "render_carry": f"{results_sql(99)} SELECT r.task_id, r.turn, r.call, r.rendered_path, r.render_before, s.last_render FROM renders r JOIN seen s USING (task_id, turn)",
        "answer_equivalence": f"{WITH}, f AS (SELECT task_id, turn, gold, unnest([gold, ' ' || gold || '.0 ', CAST(2 * gold::INT AS VARCHAR) || '/2', '1_' || gold, gold || 'd', gold || '/0', translate(gold || '/1', '0123456789', '{ARABIC}')]) AS model FROM turns_fx) SELECT *, {same('model', 'gold')} AS same FROM f",
        "candidate_format": f"{local} SELECT task_id, turn, candidate, base_ok, local_ok FROM cand",
        "critic_verdict": f"{verdicts(WITH, 'turns_fx')} SELECT task_id, turn, has_object, has_fields, has_consistent, v_consistent AS consistent, v_correct AS is_correct, v_normalized AS normalized, v_critique AS critique, len(elements) AS n_elements FROM verdict",
        "hallucinations": f"{verdicts(WITH, 'turns_fx')}, h AS (SELECT task_id, turn, unnest(elements) AS e, generate_subscripts(elements, 1) - 1 AS i FROM verdict) SELECT task_id, turn, i, {', '.join(f"json_extract_string(e, '$.{c}') AS {c}" for c in judge.ELEMENT)} FROM h",
        "reask": f"{verdicts(WITH, 'turns_fx')} SELECT task_id, turn, NOT has_fields AND NOT has_consistent AS rendered, NOT has_fields AS unrendered FROM verdict WHERE NOT has_fields",
        "judge_merge": f"{merged} SELECT {columns} FROM judged",
        "judge_local": f"{local} SELECT {columns} FROM judged",
        "judge_renders": f"{judged_sql(True)} SELECT last_render, {columns} FROM judged",
        "judge_again": f"{judged_sql(True, shown='true', again=True)} SELECT {columns} FROM judged",
        "trajectory_outcome": f"{outcome(False, 6, 'turn <= 6')} SELECT * FROM outcomes",
        "retry_phase": f"{outcome(False, 1, 'turn <= 3')} SELECT * FROM outcomes",
        "usage_forms": f"{WITH}, u AS (SELECT task_id, turn, CASE WHEN turn % 2 <> 0 THEN 0 WHEN total_tokens = 0 THEN prompt_tokens + completion_tokens ELSE total_tokens END AS n FROM turns_fx) SELECT task_id, turn, n AS mapping_total, nullif(n, 0) AS object_total FROM u",
        "usage_by_task": f"{WITH}, {USAGE} SELECT task_id, {TOKENS} FROM usage GROUP BY task_id",
        "run_summary": f"{outcome(False, 6, 'turn <= 6')}, {USAGE}, u AS (SELECT {TOKENS} FROM usage) SELECT count(*) AS tasks, count(*) FILTER (reward >= 1) AS passed, round(sum(reward) / greatest(count(*), 1), 6) AS avg_reward, any_value(u.prompt_tokens) AS prompt_tokens, any_value(u.completion_tokens) AS completion_tokens, any_value(u.total_tokens) AS total_tokens FROM outcomes, u",
        "messages": f"{own} SELECT task_id, pos, turn, role, md5(content) AS content_md5 FROM ended",
        "messages_retry": f"{retried} SELECT task_id, pos, turn, role, md5(content) AS content_md5 FROM ended",
        "sft_turns": f"{retried} SELECT s.task_id, s.turn, o.pid, n_prompt, md5(prompt) AS prompt_md5, md5(completion) AS completion_md5, reward FROM sft s JOIN outcomes o USING (task_id)",
        "sft_rewarded": f"{own} SELECT o.task_id, o.pid, count(*) AS n_examples, sum(reward) AS reward FROM sft JOIN outcomes o USING (task_id) WHERE reward = 1 GROUP BY o.task_id, o.pid",
        "results": f"""{own}, n AS (SELECT task_id, count(*) AS n_messages, md5(string_agg(role || '=' || content, chr(10) ORDER BY pos)) AS said FROM ended GROUP BY task_id), {TURN_TEXTS} SELECT CASE WHEN broken THEN md5('') ELSE said END AS messages_md5, CASE WHEN broken THEN md5('') ELSE coalesce(x.told, md5('')) END AS turns_md5, t.task_id, t.pid, CASE WHEN broken THEN 'cannot open ' || image_path END AS error, CASE WHEN NOT broken THEN final_answer END AS final_answer, CASE WHEN broken THEN 0.0 ELSE reward END AS reward, CASE WHEN broken THEN 'FAIL' ELSE status END AS status,
  CASE WHEN NOT broken THEN printf('task-%d-pid-%s', t.task_id, t.pid) END AS session_id, CASE WHEN NOT broken THEN printf('renders/task-%d-pid-%s', t.task_id, t.pid) END AS render_dir, CASE WHEN broken THEN 0 ELSE n_messages END AS n_messages, CASE WHEN broken THEN 0 ELSE n_turns END AS n_turns, true AS ordered FROM own t JOIN outcomes o USING (task_id) JOIN n USING (task_id) LEFT JOIN turn_texts x USING (task_id)""",
        "message_images": f"""{own}, {STAND_INS}, p AS (SELECT l.task_id, l.pos, l.kind, l.content, CASE WHEN l.kind = 0 AND l.role = 'user' THEN 'text:' || o.instruction || coalesce('|image_url:' || i.url, '') WHEN l.shown THEN '' WHEN starts_with(l.content, 'image_url:') THEN regexp_replace(l.content, '^image_url:[^|]*\\|', '') ELSE l.content END AS kept, CASE WHEN l.kind = 0 AND l.role = 'user' THEN 1 + (i.url IS NOT NULL)::INT WHEN l.shown THEN 0 ELSE 1 END AS n_parts FROM log l JOIN own o USING (task_id) LEFT JOIN stand_ins i ON o.image_path = i.path) SELECT task_id, pos, n_parts::BIGINT AS n_parts, md5(kept) AS content_md5 FROM p""",
        "reasoning_merge": f"{WITH} SELECT task_id, turn, md5(CASE WHEN contains(lower(assistant_raw), '<think>') THEN assistant_raw ELSE '<think>r' || gold || '</think>' || CASE WHEN {trim('assistant_raw')} <> '' THEN chr(10) || {trim('assistant_raw')} ELSE '' END END) AS merged_md5 FROM turns_fx",
        "content_texts": f"SELECT conv_id, md5({trim("coalesce(string_agg(text, chr(10) ORDER BY turn) FILTER (role <> 'system'), '')")}) AS text_md5 FROM conversations GROUP BY conv_id",
        "render_manifest": f"{WITH}, e AS (SELECT session_id AS s, (seq - 1) // 3 + 1 AS turn, (seq - 1) % 3 AS call FROM edits_fx) SELECT s AS task_id, turn, call, printf('task-%d-pid-s%d', s, s) AS session_id, printf('renders/task-%d-pid-s%d/rendered-turn-%03d-tool-%02d.png', s, s, turn, call) AS path FROM e UNION ALL SELECT DISTINCT s, 0, NULL, printf('task-%d-pid-s%d', s, s), printf('renders/task-%d-pid-s%d/rendered-turn-000.png', s, s) FROM e",
        "canvas_flat": f"{WITH}, {FLAT} SELECT session_id, target_id, fill, pos FROM flat",
        "canvas_viewport": f"{WITH}, {FLAT} SELECT session_id, target_id, fill, pos FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY pos DESC) AS back FROM flat) WHERE back <= 3",
        "canvas_revert": f"{WITH} SELECT session_id, action, count(*) AS n, max(seq) AS last_seq FROM edits_fx WHERE render_ok AND target_id <> 'e4' GROUP BY session_id, action",
        "canvas_tree": f"{WITH}, {TREE} SELECT session_id, pos, parent, tag, element_id, attrs, text FROM tree",
        "canvas_groups": f"{WITH}, {FLAT} SELECT session_id, target_id, pos FROM flat",
        "canvas_base": f"{WITH}, {FLAT}, s AS (SELECT DISTINCT session_id FROM edits_fx) SELECT session_id, CASE WHEN session_id % 2 = 0 THEN 2 ELSE 0 END AS n_base, count(target_id) AS n_groups, any_value(CASE WHEN session_id % 2 = 0 THEN 'data:image/png;base64,' || session_id END) AS src FROM s LEFT JOIN flat USING (session_id) GROUP BY session_id",
        "sanitize_html": f"{WITH} SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'color:#ED2633;font-size:14px;padding:8px 0;word-break:break-word;' ELSE '' END AS style, CASE WHEN page_id % 4 = 0 THEN replace(url, '&', '&amp;') ELSE '' END AS url, CASE WHEN page_id % 4 = 1 THEN '<text x=\"3\" y=\"0\" fill=\"#ED2633\">' ELSE '' END AS svg, page_id % 4 = 2 AS has_img FROM html_fx",
        "image_parts": f"{TASKS}, {STAND_INS} SELECT task_id, md5(coalesce(url, '')) AS url_md5, length(coalesce(url, '')) AS n_chars FROM own LEFT JOIN stand_ins ON image_path = path",
        "policy_requests": f"{TASKS} SELECT task_id, 'policy' AS model, 'own' AS provider, 0.5::DOUBLE AS temperature, 256::BIGINT AS max_tokens, 120::BIGINT AS timeout, true AS has_tools, md5(instruction) AS text_md5, image_path AS image, nullif(first_render, '') AS render FROM own",
        "critic_requests": f"{seen}, {STAND_INS} SELECT task_id, turn, CASE WHEN i.url IS NULL THEN 'without one' ELSE 'with an image' END AS system, md5(question) AS question_md5, CASE WHEN i.url IS NULL THEN last_render ELSE image_path END AS first, CASE WHEN i.url IS NOT NULL THEN last_render END AS second, true AS untimed FROM seen LEFT JOIN stand_ins i ON image_path = path WHERE last_render <> '' AND len(calls) > 0 AND NOT answer_present",
        "judge_requests": f"""{judged_sql(True, 2)} SELECT task_id, turn, CASE WHEN last_render <> '' OR turn > 2 THEN 'rendered' ELSE 'unrendered' END AS system, 'Reference answers:' || chr(10) || '["' || gold || '"]' AS golds, md5('Question:' || chr(10) || question || 'Assistant final output:' || chr(10) || assistant_raw) AS said_md5, image_path AS image, nullif(last_render, '') AS render FROM judged WHERE turn > 2 OR (answer_present AND (last_render <> '' OR (base_ok AND NOT local_ok)))""",
        "second_requests": f"{judged_sql(True, 2)} SELECT task_id, turn, 'user' AS role, CASE WHEN last_render <> '' OR turn > 2 THEN 'Return ONLY strict JSON with keys: hallucination_elements, is_consistent, format_ok, is_correct, normalized_answer. No extra words.' ELSE 'Return ONLY strict JSON with keys: format_ok, is_correct, normalized_answer. No extra words.' END AS asked FROM judged WHERE (turn > 2 OR (answer_present AND (shown OR (base_ok AND NOT local_ok)))) AND NOT has_fields AND (NOT shown OR NOT has_consistent)",
    }
