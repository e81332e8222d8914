"""Trajectories: the first accepted turn, retries, outcomes, message logs, fine-tuning examples, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import first_filled, strip
from ..sources.requests import PARTS, image_part, parts, text_part
from .judge import ACCEPTED
from ..sources.tasks import data_urls


def truncated(judged: DataFrame, max_rounds: int = 6) -> DataFrame:
    """Turns up to a task's first accepted one, max_rounds at most."""
    first = F.min(F.when(F.col("accepted"), F.col("turn"))).over(Window.partitionBy("task_id"))
    return judged.where(F.col("turn") <= max_rounds).withColumn("first_accepted", first).where(F.col("first_accepted").isNull() | (F.col("turn") <= F.col("first_accepted")))


def with_retries(judged: DataFrame, main_rounds: int, max_retries: int = 2) -> DataFrame:
    """Turns kept when those after main_rounds are retries: none if a main turn was accepted, max_retries at most."""
    first = F.min(F.when(F.col("accepted"), F.col("turn"))).over(Window.partitionBy("task_id"))
    kept = judged.where(F.col("turn") <= main_rounds + max_retries).withColumn("first_accepted", first)
    return kept.where(F.col("first_accepted").isNull() | (F.col("turn") <= F.col("first_accepted")))


def outcomes(tasks: DataFrame, kept: DataFrame) -> DataFrame:
    """A row for each task: n_turns, final_answer, reward, status. A task without turns failed."""
    done = kept.groupBy("task_id").agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.max_by(F.when(F.col("accepted"), strip(first_filled(F.col("normalized"), F.col("candidate")))), F.when(F.col("accepted"), F.col("turn"))).alias("final_answer"),
        F.max(F.col("accepted").cast("double")).alias("reward"),
    )
    out = tasks.select("task_id", "pid").join(done, "task_id", "left")
    return out.select("task_id", "pid", F.coalesce("n_turns", F.lit(0)).alias("n_turns"), F.coalesce("final_answer", F.lit("")).alias("final_answer"), F.coalesce("reward", F.lit(0.0)).alias("reward"), F.when((F.col("reward") >= 1) & (F.col("n_turns") > 0), "PASS").otherwise("FAIL").alias("status"))


def run_summary(results: DataFrame, usage: DataFrame) -> DataFrame:
    sums = usage.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("prompt_tokens", "completion_tokens", "total_tokens")])
    heads = results.agg(F.count(F.lit(1)).alias("tasks"), F.count_if(F.col("reward") >= 1.0).alias("passed"), F.round(F.coalesce(F.sum("reward"), F.lit(0.0)) / F.greatest(F.count(F.lit(1)), F.lit(1)), 6).alias("avg_reward"))
    return heads.join(F.broadcast(sums))  # one row each


def usage_by_task(usage: DataFrame) -> DataFrame:
    """Sums of the policy's three counters; missing ones are 0."""
    return usage.groupBy("task_id").agg(*[F.sum(F.coalesce(c, F.lit(0))).cast("long").alias(c) for c in ("prompt_tokens", "completion_tokens", "total_tokens")])


#: Order of messages within a turn.
START, ASSISTANT, TOOL, CRITIQUE, FEEDBACK, PROMPT = range(6)
#: A place after every message.
NEXT = (1 << 31) - 1
#: Texts of the log.
RETRY_PROMPT = "Please provide the final answer directly as <answer>\\boxed{...}</answer>. Do not output any reasoning or SVG code."
CHECKED = ("<tool_response><image>This is the state of notebook. Critical Check: ", "</tool_response>")
REVISE = ("<answer_judge>", "</answer_judge>\nPlease revise. Your response must include an explicit <answer>\\boxed{...}</answer> field.")
RESPONSE = ("<tool_response>", "</tool_response>")


def within(around: tuple[str, str], text: Column) -> Column:
    return F.concat(F.lit(around[0]), text, F.lit(around[1]))


def assistant_text() -> Column:
    """What a turn says in the log: the response as it came; where that is blank, what was parsed from it."""
    return first_filled(strip(F.coalesce("assistant_raw", F.lit(""))), F.col("seed_content"), F.col("content"))


def critic_feedback(main_rounds: int | None = None) -> Column:
    """The verdict's critique on turns that answer and on retries, the critic's own words where tools ran and a render is there, else ''."""
    retry = F.col("turn") > main_rounds if main_rounds else F.lit(False)
    called = (F.size("tool_calls") > 0) & ~retry & (F.col("last_render") != "")
    return F.when(F.col("answer_present") | retry, F.col("critique")).when(called, strip(F.coalesce("critic_raw", F.lit("")))).otherwise("")


def message_log(tasks: DataFrame, kept: DataFrame, system: str, main_rounds: int | None = None) -> DataFrame:
    """task_id, pos (from 0), turn, kind, call, role, parts, shown: every message of each task, in order; shown: a render that was observed.

    tasks: instruction, image_path, first_render. kept: judged turns with_calls(), and critic_raw, the critic's words on
    turns without an answer. Turns after main_rounds are retries: their tools do not run, an answer is
    expected of each, and they are fed back whether or not it is there.
    """

    def entry(kind: int, role: str, content: Column, call: Column | int = 0, shown: Column | bool = False) -> Column:
        as_column = lambda v: F.lit(v) if isinstance(v, (int, bool)) else v
        return F.struct(F.lit(kind).alias("kind"), as_column(call).cast("int").alias("call"), F.lit(role).alias("role"), content.alias("parts"), as_column(shown).alias("shown"))

    retry = F.col("turn") > main_rounds if main_rounds else F.lit(False)
    called, answered = (F.size("tool_calls") > 0) & ~retry, F.col("answer_present") | retry
    critique = critic_feedback(main_rounds)
    checked = (answered & (critique != "")) | (~answered & called & (F.col("last_render") != ""))
    response = lambda c: F.when(c["path"] != "", parts(image_part(c["path"]))).otherwise(parts(image_part(c["before"]), text_part(within(RESPONSE, c["result"]))))
    ran = F.when(~retry, F.transform("ran", lambda c: entry(TOOL, "user", response(c), c["call"], c["path"] != "")))
    others = F.array(
        F.when(checked, entry(CRITIQUE, "user", parts(text_part(within(CHECKED, critique))))),
        F.when(answered & ~F.col("accepted"), entry(FEEDBACK, "user", parts(image_part(F.col("last_render")), text_part(within(REVISE, F.col("feedback")))))),
        F.when(~answered & ~called, entry(PROMPT, "user", parts(text_part(F.lit(RETRY_PROMPT))))),
    )
    every = F.concat(F.array(entry(ASSISTANT, "assistant", parts(text_part(assistant_text())))), F.coalesce(ran, F.array()), F.filter(others, lambda e: e.isNotNull()))
    # Turns are read once, as each makes all its messages in its row.
    told = kept.select("task_id", F.col("turn").cast("int").alias("turn"), F.explode(every).alias("e"))
    begun = F.explode(F.array(entry(START, "system", parts(text_part(F.lit(system)))), entry(START, "user", parts(text_part(F.col("instruction")), image_part(F.col("image_path")), image_part(F.col("first_render"))), 1)))
    log = tasks.select("task_id", F.lit(0).alias("turn"), begun.alias("e")).unionByName(told).select("task_id", "turn", "e.*")
    return log.withColumn("pos", F.row_number().over(Window.partitionBy("task_id").orderBy("turn", "kind", "call")) - 1)


def messages(log: DataFrame) -> DataFrame:
    """The log as it ends: of the renders that were observed only the last stays. pos counts anew."""
    last = F.max(F.when(F.col("shown"), F.col("pos"))).over(Window.partitionBy("task_id"))
    left = log.withColumn("last", last).where(~F.col("shown") | (F.col("pos") == F.col("last"))).drop("last", "shown")
    return left.withColumn("pos", F.row_number().over(Window.partitionBy("task_id").orderBy("pos")) - 1)


def prompt_pointers(log: DataFrame, main_rounds: int | None = None, open_: DataFrame | None = None) -> DataFrame:
    """task_id, turn, upto, render, ask: the prompt of each assistant message as a place in the log, so that examples share their messages.

    A prompt is the log's messages before upto, of the renders observed among them the one at render alone (null: none), and
    where ask is true the request for an answer, which the log does not have. open_ (task_id, turn): turns to come, whose
    prompt is the whole log.
    """
    past = Window.partitionBy("task_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    marked = log if open_ is None else log.unionByName(open_.select("task_id", F.col("turn").cast("int").alias("turn"), F.lit(ASSISTANT).alias("kind"), F.lit(NEXT).alias("pos")), allowMissingColumns=True)
    placed = marked.select("task_id", "turn", "kind", "pos", F.max(F.when(F.col("shown"), F.col("pos"))).over(past).alias("render"), F.count(F.lit(1)).over(past).cast("int").alias("upto"))
    ask = F.col("turn") > main_rounds if main_rounds else F.lit(False)
    return placed.where(F.col("kind") == ASSISTANT).select("task_id", "turn", "upto", "render", ask.alias("ask"))


def with_prompts(pointers: DataFrame, log: DataFrame) -> DataFrame:
    """pointers with prompt, an array of (role, parts), and said, the message at upto (null for turns to come). A task's log is gathered once."""
    whole = log.groupBy("task_id").agg(F.array_sort(F.collect_list(F.struct("pos", "shown", "role", "parts"))).alias("m"))
    each = pointers.join(whole, "task_id")
    seen = F.filter(F.slice("m", F.lit(1), F.col("upto")), lambda x: ~x["shown"] | (x["pos"] == F.coalesce("render", F.lit(-1))))
    prompt = F.transform(seen, lambda x: F.struct(x["role"].alias("role"), x["parts"].alias("parts")))
    ask = F.array(F.struct(F.lit("user").alias("role"), parts(text_part(F.lit(RETRY_PROMPT))).alias("parts")))
    said = F.when(F.col("upto") < F.size("m"), F.try_element_at("m", F.col("upto") + 1)["parts"][0]["text"])
    return each.select(*pointers.columns, F.when(F.col("ask"), F.concat(prompt, ask)).otherwise(prompt).alias("prompt"), said.alias("said"))


def sft_turns(log: DataFrame, results: DataFrame, main_rounds: int | None = None, only_rewarded: bool = False) -> DataFrame:
    """task_id, pid, turn, prompt, completion, reward: an example for each assistant message, with what preceded it as the prompt."""
    wanted = results.select("task_id", "pid", "reward").where("reward = 1.0" if only_rewarded else "true")
    pointers = prompt_pointers(log, main_rounds).join(wanted, "task_id")
    return with_prompts(pointers, log).select("task_id", "pid", "turn", "prompt", F.col("said").alias("completion"), "reward")


def with_image_data(log: DataFrame, images: DataFrame) -> DataFrame:
    """log with its image parts' paths as data URLs; parts whose image is not found are left out. Only paths are shuffled with the log, and each image is encoded once."""
    keys = [c for c in log.columns if c != "parts"]
    each = log.select(*keys, F.posexplode_outer("parts").alias("i", "p"))
    urls = data_urls(each.where("p.type = 'image_url'").select(F.col("p.url").alias("image_path")), images)
    joined = each.join(urls, F.col("p.url") == F.col("image_path"), "left")
    kept = F.when(F.col("p.type") != "image_url", F.col("p")).when(F.coalesce("image_url", F.lit("")) != "", F.struct(F.col("p.type"), F.col("p.text"), F.col("image_url").alias("url")))
    back = joined.select(*keys, F.struct("i", kept.alias("p")).alias("e")).groupBy(*keys).agg(F.array_sort(F.collect_list("e")).alias("es"))
    return back.select(*keys, F.transform(F.filter("es", lambda e: e["p"].isNotNull()), lambda e: e["p"]).cast(PARTS).alias("parts"))


def turn_items(kept: DataFrame, main_rounds: int | None = None) -> DataFrame:
    """task_id and item, all that a result tells of a turn. kept: judged turns with_calls(); usage, a struct of counters, may be missing.

    answer_judge is null on turns that neither answer nor are retries; its feedback is the judge's own.
    """
    retry = F.col("turn") > main_rounds if main_rounds else F.lit(False)
    answered = F.col("answer_present") | retry
    shown = (F.col("last_render") != "") | retry
    feedback = F.when(F.col("format_ok") & F.col("is_correct") & ~F.col("consistent"), ACCEPTED).otherwise(F.col("feedback"))
    critic = F.coalesce("critic_raw", F.lit("")) if "critic_raw" in kept.columns else F.lit("")
    judge_raw = F.when(shown | (F.col("base_ok") & ~F.col("local_ok")), critic).otherwise("")
    calls = lambda c: F.struct(c["name"].alias("name"), c["arguments_json"].alias("arguments_json"))
    parsed = F.struct("raw", F.col("reasoning").alias("reasoning_content"), F.col("reasoning").alias("think"), F.transform("tool_calls", calls).alias("tool_calls"), F.col("malformed").alias("malformed_tool_calls"), "answer", "boxed", "content", "seed_content", "has_answer_tag")
    ran = F.transform("ran", lambda c: F.struct(c["call"].alias("index"), c["name"].alias("name"), c["arguments_json"].alias("arguments_json"), c["result"].alias("result")))
    item = F.struct(
        "turn",
        F.coalesce("assistant_raw", F.lit("")).alias("assistant_raw"),
        assistant_text().alias("assistant_seed_content"),
        parsed.alias("parsed"),
        F.col("usage").alias("policy_usage") if "usage" in kept.columns else F.lit(None).cast("struct<prompt_tokens:bigint,completion_tokens:bigint,total_tokens:bigint>").alias("policy_usage"),
        ran.alias("tool_results"),
        F.col("last_render").alias("rendered_image_path"),
        F.when(retry, "").otherwise(F.col("tool_response")).alias("tool_response"),
        critic_feedback(main_rounds).alias("critic_feedback"),
        F.when(answered, F.struct("format_ok", "is_correct", F.col("normalized").alias("normalized_answer"), feedback.alias("feedback"), judge_raw.alias("judge_raw"))).alias("answer_judge"),
    )
    return kept.select("task_id", item.alias("item"))


def results(tasks: DataFrame, kept: DataFrame, log: DataFrame, errors: DataFrame, root: str = "renders", main_rounds: int | None = None) -> DataFrame:
    """A row for each task, as it is written: nested messages and turns (turn_items()), final_answer, reward, session_id, render_dir, order.

    tasks: with order. errors (task_id, error, elapsed_sec): a null error is none. A task with an error has neither messages
    nor turns, no answer, and reward 0.
    """
    told = turn_items(kept, main_rounds).groupBy("task_id").agg(F.array_sort(F.collect_list("item"), lambda a, b: (a["turn"] - b["turn"]).cast("int")).alias("turns"))
    said = messages(log).groupBy("task_id").agg(F.array_sort(F.collect_list(F.struct("pos", "role", "parts"))).alias("messages"))
    out = tasks.join(outcomes(tasks, kept).drop("pid"), "task_id").join(told, "task_id", "left").join(said, "task_id", "left").join(errors, "task_id", "left")
    fine = F.col("error").isNull()
    session = F.format_string("task-%d-pid-%s", "task_id", "pid")
    return out.select(
        "task_id", "pid", "question", "instruction", "answers", "order", "elapsed_sec", "error",
        F.when(fine, F.col("final_answer")).alias("final_answer"),
        F.when(fine, F.col("reward")).otherwise(0.0).alias("reward"),
        F.when(fine & (F.col("reward") >= 1.0), "PASS").otherwise("FAIL").alias("status"),
        F.when(fine, session).alias("session_id"),
        F.when(fine, F.concat(F.lit(f"{root}/"), session)).alias("render_dir"),
        *[F.filter(F.coalesce(c, F.array()), lambda x: fine).alias(c) for c in ("messages", "turns")],
    )
