"""Rounds of batch inference: which requests are due, under ids that depend on what they say, and what became of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.batches import BatchTable
from ..sources.requests import Call, as_sent, body
from .judge import needs_second, verdict_of
from .trajectory import prompt_pointers, with_prompts


def open_tasks(tasks: DataFrame, kept: DataFrame, main_rounds: int = 6, max_retries: int = 2) -> DataFrame:
    """task_id and turn, the next one, of tasks without an accepted turn that have rounds or retries left. kept: judged turns, numbered from 1 without gaps."""
    done = kept.groupBy("task_id").agg(F.count(F.lit(1)).alias("n"), F.bool_or("accepted").alias("accepted"))
    told = tasks.select("task_id").join(done, "task_id", "left")
    due = ~F.coalesce("accepted", F.lit(False)) & (F.coalesce("n", F.lit(0)) < main_rounds + max_retries)
    return told.where(due).select("task_id", (F.coalesce("n", F.lit(0)) + 1).cast("int").alias("turn"))


def next_requests(tasks: DataFrame, kept: DataFrame, log: DataFrame, call: Call, main_rounds: int = 6, max_retries: int = 2) -> DataFrame:
    """task_id, turn, body: the policy's next request of every open task; retries end with the request for an answer.

    log: message_log() of the same turns. Of the renders observed the last is in a request, as at any prompt.
    """
    due = open_tasks(tasks, kept, main_rounds, max_retries)
    pointers = prompt_pointers(log, main_rounds, due).join(due.select("task_id", F.col("turn").alias("due")), "task_id").where(F.col("turn") == F.col("due")).drop("due")
    sent = F.transform("prompt", lambda m: F.struct(m["role"].alias("role"), as_sent(m["parts"]).alias("content")))
    return with_prompts(pointers, log).select("task_id", "turn", body(call, sent).alias("body"))


def request_id(kind: Column | str) -> Column:
    """Of task_id, turn, kind (policy, critic, judge or second) and body: whoever asks the same of the same turn gets the same id."""
    said = F.concat_ws("\n", F.col("task_id").cast("string"), F.col("turn").cast("string"), F.lit(kind) if isinstance(kind, str) else kind, "body")
    return F.sha2(said.cast("binary"), 256)


def with_ids(requests: DataFrame, kind: str) -> DataFrame:
    return requests.select(request_id(kind).alias("request_id"), "task_id", "turn", F.lit(kind).alias("kind"), "body")


def first_replies(replies: DataFrame) -> DataFrame:
    """request_id, reply, n_replies: of several replies the one that arrived first, of those the least text. A null reply is none."""
    said = replies.where(F.col("reply").isNotNull())
    return said.groupBy("request_id").agg(F.min_by("reply", F.struct("arrived", "reply")).alias("reply"), F.count(F.lit(1)).alias("n_replies"))


def answered(requests: DataFrame, replies: DataFrame) -> DataFrame:
    """requests with reply (null while none is there) and n_replies. Replies to requests that were not sent are passed over."""
    out = requests.join(first_replies(replies), "request_id", "left")
    return out.withColumn("n_replies", F.coalesce("n_replies", F.lit(0).cast("long")))


def settled(first: DataFrame, second: DataFrame, replies: DataFrame, rendered: Column) -> DataFrame:
    """first (judge requests with ids, and what rendered needs) with verdict and status: waiting, reask (the second request is due) or settled.

    second: requests with ids of turns whose first verdict lacks the keys, as far as they were sent. A verdict that lacks them is settled
    once its second request has a reply, whatever that says.
    """
    told = answered(first, replies)
    again = answered(second.select("request_id", "task_id", "turn"), replies).select("task_id", "turn", F.col("reply").alias("second_reply"))
    lacking = needs_second(verdict_of("reply"), rendered)
    judged = told.withColumn("lacking", F.when(F.col("reply").isNotNull(), lacking)).join(again, ["task_id", "turn"], "left")
    status = F.when(F.col("reply").isNull(), "waiting").when(F.col("lacking") & F.col("second_reply").isNull(), "reask").otherwise("settled")
    verdict = F.when(F.col("lacking"), F.coalesce("second_reply", "reply")).otherwise(F.col("reply"))
    return judged.withColumn("status", status).withColumn("verdict", F.when(F.col("status") == "settled", verdict)).drop("second_reply", "lacking")


class RoundLedger:
    """What was asked and what came back, by steps that can be run again.

    A step's requests are recorded once: a rerun returns those of the first run, whatever has been recorded since.
    Requests that an earlier step sent are not sent again. Replies come in batches, each of which counts once.
    """

    REQUESTS = "request_id string, task_id long, turn int, kind string, body string"
    REPLIES = "request_id string, reply string, arrived long"

    def __init__(self, spark: SparkSession, path: str):
        self.asked, self.came = BatchTable(spark, f"{path}/requests", self.REQUESTS), BatchTable(spark, f"{path}/replies", self.REPLIES)

    def issue(self, step: str, requests: DataFrame) -> DataFrame:
        """The requests (with_ids()) of a step that no other step has sent."""
        columns = ["request_id", F.col("task_id").cast("long").alias("task_id"), F.col("turn").cast("int").alias("turn"), "kind", "body"]
        new = requests.select(*columns).dropDuplicates(["request_id"]).join(self.asked.read().select("request_id"), "request_id", "left_anti")
        self.asked.append(step, new)
        return self.asked.read(step)

    def record(self, batch: str, replies: DataFrame) -> bool:
        """replies: request_id, reply, arrived. False if the batch is recorded already."""
        return self.came.append(batch, replies.select("request_id", "reply", F.col("arrived").cast("long").alias("arrived")))

    def state(self) -> DataFrame:
        """Every request sent, once, with reply and n_replies."""
        return answered(self.asked.read(), self.came.read())

    def pending(self) -> DataFrame:
        return self.state().where(F.col("reply").isNull())
