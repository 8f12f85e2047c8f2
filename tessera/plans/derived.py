"""Inputs derived from the given tables (same recipe in Spark and in the SQL checks).

The reference reads run logs, benchmark items, model responses and streamed
completions that the test tables do not hold; each is derived here from a
table with plain column expressions, so the work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import MCQ_NEW_TOKENS
from ..functions.hashing import md5_index
from ..functions.text import words
from ..operators import evaluation, language_model
from ..operators.ordinal import with_ordinal
from ..session import reliable_checkpoint


def run_log(events: DataFrame) -> DataFrame:
    """(run_id, step, ts, loss, eval_loss): one run per user, steps in (ts, event_id) order.

    The step number is the per-run ordinal (range partitions; a run holding a
    third of all rows is spread over many tasks).
    """
    ranked = with_ordinal(events.select(F.col("user_id").alias("run_id"), "ts", "event_id", "value"),
                          ["ts", "event_id"], ["run_id"], out="_o")
    step = (F.col("_o") + 1).cast("bigint")
    return ranked.select(
        "run_id", step.alias("step"), "ts", F.col("value").alias("loss"),
        F.when(step % 5 == 0, F.col("value")).alias("eval_loss"))


def letter(n) -> F.Column:
    return F.element_at(F.array(*[F.lit(c) for c in "ABCD"]), (n % 4 + 1).cast("int"))


def mcq_items(benchmark: DataFrame) -> DataFrame:
    """(item_id, question, choices, answer): question = the whole text, choices = words 1-4."""
    return benchmark.select(
        "item_id",
        F.col("text").alias("question"),
        F.slice(words(F.col("text")), 1, 4).alias("choices"),
        F.lit(None).cast("string").alias("text"),
        letter(F.col("item_id")).alias("answer"),
        F.lit(None).cast("bigint").alias("label"),
    )


def mcq_side(item_id) -> F.Column:
    """0: the item is shown with its answer to the model in training; 1: it is answered (by md5 of the id)."""
    return md5_index(F.concat(F.lit("42:item:"), item_id.cast("string")), 2)


def mcq_answers(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(items, responses) of the answered half: the response is what a word model, trained on the prompts
    and answers of the other half, generates after the item's prompt."""
    items = mcq_items(benchmark)
    asked = items.withColumn("prompt", evaluation.prompt(items))
    shown = asked.where(mcq_side(F.col("item_id")) == 0).select(F.concat_ws(" ", "prompt", "answer").alias("text"))
    held = asked.where(mcq_side(F.col("item_id")) == 1)
    model = language_model.train_generator(shown)
    answers = language_model.generate_greedy(held.select("item_id", "prompt"), model, MCQ_NEW_TOKENS)
    model.drop()
    return held.drop("prompt"), answers.select("item_id", F.col("continuation").alias("response"))


def label_items(labels: DataFrame, documents: DataFrame) -> DataFrame:
    """Classification items: document text as the prompt, the quality label as answer key."""
    return labels.join(documents.select("doc_id", "text"), "doc_id").select(
        F.col("doc_id").alias("item_id"),
        F.lit(None).cast("string").alias("question"),
        F.lit(None).cast("array<string>").alias("choices"),
        "text",
        F.lit(None).cast("string").alias("answer"),
        F.col("quality").cast("bigint").alias("label"),
    )


def label_side(doc_id) -> F.Column:
    """0: the labelled document trains the class models; 1: it is answered (by md5 of the id)."""
    return md5_index(F.concat(F.lit("42:label:"), doc_id.cast("string")), 2)


def label_answers(labels: DataFrame, documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(items, responses) of the answered half: '1 …' if a bigram model of good documents finds the
    text at least as likely as one of bad documents, else '0 …'; both are trained on the other half."""
    rows = labels.select("doc_id", "quality").join(documents.select("doc_id", "text"), "doc_id").withColumn("_side", label_side(F.col("doc_id")))
    rows = reliable_checkpoint(rows)
    held = rows.where("_side = 1")
    answer = held.select("doc_id")
    for c in (0, 1):
        model = evaluation.bigram_model(rows.where((F.col("_side") == 0) & (F.col("quality") == c)))
        nll = evaluation.ngram_nll(held, *model, keys=("doc_id",)).select("doc_id", F.col("nll").alias(f"nll{c}"))
        answer = answer.join(nll, "doc_id", "left")
    response = F.when(F.col("nll1") <= F.col("nll0"), F.lit("1 …")).otherwise(F.lit("0 …"))
    return label_items(held.select("doc_id", "quality"), documents), answer.select(F.col("doc_id").alias("item_id"), response.alias("response"))


def summary_pairs(benchmark: DataFrame) -> DataFrame:
    """(item_id, prediction, reference): reference = text; prediction drops every 3rd word."""
    ws = words(F.col("text"))
    kept = F.filter(ws, lambda w, i: (i + 1) % 3 != 0)
    return benchmark.select("item_id", F.array_join(kept, " ").alias("prediction"), F.col("text").alias("reference"))


def stream_log(conversations: DataFrame) -> DataFrame:
    """(request_id, seq, line): one SSE line per turn, then a blank line and ``data: [DONE]``."""
    payload = F.to_json(F.struct(F.array(F.struct(F.col("text").alias("text"))).alias("choices")))
    turns = conversations.select(F.col("conv_id").alias("request_id"), F.col("turn").alias("seq"),
                                 F.concat(F.lit("data: "), payload).alias("line"))
    last = conversations.groupBy("conv_id").agg(F.max("turn").alias("_m"))
    tail = last.select(F.col("conv_id").alias("request_id"),
                       F.explode(F.array(
                           F.struct((F.col("_m") + 1).alias("seq"), F.lit("").alias("line")),
                           F.struct((F.col("_m") + 2).alias("seq"), F.lit("data: [DONE]").alias("line")))).alias("t"))
    return turns.unionByName(tail.select("request_id", F.col("t.seq").cast("bigint").alias("seq"), "t.line"))
