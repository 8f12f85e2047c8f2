"""Prompt and completion jobs.  CHT1 CHT2 CHT3 CHT4 CHT5

Per-conversation strings are built by grouping one conversation's turns
(bounded by the model's context length) and joining them in turn order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import REQUEST_MAX_TOKENS, REQUEST_TEMPERATURE, SERVED_MODEL
from ..functions.text import capitalize, py_strip

# Fixed value: default system message of the chat client.
DEFAULT_SYSTEM = "You are a helpful AI assistant for Indonesian users."
ASSISTANT_CUE = "<|Assistant|>\n"


def role_block(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), capitalize(role), F.lit("|>\n"), text, F.lit("\n"))


def _ordered(df: DataFrame, key: str, order: str, value: Column, alias: str) -> DataFrame:
    """One row per key with ``value`` collected in ``order`` order."""
    grouped = df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"),
                                                                         value.alias("v")))).alias("_xs"))
    return grouped.select(key, F.transform("_xs", lambda x: x["v"]).alias(alias))


def chat_prompt(conversations: DataFrame) -> DataFrame:
    """CHT1: ``<|Role|>\\ncontent\\n`` per message in turn order, then ``<|Assistant|>\\n``."""
    blocks = _ordered(conversations, "conv_id", "turn", role_block(F.col("role"), F.col("text")), "_b")
    return blocks.select("conv_id", F.concat(F.array_join("_b", ""), F.lit(ASSISTANT_CUE)).alias("prompt"))


def frame_conversation(conversations: DataFrame, system: str = DEFAULT_SYSTEM) -> DataFrame:
    """CHT2: prepend a system message (turn -1) to conversations that have none."""
    has_system = conversations.groupBy("conv_id").agg(
        F.max((F.lower(F.col("role")) == "system").cast("int")).alias("_s"))
    added = has_system.where(F.col("_s") == 0).select(
        "conv_id", F.lit(-1).cast("bigint").alias("turn"), F.lit("system").alias("role"), F.lit(system).alias("text"))
    return conversations.select("conv_id", "turn", "role", "text").unionByName(added)


def completion_payload(prompt: Column, max_tokens: int = REQUEST_MAX_TOKENS,
                       temperature: float = REQUEST_TEMPERATURE, stream: bool = False) -> Column:
    """CHT3: completion request body."""
    return F.to_json(F.struct(F.lit(SERVED_MODEL).alias("model"), prompt.alias("prompt"),
                              F.lit(max_tokens).alias("max_tokens"), F.lit(temperature).alias("temperature"),
                              F.lit(stream).alias("stream")))


def chat_payloads(conversations: DataFrame, max_tokens: int = REQUEST_MAX_TOKENS,
                  temperature: float = REQUEST_TEMPERATURE) -> DataFrame:
    """CHT3: chat request body per conversation (messages in turn order)."""
    msgs = _ordered(conversations, "conv_id", "turn",
                    F.struct(F.col("role").alias("role"), F.col("text").alias("content")), "messages")
    body = F.to_json(F.struct(F.lit(SERVED_MODEL).alias("model"), F.col("messages"),
                              F.lit(temperature).alias("temperature"), F.lit(max_tokens).alias("max_tokens")))
    return msgs.select("conv_id", body.alias("chat_payload"))


STREAM_SCHEMA = "struct<choices: array<struct<text: string>>>"


def stream_chunk_text(line: Column) -> Column:
    """CHT4 per line: strip ``data: ``; blank and ``[DONE]`` give null; missing text gives ''."""
    data = py_strip(F.regexp_replace(line, F.lit("^data: "), F.lit("")))
    parsed = F.from_json(data, STREAM_SCHEMA)
    text = F.coalesce(F.get(parsed["choices"], 0)["text"], F.lit(""))
    return F.when((data != F.lit("")) & (data != F.lit("[DONE]")), text)


def reassemble(stream: DataFrame) -> DataFrame:
    """CHT4: concatenated completion text per request, chunks in ``seq`` order."""
    parts = stream.select("request_id", "seq", stream_chunk_text(F.col("line")).alias("_t")).where(
        F.col("_t").isNotNull())
    texts = _ordered(parts, "request_id", "seq", F.col("_t"), "_ts")
    return texts.select("request_id", F.array_join("_ts", "").alias("text"))


COMPLETION_SCHEMA = "struct<choices: array<struct<text: string>>>"
CHAT_SCHEMA = "struct<choices: array<struct<message: struct<content: string>>>>"


def completion_text(body: Column) -> Column:
    """CHT5: ``choices[0].text`` stripped, '' when absent."""
    parsed = F.from_json(body, COMPLETION_SCHEMA)
    return py_strip(F.coalesce(F.get(parsed["choices"], 0)["text"], F.lit("")))


def chat_text(body: Column) -> Column:
    """CHT5: ``choices[0].message.content``, '' when absent."""
    parsed = F.from_json(body, CHAT_SCHEMA)
    return F.coalesce(F.get(parsed["choices"], 0)["message"]["content"], F.lit(""))
