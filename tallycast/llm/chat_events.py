"""Conversations from event logs, rendered for training.

A log holds, per conversation and in sequence order, ``open`` (a message of a
role begins), ``delta`` (text streamed to it), ``edit`` (its text is replaced)
and ``regenerate`` (its text is dropped, and so are the messages opened after
it). ``fold`` sorts and folds the log into final messages, ``render`` writes
them with turn marks and returns where the text under the loss mask lies,
``parse`` reads a rendered conversation back.

Control strings are made of ``<|``; inside texts ``<`` + backslashes + ``|``
gets one more backslash, which is undone exactly by taking one away. Roles are
URL-encoded. Only DataFrame expressions are used. A message's events are folded
before the messages of a conversation meet; one conversation, which is one row
of output, is the largest group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
LOSS_ROLE = "assistant"
PIECE = 200


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, position, role, text) from (conv_id, seq, kind, message, role, text).

    ``seq`` orders a conversation's events, nulls first; equal ones are ordered
    by kind and text. A message without ``open`` counts from its first event and
    has an empty role; the last ``open`` names the role. Null texts are empty;
    unknown kinds change nothing; a null conversation is a conversation, and a
    null message is a message of it.
    """
    reset = F.col("kind").isin("edit", "regenerate")
    one = events.groupBy("conv_id", "message").agg(
        F.coalesce(F.min(F.when(F.col("kind") == "open", F.col("seq"))), F.min("seq")).alias("position"),
        F.coalesce(F.max_by("role", F.when(F.col("kind") == "open", F.struct("seq", "role"))), F.lit("")).alias("role"),
        F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("again"),
        F.max(F.when(reset, F.struct("seq", "kind"))).alias("reset"),
        F.sort_array(F.collect_list(F.when(F.col("kind").isin("delta", "edit"), F.struct("seq", "kind", F.coalesce("text", F.lit("")).alias("text"))))).alias("parts"))
    live = F.filter("parts", lambda p: F.col("reset").isNull() | (p["seq"] > F.col("reset.seq"))
                    | ((p["seq"] == F.col("reset.seq")) & (p["kind"] == "edit") & (F.col("reset.kind") == "edit")))
    text = F.array_join(F.transform(live, lambda p: p["text"]), "")
    earlier = Window.partitionBy("conv_id").orderBy("position", "message").rowsBetween(Window.unboundedPreceding, -1)
    return (one.withColumn("text", text).withColumn("cut", F.max("again").over(earlier))
            .filter(F.col("cut").isNull() | F.col("position").isNull() | (F.col("position") > F.col("cut")))
            .select("conv_id", "position", "message", "role", "text"))


def render(messages: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """(conv_id, formatted, loss_spans): one row per conversation; a span is
    (start, length) in code points of ``formatted``."""
    turns = messages.withColumns({"head": F.concat(F.lit(START), F.url_encode("role"), F.lit("\n")), "body": escape(F.col("text"))})
    turns = turns.withColumns({"n_head": F.length("head"), "n_body": F.length("body")})
    got = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "position", "message", F.concat("head", "body", F.lit(END)).alias("turn"), "n_head", "n_body", (F.col("role") == loss_role).alias("loss")))).alias("t"))

    def span(acc, t):
        here = F.struct((acc["at"] + t["n_head"]).alias("start"), t["n_body"].alias("length"))
        return F.struct((acc["at"] + t["n_head"] + t["n_body"] + len(END)).alias("at"),
                        F.when(t["loss"], F.concat(acc["spans"], F.array(here))).otherwise(acc["spans"]).alias("spans"))

    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    return got.select("conv_id", F.array_join("t.turn", "").alias("formatted"), F.aggregate("t", none, span, lambda acc: acc["spans"]).alias("loss_spans"))


def parse(formatted: Column) -> Column:
    """array<struct<role, text>> of a rendered conversation, unescaped."""
    pattern = r"(?s)<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n"
    roles = F.regexp_extract_all(formatted, F.lit(pattern), F.lit(1))
    texts = F.regexp_extract_all(formatted, F.lit(pattern), F.lit(2))
    return F.transform(F.arrays_zip(roles.alias("role"), texts.alias("text")),
                       lambda t: F.struct(F.url_decode(t["role"]).alias("role"), unescape(t["text"]).alias("text")))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), "")


def log_of(rows: DataFrame, piece: int = PIECE) -> DataFrame:
    """An event log that leads to ``rows`` (conv_id, turn, role, text): every text
    is streamed in pieces; assistant messages first stream a draft and are
    regenerated, the others begin with a slip that an edit mends. Rows of a
    conversation are numbered by turn, then role and text (nulls first)."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    said = rows.select("conv_id", "turn", role.alias("role"), text.alias("text")).withColumn("message", F.row_number().over(w).cast("long"))
    pieces = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{piece}}}"), F.lit(0))
    event = lambda kind, t: F.struct(F.lit(kind).alias("kind"), t.alias("text"))
    draft = F.array(event("delta", F.lit("draft ")), event("regenerate", F.lit(None).cast("string")))
    slip = F.array(event("delta", F.lit("slip")), event("edit", F.lit("")))
    log = F.concat(F.array(event("open", F.lit(None).cast("string"))), F.when(F.col("role") == LOSS_ROLE, draft).otherwise(slip),
                   F.transform(pieces, lambda p: event("delta", p)))
    return (said.select("conv_id", "message", "role", F.posexplode(log).alias("k", "e"))
            .select("conv_id", (F.shiftleft("message", 32) + F.col("k")).alias("seq"), F.col("e.kind").alias("kind"), "message", "role", F.col("e.text").alias("text")))
