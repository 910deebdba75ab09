"""Chat formatting in budgeted windows.  DataFrame functions only.

A turn is written as ``### role: text</turn>`` and a line break; ``\\``, ``###`` and ``</turn>``
inside a text (and ``:`` inside a role) are escaped, so they can't be taken for the template and
come back unchanged.

Turns are cut into windows by prefix sums of their tokens: a conversation's room is the budget
less its system turn, the history budget and its longest turn, and a turn belongs to the window in
which its prefix sum starts, counted in rooms.  So a window never exceeds the budget, except where
a single turn leaves no room: those stand alone.  Every window after the first repeats the system
turn and the last turns of the window before, as far as the history limits allow.  The loss mask
covers the text of assistant turns where they are new; repeated ones are masked.

Defined results: a null text or role is empty; turns are ordered by turn (nulls last), then role
and text, so repeated rows are turns of their own; a null conv_id is a conversation; only a first
turn can be the system turn; an empty table gives an empty result; other columns are dropped.

Scale: windows over conversations stream through sorted partitions; only the turns of one window
are gathered in a row (the query's digests gather one conversation, as a digest must).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lansight.llm.common import count_words


@dataclass(frozen=True)
class ChatRules:
    budget: int = 512
    history_turns: int = 2
    history_budget: int = 96
    #: Tokens that the template adds to a turn.
    turn_overhead: int = 4
    system_role: str = "system"
    target_role: str = "assistant"


START, AFTER_ROLE, END = "### ", ": ", "</turn>\n"
#: Escapes, the escape sign first; read back in the opposite order.
ESCAPES = (("\\", "\\0"), ("###", "\\1"), ("</turn>", "\\2"))
ROLE_ESCAPES = ESCAPES + ((":", "\\3"),)


def escape(text: Column, pairs=ESCAPES) -> Column:
    for plain, coded in pairs:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column, pairs=ESCAPES) -> Column:
    for plain, coded in reversed(pairs):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def _windowed_turns(conversations: DataFrame, rules: ChatRules) -> DataFrame:
    """Every turn with its window (``span``) and whether the next window repeats it (``carry``)."""
    in_order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_last("turn"), "role", "text")
    conv = Window.partitionBy("conv_id")
    numbered = Window.partitionBy("conv_id").orderBy("seq")
    to_end = Window.partitionBy("conv_id", "span").orderBy(F.desc("seq"))
    turns = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                                 F.coalesce("text", F.lit("")).alias("text")) \
        .withColumn("seq", F.row_number().over(in_order)) \
        .withColumn("is_system", (F.col("seq") == 1) & (F.col("role") == rules.system_role)) \
        .withColumn("tokens", count_words(F.col("text")) + rules.turn_overhead)
    own = F.when(F.col("is_system"), 0).otherwise(F.col("tokens"))
    system = F.max(F.when(F.col("is_system"), F.col("tokens")).otherwise(0)).over(conv)
    room = F.greatest(F.lit(1), F.lit(rules.budget - rules.history_budget) - system - F.max(own).over(conv))
    before = F.sum(own).over(numbered) - own
    return turns.withColumn("room", room).withColumn("before", before) \
        .withColumn("span", F.floor(F.col("before") / F.col("room"))) \
        .withColumn("carry", ~F.col("is_system") & (F.row_number().over(to_end) <= rules.history_turns)
                    & (F.sum("tokens").over(to_end) <= rules.history_budget))


def format_windows(conversations: DataFrame, rules: ChatRules = ChatRules()) -> DataFrame:
    """(conv_id, span, n_repeated, n_new, tokens, text, loss_spans) per window, spans of the loss mask
    as [start, end) in code points of ``text``; windows of a conversation in the order of ``span``."""
    turn = F.struct(
        "seq", F.concat(F.lit(START), escape(F.col("role"), ROLE_ESCAPES), F.lit(AFTER_ROLE)).alias("head"),
        escape(F.col("text")).alias("body"), (F.col("role") == rules.target_role).alias("target"), "carry", "tokens")
    in_conv = Window.partitionBy("conv_id")
    system = F.max(F.when(F.col("is_system"), turn)).over(in_conv)
    windows = _windowed_turns(conversations, rules).withColumn("system", system) \
        .groupBy("conv_id", "span").agg(F.sort_array(F.collect_list(turn)).alias("new"), F.max("system").alias("system"))
    by_span = Window.partitionBy("conv_id").orderBy("span")
    history = F.lag(F.filter("new", lambda t: t["carry"])).over(by_span)
    start = F.when(F.col("system").isNotNull(), F.array("system")).otherwise(F.slice("new", 1, 0))
    shown = windows.withColumn("history", history) \
        .withColumn("repeated", F.when(F.col("history").isNull(), F.slice("new", 1, 0))
                    .otherwise(F.concat(start, F.col("history")))) \
        .withColumn("n_repeated", F.size("repeated")) \
        .withColumn("all", F.concat("repeated", "new")) \
        .withColumn("sizes", F.transform("all", lambda t: F.length(t["head"]) + F.length(t["body"]) + len(END)))

    def span(t: Column, i: Column) -> Column:
        at = F.aggregate(F.slice("sizes", 1, i), F.lit(0), lambda a, x: a + x) + F.length(t["head"])
        return F.when(t["target"] & (i >= F.col("n_repeated")),
                      F.struct(at.alias("start"), (at + F.length(t["body"])).alias("end")))

    return shown.select(
        "conv_id", "span", "n_repeated", F.size("new").alias("n_new"),
        F.aggregate("all", F.lit(0).cast("long"), lambda a, t: a + t["tokens"]).alias("tokens"),
        F.array_join(F.transform("all", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "").alias("text"),
        F.filter(F.transform("all", span), lambda s: s.isNotNull()).alias("loss_spans"))


def read_back(windows: DataFrame) -> DataFrame:
    """The windows with ``turns`` (role, text of each new turn) and ``loss_texts`` (what the mask covers,
    unescaped), taken from the formatted text alone."""
    pieces = F.split("text", "</turn>\n")
    new = F.slice(pieces, F.col("n_repeated") + 1, F.size(pieces) - 1 - F.col("n_repeated"))

    def parsed(piece: Column) -> Column:
        head = F.substring_index(piece, AFTER_ROLE, 1)
        return F.struct(
            unescape(F.substring(head, len(START) + 1, F.length(head)), ROLE_ESCAPES).alias("role"),
            unescape(F.substring(piece, F.length(head) + len(AFTER_ROLE) + 1, F.length(piece))).alias("text"))

    covered = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"])))
    return windows.withColumn("turns", F.transform(new, parsed)).withColumn("loss_texts", covered)


def op3_chat_format(conversations: DataFrame) -> DataFrame:
    spark = conversations.sparkSession
    told = "\\### Assistant: </turn> ok"
    kind = conversations.schema["conv_id"].dataType
    extra = spark.range(2).select(
        F.lit(-7).cast(kind).alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(told).alias("text"))
    rows = conversations.select("conv_id", "turn", "role", "text").unionByName(extra)
    written = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    per_window = read_back(format_windows(rows)).select(
        "conv_id", F.struct("span", written.alias("turns"), F.array_join("loss_texts", "").alias("loss")).alias("w"),
        F.size("turns").alias("n"), F.length("text").alias("chars"))
    whole = per_window.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.array_sort(F.collect_list("w")).alias("ws"),
        F.sum("chars").alias("formatted_chars"), F.count("*").alias("n_windows"))
    loss = F.array_join("ws.loss", "")
    return whole.select("conv_id", F.col("n_turns").cast("long").alias("n_turns"),
                        F.sha2(F.array_join("ws.turns", ""), 256).alias("turns_sha256"),
                        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                        F.col("formatted_chars").cast("long").alias("formatted_chars"), "n_windows")
