"""Chat formatting into budgeted windows with a loss mask.

A running sum of turn tokens cuts a conversation into turn-aligned spans.  Each
window repeats the system turn and a limited history before its own turns; the
mask covers assistant texts of its own turns only, so every assistant text is a
target exactly once.  All of it is built-in expressions.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn.  Inside roles and
texts ``<``, backslashes, ``|`` gets one more backslash, which can be undone;
a role's own newlines and backslashes are written as ``\\n`` and ``\\\\``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hazeframe.llm.tables import text_or_empty

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", "<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    plain = F.regexp_replace(unescape(role), r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
    return F.replace(plain, F.lit("\\\\"), F.lit("\\"))


def word_tokens(text: Column) -> Column:
    """Estimate of a turn's tokens: its words, plus four for the markers."""
    return F.regexp_count(text, F.lit(r"\S+")) + 4


def format_windows(conversations: DataFrame, budget: int = 1024, history_turns: int = 2, history_tokens: int = 256, tokens=word_tokens) -> DataFrame:
    """``conv_id, window_no, n_repeated, text, loss_spans`` (start and length in code points).

    A window's own turns fill ``budget`` tokens at most, unless one turn alone
    is larger: such a turn gets a window of its own and is never cut.  Repeated
    turns come on top: the system turn (a conversation's first turn, if its
    role is system) and the last ``history_turns`` turns while they hold
    ``history_tokens`` at most.  Null roles and texts count as empty; null
    turns come first; turns with equal numbers are ordered by role and text;
    repeated rows are turns of their own; null ids form one conversation.
    """
    conv = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "body")
    turns = (conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                  text_or_empty("role").alias("role"), text_or_empty("text").alias("body"))
             .withColumn("cost", tokens(F.col("body")).cast("long"))
             .withColumn("end", F.sum("cost").over(conv.rowsBetween(W.unboundedPreceding, 0)))
             .withColumn("place", F.row_number().over(conv))
             .withColumn("start", F.col("end") - F.col("cost")))
    slot = F.floor(F.col("start") / F.lit(budget))
    crosses = F.floor((F.col("end") - 1) / F.lit(budget)) > slot
    turns = turns.withColumn("window_no", (2 * slot + crosses.cast("long")).cast("long"))
    first = F.struct("role", "body", "place")
    turns = (turns.withColumn("opens", ~F.col("window_no").eqNullSafe(F.lag("window_no").over(conv)))
             .withColumn("system", F.first(first).over(conv.rowsBetween(W.unboundedPreceding, 0))))
    own = F.struct(F.col("window_no").alias("w"), F.col("place").alias("o"), F.lit(False).alias("repeated"), F.col("role").alias("role"), F.col("body").alias("body"))
    copies = [own]
    is_system = (F.col("place") == 1) & (F.col("role") == "system")
    for k in range(1, history_turns + 1):
        fits = F.lead("opens", k).over(conv) & (F.lead("start", k).over(conv) - F.col("start") <= history_tokens) & ~is_system
        copies.append(F.when(fits, F.struct(F.lead("window_no", k).over(conv).alias("w"), F.col("place").alias("o"), F.lit(True).alias("repeated"),
                                            F.col("role").alias("role"), F.col("body").alias("body"))))
    again = F.col("opens") & (F.col("place") > 1) & (F.col("system.role") == "system")
    copies.append(F.when(again, F.struct(F.col("window_no").alias("w"), F.lit(0).alias("o"), F.lit(True).alias("repeated"),
                                         F.col("system.role").alias("role"), F.col("system.body").alias("body"))))
    placed = turns.withColumn("copies", F.array_compact(F.array(*copies))).select("conv_id", F.explode("copies").alias("t"))
    windows = placed.groupBy("conv_id", F.col("t.w").alias("window_no")).agg(F.sort_array(F.collect_list(F.struct(
        "t.o", "t.repeated", escape_role(F.col("t.role")).alias("role"), escape(F.col("t.body")).alias("body")))).alias("turns"))
    # an own turn and a repeated one never share a place, so the order is total
    shown = F.concat_ws("", F.transform("turns", lambda t: F.concat(F.lit(OPEN), t["role"], F.lit("\n"), t["body"], F.lit(CLOSE))))
    nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(done, t):
        head = done["at"] + F.lit(len(OPEN) + 1) + F.char_length(t["role"])
        size = F.char_length(t["body"])
        span = F.array(F.struct(head.alias("start"), size.alias("length")))
        target = ~t["repeated"] & (t["role"] == "assistant")
        return F.struct((head + size + F.lit(len(CLOSE))).alias("at"), F.when(target, F.concat(done["spans"], span)).otherwise(done["spans"]).alias("spans"))
    return windows.select("conv_id", "window_no", F.size(F.filter("turns", lambda t: t["repeated"])).alias("n_repeated"), shown.alias("text"),
                          F.aggregate("turns", nothing, step)["spans"].alias("loss_spans"))


def parse_windows(windows: DataFrame) -> DataFrame:
    """``conv_id, window_no, turns, loss_text, n_chars``: a window's own turns and masked text, read from its formatted text."""
    parts = F.split("text", r"<\|im_end\|>\n", -1)
    own = F.slice(parts, F.col("n_repeated") + 1, F.greatest(F.size(parts) - 1 - F.col("n_repeated"), F.lit(0)))

    def turn(part):
        line = F.substring_index(part, "\n", 1)
        return F.struct(unescape_role(F.replace(line, F.lit(OPEN), F.lit(""))).alias("role"),
                        unescape(F.substr(part, F.char_length(line) + 2)).alias("text"))
    masked = F.transform("loss_spans", lambda s: unescape(F.substr(F.col("text"), s["start"] + 1, s["length"])))
    return windows.select("conv_id", "window_no", F.transform(own, turn).alias("turns"), F.concat_ws("", masked).alias("loss_text"),
                          F.char_length("text").cast("long").alias("n_chars"))


def conversation_digests(windows: DataFrame) -> DataFrame:
    """Per conversation the digests of its turns and masked text, in window order.

    A digest covers a whole conversation, so one task sees its text once.
    """
    parsed = parse_windows(windows).select(
        "conv_id", "n_chars", F.size("turns").alias("n"), F.struct(
            "window_no", F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))).alias("said"),
            F.col("loss_text").alias("loss")).alias("w"))
    whole = parsed.groupBy("conv_id").agg(F.sum("n").cast("long").alias("n_turns"), F.sort_array(F.collect_list("w")).alias("ws"),
                                          F.sum("n_chars").alias("formatted_chars"))
    loss = F.concat_ws("", F.col("ws.loss"))
    return whole.select("conv_id", "n_turns", F.sha2(F.concat_ws("", F.col("ws.said")), 256).alias("turns_sha256"),
                        F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")
