r"""Relational chat formatting, in Spark expressions only.

Turns are ordered and numbered per conversation; adjacent turns of one role
make a message (sorted collected structs, joined by array functions), and the
messages make the text:

    <|im_start|>role\ntext<|im_sep|>text<|im_end|>\n

Inside a text, ``<``, any number of backslashes and ``|`` get one backslash
more, so no text can hold a marker, and taking one backslash off again gives
the text back. The loss mask is a list of spans over the assistant texts.

Nulls, empties, ties: null role and text count as empty. Turns are ordered by
(turn, role, text), null turn first; repeated rows are turns of their own. A
null conv_id is a conversation. Roles may hold line ends and percent signs,
which are percent-encoded. An empty table gives no rows; other columns are
ignored. A conversation's text is one value, so it must fit in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def _role_out(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def _role_in(role: Column) -> Column:
    return unescape(F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%")))


def format_chat(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans (message, start in it, length, offset in the whole text), in code points.

    One shuffle by conv_id serves the window and both aggregations.
    """
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
    by_turn = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = by_turn.rowsBetween(W.unboundedPreceding, W.currentRow)
    earlier = by_turn.rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumns({
        "opens": ~F.col("role").eqNullSafe(F.lag("role").over(by_turn)),
        "closes": ~F.col("role").eqNullSafe(F.lead("role").over(by_turn)),
        "at": F.row_number().over(by_turn), "body": escape(F.col("text")), "head": _role_out(F.col("role"))})
    rows = rows.withColumns({
        "before": F.when(F.col("opens"), F.length("head") + len(START) + 1).otherwise(len(SEP)),
        "after": F.when(F.col("closes"), len(END)).otherwise(0)})
    rows = rows.withColumns({
        "message": F.sum(F.col("opens").cast("long")).over(so_far),
        "offset": F.coalesce(F.sum((F.col("before") + F.length("body") + F.col("after")).cast("long")).over(earlier),
                             F.lit(0)) + F.col("before")})
    messages = rows.groupBy("conv_id", "message").agg(
        F.first("head").alias("head"),
        F.sort_array(F.collect_list(F.struct("at", "body", "offset"))).alias("parts"),
        F.first(F.col("role") == LOSS_ROLE).alias("loss"))
    first = F.col("parts")[0]["offset"] - F.length("head") - len(START) - 1
    spans = F.transform("parts", lambda p: F.struct(
        (p["offset"] - first).alias("start"), F.length(p["body"]).cast("long").alias("length"),
        p["offset"].alias("offset")))
    messages = messages.select(
        "conv_id", "message",
        F.concat(F.lit(START), "head", F.lit("\n"), F.array_join(F.transform("parts", lambda p: p["body"]), SEP),
                 F.lit(END)).alias("text"),
        F.when(F.col("loss"), spans).otherwise(F.expr("filter(array(struct(0L as start, 0L as length, 0L as offset)),"
                                                      " x -> false)")).alias("spans"))
    whole = messages.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("message", "text", "spans"))).alias("messages"))
    return whole.select(
        "conv_id", F.array_join(F.transform("messages", lambda m: m["text"]), "").alias("formatted"),
        F.flatten(F.transform("messages", lambda m: F.transform(m["spans"], lambda s: F.struct(
            m["message"].alias("message"), s["start"].alias("start"), s["length"].alias("length"),
            s["offset"].alias("offset"))))).alias("loss_spans"))


def read_chat(formatted: DataFrame) -> DataFrame:
    """conv_id, formatted, turns (role, text), loss_texts: what ``format_chat`` was given, from its output.

    A loss span is cut from its own message, so the work stays in proportion
    to the text however many turns a conversation has.
    """
    parts = F.split("formatted", r"<\|im_end\|>\n")
    rows = formatted.select("conv_id", "formatted", "loss_spans",
                            F.slice(parts, F.lit(1), F.size(parts) - 1).alias("messages"))
    role = lambda m: _role_in(F.substr(F.substring_index(m, "\n", 1), F.lit(len(START) + 1)))
    body = lambda m: F.substr(m, F.locate("\n", m) + 1)
    turns = F.flatten(F.transform("messages", lambda m: F.transform(
        F.split(body(m), r"<\|im_sep\|>"),
        lambda t: F.struct(role(m).alias("role"), unescape(t).alias("text")))))
    loss = F.transform("loss_spans", lambda s: unescape(F.substr(
        F.element_at("messages", s["message"].cast("int")), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return rows.select("conv_id", "formatted", turns.alias("turns"), loss.alias("loss_texts"))
