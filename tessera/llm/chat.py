"""Chat formatting with Spark expressions only (operator 9).

Template, per run of adjacent turns with one role::

    <|turn|>ROLE<|text|>TEXT<|next|>TEXT ...<|end|>\\n

A backslash escapes inside roles and texts: ``\\`` becomes ``\\\\`` and the
``<|`` that starts every control string becomes ``<\\|``, so no control string
can occur inside a text and the escape can be undone in one scan.  Nothing
trusts the input: texts that spell control strings come back unchanged.

One aggregate collects the turns of a conversation as structs; array
functions sort them, merge adjacent turns of a role, and concatenate.  A window
on the same partitioning gives the offsets, so the work is linear in the turns.
The result of a conversation is one text, so its turns meet in one row by
nature; conversations are independent and spread by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, TEXT, NEXT, END = "<|turn|>", "<|text|>", "<|next|>", "<|end|>\n"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text",
                 loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """``conv_id, formatted, loss_spans`` — spans are arrays of (start, length) in
    code points of ``formatted`` that cover the escaped texts of ``loss_roles``.

    Turns sort by turn number (null first), then role, then text; repeated rows
    stay.  A null role or text is empty; null conversation ids form one
    conversation.
    """
    q = lambda c: F.col(f"`{c}`")
    rows = turns.select(
        q(conv_col).alias("conv_id"), q(turn_col).cast("bigint").alias("turn"),
        F.coalesce(q(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(q(text_col).cast("string"), F.lit("")).alias("text"))
    # where each turn's text starts in the formatted text: a running sum in the order
    # of the turns, on the partitioning that the aggregate below uses again
    w = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    opens, closes = ~F.lag("role").over(w).eqNullSafe(F.col("role")), ~F.lead("role").over(w).eqNullSafe(F.col("role"))
    before = F.when(opens, len(TURN) + F.length(escape(F.col("role"))) + len(TEXT)).otherwise(len(NEXT))
    rows = rows.withColumns({"before": before, "length": F.length(escape(F.col("text"))).cast("bigint"),
                             "after": F.when(closes, len(END)).otherwise(0)})
    end = F.sum(F.col("before") + F.col("length") + F.col("after")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("start", (end - F.col("after") - F.col("length")).cast("bigint"))
    one = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(
        F.struct("turn", "role", "text", "start", "length"))).alias("turns"))
    # merge adjacent turns of a role: the first opens a block, the last closes it
    n = F.size("turns")
    pieces = F.transform(F.col("turns"), lambda t, i: F.concat(
        F.when((i == 0) | (F.get("turns", i - 1)["role"] != t["role"]), F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT)))
        .otherwise(F.lit(NEXT)), escape(t["text"]),
        F.when((i == n - 1) | (F.get("turns", i + 1)["role"] != t["role"]), F.lit(END)).otherwise(F.lit(""))))
    spans = F.transform(F.filter("turns", lambda t: t["role"].isin(*loss_roles)), lambda t: F.struct(
        t["start"].alias("start"), t["length"].alias("length")))
    return one.select("conv_id", F.array_join(pieces, "").alias("formatted"), spans.alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id, turns`` (array of role, text) and ``loss_text`` recovered from the
    formatted text and its loss spans alone."""
    blocks = F.filter(F.split("formatted", r"\Q" + TURN + r"\E"), lambda b: b != "")
    turns = F.flatten(F.transform(blocks, lambda b: F.transform(
        F.split(_cut_end(F.substring_index(b, TEXT, -1)), r"\Q" + NEXT + r"\E", -1),
        lambda x: F.struct(unescape(F.substring_index(b, TEXT, 1)).alias("role"), unescape(x).alias("text")))))
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(
        F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
    return formatted.select("conv_id", "formatted", turns.alias("turns"), loss.alias("loss_text"))


def _cut_end(c: Column) -> Column:
    """Drop the end mark of a block (its last characters)."""
    return F.substring(c, F.lit(1), F.length(c) - len(END))
