"""Conversations as training text in windows of a token budget; SQL functions only.

A turn is written as ``### role: text</turn>`` and a newline. Inside role and text, backslash,
``<`` and ``#`` (in roles the colon too) are written as a backslash and a letter, so that no
text can hold a marker, and reading back is exact.

A leading system turn is kept in every window. Running sums of the other turns' tokens cut the
conversation into spans: the sums are dealt into blocks of the budget less system turn and
history, and a span holds the turns that lie in one block, or the one turn that crosses into
another. So every turn is the target of one window, and a window only exceeds the budget for
one longer turn or system turn (``over_budget``). Before its span a window repeats whole
preceding turns of at most ``history`` tokens. Loss falls on the assistant texts of the span
alone; repeated ones are masked.

Turns go by turn, role and text, nulls first, repeated rows each; null role and text count as
empty, a null conv_id is a conversation of its own. A turn's tokens are its words and
TURN_TOKENS for its markers unless ``tokens`` says otherwise. No text is cut. Columns other
than the four named are left out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scratch import keep

TURN_TOKENS = 4
END = "</turn>\n"
_ESCAPES = (("\\", "\\e"), ("<", "\\l"), ("#", "\\h"))
_ROLE_ESCAPES = (*_ESCAPES, (":", "\\c"))


def escape(text: Column, role: bool = False) -> Column:
    for plain, written in _ROLE_ESCAPES if role else _ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column, role: bool = False) -> Column:
    for plain, written in reversed(_ROLE_ESCAPES if role else _ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def word_tokens(text: Column) -> Column:
    return F.size(F.array_remove(F.split(text, r"\s+"), "")) + TURN_TOKENS


def windows(
    turns: DataFrame, budget: int = 1024, history: int = 256, tokens: Callable[[Column], Column] = word_tokens
) -> DataFrame:
    """(conv_id, window, n_context, n_targets, n_tokens, over_budget, formatted, loss) from
    (conv_id, turn, role, text).

    The first n_context turns of a window are repeated ones; loss holds (begin, end) in code
    points of ``formatted``.
    """
    if not 0 <= history < budget:
        raise ValueError("history must be less than the budget")
    plain = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    t = plain.withColumn("k", F.row_number().over(order)).withColumn("tokens", tokens(F.col("text")).cast("long"))
    system = (F.col("k") == 1) & (F.col("role") == "system")
    by_k = Window.partitionBy("conv_id").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    t = (
        t.withColumn("system", system)
        .withColumn("upto", F.sum(F.when(system, 0).otherwise(F.col("tokens"))).over(by_k))
        .withColumn("kept", F.first(F.when(system, F.col("tokens")).otherwise(0)).over(by_k))
        .withColumn("stride", F.greatest(F.lit(1), budget - history - F.col("kept")))
        .withColumn("from", F.col("upto") - F.when(system, 0).otherwise(F.col("tokens")))
        .withColumn("b0", F.expr("`from` div stride"))
        .withColumn("b1", F.expr("greatest(`from`, upto - 1) div stride"))
    )
    body = escape(F.col("text"))
    head = F.concat(F.lit("### "), escape(F.col("role"), role=True), F.lit(": "))
    t = keep(
        t.select(
            "conv_id", "k", "system", "tokens", "from", "upto", "stride", "b0", "b1",
            F.concat(head, body, F.lit(END)).alias("piece"),
            F.char_length(head).alias("head"),
            F.char_length(body).alias("body"),
            (F.col("role") == "assistant").alias("assistant"),
        )
    )
    spans = t.groupBy("conv_id", "b0", "b1").agg(F.min("from").alias("begin"), F.min("k").alias("first_k"))
    s = spans.select(F.col("conv_id").alias("c"), F.col("b0").alias("s0"), F.col("b1").alias("s1"), "begin", "first_k")

    part = ("k", "tokens", "piece", "head", "body")
    target = t.select("conv_id", "b0", "b1", *part, F.lit(True).alias("target"), F.col("assistant"))
    # A turn precedes by at most ``history`` tokens only spans of the next few blocks.
    reach = t.where(~F.col("system") & (F.col("from") + history >= F.col("upto")))
    reach = reach.withColumn("block", F.explode(F.sequence(F.expr("upto div stride"), F.expr(f"(`from` + {history}) div stride"))))
    before = reach.join(
        s,
        F.col("conv_id").eqNullSafe(F.col("c"))
        & (F.col("block") == F.col("s0"))
        & (F.col("k") < F.col("first_k"))
        & (F.col("begin") - F.col("from") <= history),
    )
    again = t.where("system").join(s, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("first_k") > 1))
    rows = target
    for repeated in (before, again):
        rows = rows.union(
            repeated.select("conv_id", F.col("s0").alias("b0"), F.col("s1").alias("b1"), *part, F.lit(False), F.lit(False))
        )
    inside = Window.partitionBy("conv_id", "b0", "b1").orderBy("k")
    length = F.char_length("piece")
    rows = rows.withColumn("begin", F.sum(length).over(inside.rowsBetween(Window.unboundedPreceding, 0)) - length + F.col("head"))
    loss = F.when(F.col("assistant"), F.struct(F.col("begin"), (F.col("begin") + F.col("body")).alias("end")))
    made = rows.groupBy("conv_id", "b0", "b1").agg(
        F.sum("tokens").alias("n_tokens"),
        F.count(F.when(~F.col("target"), 1)).cast("int").alias("n_context"),
        F.count(F.when(F.col("target"), 1)).cast("int").alias("n_targets"),
        F.array_sort(F.collect_list(F.struct("k", "piece"))).alias("pieces"),
        F.array_sort(F.collect_list(loss)).alias("loss"),
    )
    return made.select(
        "conv_id",
        F.row_number().over(Window.partitionBy("conv_id").orderBy("b0", "b1")).alias("window"),
        "n_context",
        "n_targets",
        "n_tokens",
        (F.col("n_tokens") > budget).alias("over_budget"),
        F.array_join(F.col("pieces.piece"), "").alias("formatted"),
        "loss",
    )


def read_back(made: DataFrame) -> DataFrame:
    """(conv_id, window, turns, losses): the target turns (role, text) and the texts under the
    loss mask of each window, from nothing but its text, spans and number of repeated turns."""
    written = F.split("formatted", END)
    targets = F.slice(written, F.col("n_context") + 1, F.size(written) - 1 - F.col("n_context"))

    def turn(text: Column) -> Column:
        colon = F.instr(text, ": ")
        return F.struct(
            unescape(F.substring(text, F.lit(5), colon - 5), role=True).alias("role"),
            unescape(F.substring(text, colon + 2, F.char_length(text))).alias("text"),
        )

    def under(span: Column) -> Column:
        return unescape(F.substring(F.col("formatted"), (span["begin"] + 1).cast("int"), (span["end"] - span["begin"]).cast("int")))

    return made.select("conv_id", "window", F.transform(targets, turn).alias("turns"), F.transform("loss", under).alias("losses"), "formatted")


def digests(made: DataFrame) -> DataFrame:
    """Per conversation what its windows say when read back."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = read_back(made).select(
        "conv_id",
        "window",
        F.size("turns").alias("n"),
        said.alias("said"),
        F.array_join("losses", "").alias("lost"),
        F.char_length("formatted").alias("chars"),
    )
    per = read.groupBy("conv_id").agg(
        F.sum("n").cast("long").alias("n_turns"),
        F.sum("chars").cast("long").alias("formatted_chars"),
        F.array_sort(F.collect_list(F.struct("window", "said", "lost"))).alias("parts"),
    )
    lost = F.array_join(F.col("parts.lost"), "")
    return per.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join(F.col("parts.said"), ""), 256).alias("turns_sha256"),
        F.char_length(lost).cast("long").alias("loss_chars"),
        F.sha2(lost, 256).alias("loss_sha256"),
        "formatted_chars",
    )
