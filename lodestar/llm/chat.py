"""Chat formatting: every assistant turn becomes a training example of its own.

An example is the conversation up to and with that turn, in the template below; only the reply's text is
under the loss mask, given as a span of code points. Turns after the last assistant turn make one more
row, with nothing under the mask, so that a written conversation can be read back whole.

A turn is ``<s>[INST] role [/INST] text</s>``. A control string inside a role or text gets a backslash
after its first character, before any it has there already; reading back takes one away.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the template.
OPEN, MIDDLE, CLOSE = "<s>[INST] ", " [/INST] ", "</s>"
_CONTROL = ((r"(<)(\\*)(/?s>)", r"(<)\\(\\*)(/?s>)"), (r"(\[)(\\*)(/?INST\])", r"(\[)\\(\\*)(/?INST\])"))


def escaped(text: Column) -> Column:
    for plain, _ in _CONTROL:
        text = F.regexp_replace(text, plain, r"$1\\$2$3")
    return text


def unescaped(text: Column) -> Column:
    for _, marked in _CONTROL:
        text = F.regexp_replace(text, marked, "$1$2$3")
    return text


def format_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), escaped(role), F.lit(MIDDLE), escaped(text), F.lit(CLOSE))


def read_turns(formatted: Column) -> Column:
    """Formatted conversation -> array of (role, text)."""
    parts = F.filter(F.split(formatted, CLOSE), lambda p: p != "")
    body = F.transform(parts, lambda p: F.substr(p, F.lit(len(OPEN) + 1)))
    return F.transform(
        body,
        lambda b: F.struct(
            unescaped(F.substring_index(b, MIDDLE, 1)).alias("role"),
            unescaped(F.substr(b, F.length(F.substring_index(b, MIDDLE, 1)) + len(MIDDLE) + 1)).alias("text"),
        ),
    )


def prefix_target_examples(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", reply_role: str = "assistant") -> DataFrame:
    """``(conv_id, example, text, loss_start, loss_end)``: an example for each assistant turn, and a row with
    ``loss_start = loss_end`` for turns after the last one (or all, where there is none).

    Turns are in order of turn, then role and text (nulls first); a null role or text is an empty one. Repeated
    rows are turns of their own. A row without a conversation id is a conversation of one turn. A conversation
    is the unit of work: its turns meet in one task, and k replies make k examples of growing context. Other
    columns are not looked at. An empty table gives none.
    """
    one = F.struct(F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    src = turns.select(F.col(conv_col).cast("long").alias("conv_id"), one.alias("t"))
    whole = src.where("conv_id is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    whole = whole.union(src.where("conv_id is null").select("conv_id", F.array("t")))
    made = whole.select("conv_id", "turns", F.transform("turns", lambda t: format_turn(t["role"], t["text"])).alias("formatted"))
    at = F.posexplode("turns").alias("k", "t")
    rows = made.select("conv_id", "formatted", F.size("turns").alias("n"), at)
    is_reply = F.col("t.role") == reply_role
    rows = rows.where(is_reply | (F.col("k") == F.col("n") - 1))
    text = F.array_join(F.slice("formatted", F.lit(1), F.col("k") + 1), "")
    rows = rows.select("conv_id", F.col("k").alias("example"), text.alias("text"), F.when(is_reply, F.length(escaped(F.col("t.text")))).otherwise(0).alias("size"))
    end = F.length("text") - len(CLOSE)
    return rows.select("conv_id", "example", "text", (end - F.col("size")).alias("loss_start"), end.alias("loss_end"))


def conversation_digests(examples: DataFrame) -> DataFrame:
    """What written examples hold, by conversation: its turns (from its longest example), the text under the
    mask of all its examples in order, and the formatted characters."""
    loss = unescaped(F.substr("text", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))
    rows = examples.select("conv_id", "example", "text", F.struct("example", loss.alias("loss")).alias("part"), F.length("text").cast("long").alias("chars"))
    kept = ["conv_id", F.col("text").alias("last"), F.array("part").alias("parts"), "chars"]
    by_id = rows.where("conv_id is not null").groupBy("conv_id").agg(
        F.max_by("text", "example").alias("last"), F.sort_array(F.collect_list("part")).alias("parts"), F.sum("chars").alias("chars")
    )
    whole = by_id.union(rows.where("conv_id is null").select(*kept))
    whole = whole.select("conv_id", "chars", read_turns(F.col("last")).alias("turns"), F.array_join(F.transform("parts", lambda p: p["loss"]), "").alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return whole.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.col("chars").alias("formatted_chars"),
    )
