"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted, adjacent turns of one role are merged into a block by
array functions, and the blocks are concatenated:

    <s>role[INST]text[SEP]text of the next turn, same role</s><s>role[INST]...</s>

Control strings inside a role or a text get one more backslash after their first character
(``</s>`` -> ``<\\/s>``, ``<\\/s>`` -> ``<\\\\/s>``), so no control string of the template can come
from a text and reading back takes exactly one backslash away.

The loss mask is the list of assistant texts as (start, chars) in the formatted text, code points.

Defined results: a null text or role is an empty one. Turns are ordered by (turn, role, text), null
turns first; repeated rows are repeated turns. Rows with a null conv_id are one conversation. No rows:
no conversations. Very long texts and conversations are formatted whole, in time linear in their length. Columns beside the
four are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.llm.frames import bound, running_sums

OPEN, ROLE_END, NEXT, CLOSE = "<s>", "[INST]", "[SEP]", "</s>"
#: What follows the first character of a control string; chat templates in use elsewhere are covered too.
TAILS = r"/?s>|</?SYS>>|/?INST\]|SEP\]"
ESCAPE = rf"([<\[])(\\*)({TAILS})"
UNESCAPE = rf"([<\[])\\(\\*)({TAILS})"
TRAINED = "assistant"
#: Characters of the parts that a formatted text is cut into to be read under a mask.
PART = 512


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, r"$1$2\\$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE, "$1$2$3")


def _opens(turns: Column) -> Column:
    """Places of the turns that open a block: another role than the turn before."""
    place = lambda t, i: F.when((i == 0) | (F.get(turns, i - 1)["role"] != t["role"]), i)
    return F.filter(F.transform(turns, place), lambda i: i.isNotNull())


def _merged(turns: Column, opens: Column) -> Column:
    """Adjacent turns of one role as one block: name, turns."""
    until = lambda k: F.coalesce(F.get(opens, k + 1), F.size(turns))
    return F.transform(
        opens, lambda i, k: F.struct(F.get(turns, i)["name"].alias("name"), F.slice(turns, i + 1, until(k) - i).alias("turns"))
    )


def _written(block: Column) -> Column:
    texts = F.array_join(F.transform(block["turns"], lambda t: t["body"]), NEXT)
    return F.concat(F.lit(OPEN), block["name"], F.lit(ROLE_END), texts, F.lit(CLOSE))


def _sizes(block: Column) -> Column:
    """Of every turn of a block the characters before its text, of its text, and after it."""
    head = F.length(block["name"]) + len(OPEN) + len(ROLE_END)
    return F.transform(
        block["turns"],
        lambda t, i: F.struct(
            F.when(i == 0, head).otherwise(len(NEXT)).cast("long").alias("front"),
            F.length(t["body"]).cast("long").alias("chars"),
            F.when(i == F.size(block["turns"]) - 1, len(CLOSE)).otherwise(0).cast("long").alias("end"),
            (t["role"] == TRAINED).alias("trained"),
        ),
    )


def _loss(sizes: Column) -> Column:
    """Where the trained texts stand."""
    before = running_sums(F.transform(sizes, lambda s: s["front"] + s["chars"] + s["end"]))
    span = lambda s, b: F.when(s["trained"], F.struct((b + s["front"]).alias("start"), s["chars"].alias("chars")))
    return F.filter(F.zip_with(sizes, before, span), lambda s: s.isNotNull())


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss array<struct<start, chars>>.

    ``turns`` holds conv_id, turn, role, text. One exchange collects the turns; the rest are array expressions, of which every
    turn passes through each once, so the work is linear in the turns.
    """
    said = F.struct(
        "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    rows = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(said)).alias("said"))
    escape = lambda t: F.struct(t["role"].alias("role"), escaped(t["role"]).alias("name"), escaped(t["text"]).alias("body"))

    def made(merged: Column) -> Column:
        loss = bound(F.flatten(F.transform(merged, _sizes)), _loss)
        return F.struct(F.array_join(F.transform(merged, _written), "").alias("formatted"), loss.alias("loss"))

    def blocks(turns: Column) -> Column:
        return bound(bound(_opens(turns), lambda opens: _merged(turns, opens)), made)

    return rows.select("conv_id", bound(F.transform("said", escape), blocks).alias("made")).select("conv_id", "made.*")


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation again: array<struct<role, text>>."""
    blocks = F.filter(F.split(formatted, CLOSE), lambda b: b != "")

    def turns_of(block: Column) -> Column:
        role = F.substring_index(block, ROLE_END, 1)
        body = F.substr(block, F.length(role) + len(ROLE_END) + 1)
        name = unescaped(F.substr(role, F.lit(len(OPEN) + 1)))
        return F.transform(
            F.split(body, r"\[SEP\]"), lambda t: F.struct(name.alias("role"), unescaped(t).alias("text"))
        )

    return F.flatten(F.transform(blocks, turns_of))


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between.

    The formatted text is cut into parts of PART characters once, so a span reads its own parts and not all text
    before it.
    """
    parts = F.regexp_extract_all(formatted, F.lit(f"(?s).{{1,{PART}}}"), F.lit(0))

    def under(held: Column, s: Column) -> Column:
        first, end = F.floor(s["start"] / PART), s["start"] + s["chars"]
        last = F.floor((end - 1) / PART)

        def cut(c: Column) -> Column:
            low = F.greatest(s["start"] - c * PART, F.lit(0))
            return F.substr(F.get(held, c.cast("int")), (low + 1).cast("int"), (F.least(end - c * PART, F.lit(PART)) - low).cast("int"))

        own = F.array_join(F.transform(F.sequence(first, last), cut), "")
        return F.when(s["chars"] > 0, unescaped(own)).otherwise("")

    return bound(parts, lambda held: F.array_join(F.transform(loss, lambda s: under(held, s)), ""))


__all__ = ["escaped", "format_conversations", "loss_text", "read_turns", "unescaped"]
