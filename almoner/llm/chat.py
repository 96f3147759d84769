"""Chat formatting with Spark expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almoner.llm.arrays import running_total

# fixed values: the marks of the template
START, END, NEXT, LINE, NONE = "<|im_start|>", "<|im_end|>", "<|im_sep|>", "<|im_nl|>", "<|im_null|>"


def escape(text: Column) -> Column:
    """No ``<|`` is left: every ``<``, backslashes, ``|`` gets one backslash more. :func:`unescape` takes it back."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", "<$1|")


def _role_mark(role: Column) -> Column:
    return F.when(role.isNull(), NONE).otherwise(F.replace(escape(role), F.lit("\n"), F.lit(LINE)))


def _quoted(mark: str) -> str:
    return mark.replace("|", "\\|")


def format_conversations(conversations: DataFrame, trained: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans.

    ``conversations`` has conv_id, turn, role and text; other columns are
    ignored. Turns are in order of (turn, role, text), nulls first; a null
    text is empty, a null role has a mark of its own; a null conv_id is a
    conversation of its own; repeated rows are repeated turns. Neighbouring
    turns of one role share one block, their texts parted by a mark, so the
    turns can be read back. ``loss_spans`` holds (start, end), in code points
    of ``formatted``, of every text of the ``trained`` role. An empty table
    gives no rows. Work grows with a conversation's length; its one row is
    held by one task, as the result is.
    """
    turn = F.struct("turn", F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    turns = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))

    def piece(t: Column, i: Column) -> Column:
        before, after = F.get("turns", i - 1), F.get("turns", i + 1)
        opens = (i == 0) | ~before["role"].eqNullSafe(t["role"])
        closes = (i == F.size("turns") - 1) | ~after["role"].eqNullSafe(t["role"])
        head = F.when(opens, F.concat(F.lit(START), _role_mark(t["role"]), F.lit("\n"))).otherwise(NEXT)
        return F.struct(
            head.alias("head"), escape(t["text"]).alias("body"), F.when(closes, END + "\n").otherwise("").alias("tail"),
            F.coalesce(t["role"] == trained, F.lit(False)).alias("trained"),
        )

    pieces = turns.select("conv_id", F.transform("turns", piece).alias("pieces"))
    sizes = F.transform("pieces", lambda p: (F.length(p["head"]) + F.length(p["body"]) + F.length(p["tail"])).cast("long"))
    placed = pieces.withColumn("ends", running_total(sizes))

    def span(p: Column, end: Column) -> Column:
        stop = end - F.length(p["tail"])
        return F.struct((stop - F.length(p["body"])).alias("start"), stop.alias("end"), p["trained"].alias("trained"))

    spans = F.filter(F.zip_with("pieces", "ends", span), lambda s: s["trained"])
    return placed.select(
        "conv_id", F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], p["tail"])), "").alias("formatted"),
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns, as (role, text), that a formatted conversation was made from; a null role is null again."""
    split = F.split(formatted, _quoted(START))
    blocks = F.slice(split, 2, F.greatest(F.size(split) - 1, F.lit(0)))

    def turns(block: Column) -> Column:
        mark = F.substring_index(block, "\n", 1)
        body = F.substring(block, F.length(mark) + 2, F.length(block) - F.length(mark) - len(END) - 2)
        role = F.when(mark != NONE, unescape(F.replace(mark, F.lit(LINE), F.lit("\n"))))
        return F.transform(F.split(body, _quoted(NEXT)), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, end to end."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
