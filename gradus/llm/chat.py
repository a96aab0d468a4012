"""Chat formatting: conversations rebuilt from an event log, then rendered with a loss mask.

The log of a conversation is folded in the order of its sequence numbers. ``message`` opens
a turn with a role and a first text, ``delta`` appends to a turn what was streamed, ``edit``
and ``regenerate`` replace a turn's text and take back every later turn that stood then.
Everything is a built-in expression: one shuffle by conversation, windows and an ordered
aggregation inside it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

KINDS = ("message", "delta", "edit", "regenerate")


@dataclass(frozen=True)
class Template:
    """A turn is ``open`` + role + newline + text + ``close``.

    Inside roles and texts a backslash is doubled, and ``mark``, with which both control
    strings begin, gets one before its last character, as does a newline in a role; so no
    control string can occur there, and removing one backslash from each pair gives the
    source back.
    """

    open: str = "<|turn|>"
    close: str = "<|end|>\n"
    mark: str = "<|"


def escape(text: Column, template: Template = Template()) -> Column:
    broken = template.mark[:-1] + "\\" + template.mark[-1]
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit(template.mark), F.lit(broken))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def fold_events(log: DataFrame) -> DataFrame:
    """Final turns (conv_id, turn, role, text) of a log (conv_id, seq, turn, kind, role, text).

    An event counts unless a later edit or regeneration replaced its turn or took it back.
    A turn's role is the last one that an event of it gave until its first event that counts,
    so an edit need not repeat it. NULL texts and
    roles count as empty; events with equal numbers in a turn follow in the order of their
    texts; unknown kinds count as deltas. Conversations with a NULL id are one conversation.
    """
    resets = F.col("kind").isin("edit", "regenerate")
    later = Window.partitionBy("conv_id").orderBy(F.desc("seq"), F.desc("text"))
    taken = F.min(F.when(resets, F.col("turn"))).over(later.rowsBetween(Window.unboundedPreceding, -1))
    # A turn's role, as given until each of its events.
    own = Window.partitionBy("conv_id", "turn").orderBy("seq", "text")
    given = F.last("role", ignorenulls=True).over(own.rowsBetween(Window.unboundedPreceding, 0))
    told = log.withColumns({"_taken": taken, "_role": given})
    alive = told.where("_taken IS NULL OR _taken > turn")
    events = F.array_sort(
        F.collect_list(
            F.struct(
                "seq",
                F.coalesce("text", F.lit("")).alias("text"),
                F.col("_role").alias("role"),
            )
        )
    )
    turns = alive.groupBy("conv_id", "turn").agg(events.alias("e"))
    roles = F.filter(F.col("e.role"), lambda r: r.isNotNull())
    return turns.select(
        "conv_id", "turn",
        F.coalesce(F.get(roles, 0), F.lit("")).alias("role"),
        F.array_join(F.col("e.text"), "").alias("text"),
    )


def render(turns: DataFrame, template: Template = Template(), trained: str = "assistant") -> DataFrame:
    """(conv_id, formatted, loss_spans) of final turns (conv_id, turn, role, text).

    ``loss_spans`` are the start and end, in code points of ``formatted``, of the texts of
    the role ``trained``, in order. A turn's place comes from a running sum, not from a scan
    of the text. A conversation is one row, as long as it is: it is the unit of training.
    A NULL role or text counts as empty, and its turn stays; a NULL ``conv_id`` is a
    conversation; turns with equal numbers come in the order of their pieces.
    """
    role = F.replace(escape(F.coalesce("role", F.lit("")), template), F.lit("\n"), F.lit("\\\n"))
    head = F.concat(F.lit(template.open), role, F.lit("\n"))
    body = escape(F.coalesce("text", F.lit("")), template)
    parts = turns.select(
        "conv_id", "turn", F.coalesce(F.col("role") == trained, F.lit(False)).alias("_trained"),
        F.concat(head, body, F.lit(template.close)).alias("_piece"),
        F.char_length(head).cast("long").alias("_head"), F.char_length(body).cast("long").alias("_body"),
    )
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.char_length("_piece")).over(before), F.lit(0)) + F.col("_head")
    placed = parts.withColumn("_start", start)
    ordered = F.array_sort(
        F.collect_list(
            F.struct("turn", "_piece", "_start", (F.col("_start") + F.col("_body")).alias("_end"), "_trained")
        )
    )
    joined = placed.groupBy("conv_id").agg(ordered.alias("t"))
    spans = F.transform(
        F.filter("t", lambda t: t["_trained"]),
        lambda t: F.struct(t["_start"].alias("start"), t["_end"].alias("end")),
    )
    return joined.select(
        "conv_id", F.array_join(F.col("t._piece"), "").alias("formatted"), spans.alias("loss_spans")
    )


def parse(formatted: Column, template: Template = Template()) -> Column:
    """The turns of a formatted conversation, as an array of (role, text)."""

    def quoted(value: str) -> str:
        return "".join("\\" + c if c in "|<>[]()\\.*+?{}^$" else c for c in value)

    # Between control strings anything may stand but the mark.
    pattern = rf"(?s){quoted(template.open)}(.*?){quoted(template.close)}"
    turns = F.regexp_extract_all(formatted, F.lit(pattern), F.lit(1))

    def split(turn: Column) -> Column:
        # The header ends at the first newline that no backslash precedes.
        role = F.regexp_extract(turn, r"(?s)^([^\\\n]*+(?:\\.[^\\\n]*+)*+)\n", 1)
        text = F.substr(turn, F.char_length(role) + 2)
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(turns, split)


def trained_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(
        F.transform(spans, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))),
        "",
    )
