"""Chat formatting: conversations rebuilt from an event log, rendered with an exact loss mask.

Events of a conversation are (slot, seq, kind, role, text). ``message`` sets the text of a slot,
``edit`` replaces it, ``delta`` adds to it, ``regenerate`` starts the slot anew and takes back
everything later slots had received up to then.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The control strings of the template.
START, END = "<|im_start|>", "<|im_end|>"
STOP = END + "\n"


def fold(events: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv, slot, role, text): the final messages of an event log.

    Null texts are empty, null roles are taken from the slot's other events (the last that
    has one, taken back or not),
    a null kind is a message. Events of one slot with equal seq are ordered by kind, role and text;
    null seqs come first. A slot whose events were all taken back is gone. Rows that are equal in
    all columns count as often as they occur.

    One slot's events are gathered in one row; a conversation's are only windowed over, sorted and
    spilled by Spark.
    """
    log = events.select(
        F.col(conv).alias("conv"), "slot", "seq",
        F.coalesce("kind", F.lit("message")).alias("kind"), "role",
        F.coalesce("text", F.lit("")).alias("text"),
    )
    upto = Window.partitionBy("conv").orderBy("slot").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    rewound = F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).over(upto)
    log = log.withColumn("rewound", rewound)
    alive = F.col("rewound").isNull() | (F.col("seq") >= F.col("rewound"))
    slots = log.groupBy("conv", "slot").agg(
        F.max(F.when(alive & (F.col("kind") != "delta"), F.col("seq"))).alias("since"),
        F.max(F.when(F.col("role").isNotNull(), F.struct("seq", "role"))).alias("named"),
        F.array_sort(F.collect_list(F.when(alive, F.struct("seq", "kind", "role", "text")))).alias("all"),
    ).where(F.size("all") > 0)
    # What counts is the last event that set the text and the deltas after it.
    sets = F.filter("all", lambda e: (e["kind"] != "delta") & e["seq"].eqNullSafe(F.col("since")))
    base = F.coalesce(F.element_at(F.transform(sets, lambda e: e["text"]), -1), F.lit(""))
    added = F.filter(
        "all", lambda e: (e["kind"] == "delta") & (F.col("since").isNull() | (e["seq"] >= F.col("since")))
    )
    text = F.concat(F.when(F.size(sets) > 0, base).otherwise(""), F.array_join(F.transform(added, lambda e: e["text"]), ""))
    return slots.select("conv", "slot", F.coalesce("named.role", F.lit("")).alias("role"), text.alias("text"))


def escape(text: Column) -> Column:
    """Text in which no control string can begin. Undone by :func:`unescape`."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def render(messages: DataFrame, learn: str = "assistant") -> DataFrame:
    """(conv, formatted, loss): one row per conversation.

    Each message becomes ``<|im_start|>role\\ntext<|im_end|>\\n``, in slot order. loss lists, for every
    message of the role ``learn``, where its text lies: (turn, offset in that turn's rendering, start in
    the whole output, length), in code points. Rendering is reversible: :func:`read_back`.
    """
    m = messages.select(
        "conv", "slot", "role",
        F.concat(F.lit(START), F.replace(escape(F.col("role")), F.lit("\n"), F.lit("\\\n")), F.lit("\n")).alias("head"),
        escape(F.col("text")).alias("body"),
    )
    m = m.withColumn("size", (F.length("head") + F.length("body") + len(STOP)).cast("long"))
    order = Window.partitionBy("conv").orderBy("slot")
    before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    m = m.withColumns({"turn": F.row_number().over(order), "begins": before})
    span = F.struct(
        "turn", F.length("head").alias("offset"), (F.col("begins") + F.length("head")).alias("start"),
        F.length("body").alias("length"),
    )
    return m.groupBy("conv").agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("turn", F.concat("head", "body", F.lit(STOP)).alias("piece")))),
                lambda t: t["piece"],
            ),
            "",
        ).alias("formatted"),
        F.array_sort(F.collect_list(F.when(F.col("role") == learn, span))).alias("loss"),
    )


def read_back(rendered: DataFrame) -> DataFrame:
    """(conv, turns, learned, formatted): turns as (role, text) and the texts under the loss mask, both
    parsed from the rendered output alone."""
    pieces = F.split("formatted", r"<\|im_end\|>\n", -1)
    parsed = rendered.select("conv", "formatted", "loss", F.slice(pieces, F.lit(1), F.size(pieces) - 1).alias("pieces"))
    head = r"(?s)^<\|im_start\|>([^\\\n]*(?:\\.[^\\\n]*)*)\n.*$"

    def turn(piece: Column) -> Column:
        raw = F.regexp_extract(piece, head, 1)
        return F.struct(
            unescape(raw).alias("role"),
            unescape(F.substring(piece, F.length(raw) + len(START) + 2, F.length(piece))).alias("text"),
        )

    def under(span: Column) -> Column:
        piece = F.element_at("pieces", span["turn"])
        return unescape(F.substring(piece, span["offset"] + 1, span["length"]))

    return parsed.select(
        "conv", "formatted", F.transform("pieces", turn).alias("turns"), F.transform("loss", under).alias("learned")
    )


def conversation_events(rows: DataFrame) -> DataFrame:
    """Plain rows (conv_id, turn, role, text) as an event log of whole messages. Every row is a message
    of its own, also rows of one turn; these are ordered by role and text."""
    order = Window.partitionBy("conv_id").orderBy(
        F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first()
    )
    at = F.row_number().over(order).cast("long")
    return rows.select(
        "conv_id", at.alias("slot"), at.alias("seq"), F.lit("message").alias("kind"), "role", "text"
    )
