"""Chat formatting in budgeted windows of whole turns, with a loss mask over each target once.

A window is the conversation's system turn, some turns before its span as history, and the span
itself, and all of it fits the budget. What the system turn leaves of the budget is the room of a
window; three quarters of it is a stretch. Prefix sums of turn tokens lay the stretches over the
conversation: the turns inside one stretch are a span, and a turn that crosses into the next one is
a span of its own. History takes the turns right before the span, a limited number and as many as
the room still holds. So a window passes the budget only if its span is a single turn too large for
the room. Only assistant turns of the span are targets: in later windows, where they are history,
they are masked.

Prefix sums are taken over slices of a conversation first and then inside a slice, and windows are
bounded by the budget, so a conversation of any length is spread over tasks. DataFrame functions
only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseflow.llm.common import settle

BUDGET = 512
HISTORY = 2
KEPT_FOR_HISTORY = 4  # one part in so many of a window's room
OVERHEAD = 4  # tokens of a turn's marks
SLICE = 64

# The marks of a turn, and the strings that are escaped inside texts.
BEGIN, MIDDLE, END = "<s>[INST]", "[/INST]", "</s>"
CONTROL = r"([<\[])(~*)(/?s>|/?INST\])"
ESCAPED = r"([<\[])~(~*)(/?s>|/?INST\])"
WORD = r"[^\x20\x09-\x0D]+"


def escape(text: Column) -> Column:
    """Put a ``~`` into every control string, and one more into those that already have some."""
    return F.regexp_replace(text, CONTROL, "$1~$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def _placed(turns: DataFrame) -> DataFrame:
    """Position of every turn in its conversation and the tokens before it, by slices."""
    slices = turns.groupBy("conv", "slice").agg(
        F.sum("tokens").alias("slice_tokens"), F.count("*").alias("slice_turns")
    )
    before = (
        Window.partitionBy("conv")
        .orderBy(F.col("slice").asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    slices = slices.select(
        F.col("conv").alias("_conv"),
        F.col("slice").alias("_slice"),
        F.coalesce(F.sum("slice_tokens").over(before), F.lit(0)).alias("tokens_before"),
        F.coalesce(F.sum("slice_turns").over(before), F.lit(0)).alias("turns_before"),
    )
    same = F.col("conv").eqNullSafe(F.col("_conv")) & F.col("slice").eqNullSafe(F.col("_slice"))
    inside = Window.partitionBy("conv", "slice").orderBy(
        F.col("turn").asc_nulls_last(), "role", "text"
    )
    upto = inside.rowsBetween(Window.unboundedPreceding, -1)
    return (
        turns.join(slices, same)
        .withColumn("place", F.col("turns_before") + F.row_number().over(inside) - 1)
        .withColumn("start", F.col("tokens_before") + F.coalesce(F.sum("tokens").over(upto), F.lit(0)))
        .select("conv", "place", "start", "tokens", "role", "text")
    )


def format_chats(
    rows: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    budget: int = BUDGET,
    history: int = HISTORY,
) -> DataFrame:
    """One row per window: ``conv_id, window, formatted, n_repeated, loss``.

    ``n_repeated`` turns in front are the system turn and history; ``loss`` lists start and end of
    every target text in code points of ``formatted``. ``window`` numbers grow along a conversation,
    with gaps. No turn is ever cut: a window's tokens (words and marks) pass the budget only if the
    span is one turn that does so with the system turn. A null role or text is empty; turns of
    equal number are in the order of role and text; a null number comes last; a null conversation
    is one of its own; repeated rows are repeated turns. An empty table gives no rows.
    """
    turns = rows.select(
        rows[conv_id].alias("conv"),
        rows[turn].alias("turn"),
        F.coalesce(rows[role].cast("string"), F.lit("")).alias("role"),
        F.coalesce(rows[text].cast("string"), F.lit("")).alias("text"),
    ).withColumns(
        {
            "tokens": F.regexp_count("text", F.lit(WORD)).cast("long") + OVERHEAD,
            "slice": F.floor(F.col("turn") / SLICE),
        }
    )
    whole = settle(_placed(turns), "turns")
    system = (F.col("place") == 0) & (F.col("role") == "system")
    leading = whole.filter(system).select(F.col("conv").alias("_conv"), F.col("tokens").alias("_led"))
    room = F.greatest(F.lit(budget) - F.col("led"), F.lit(1))
    stretch = F.greatest(room - F.floor(room / KEPT_FOR_HISTORY), F.lit(1))
    number = F.floor(F.col("at") / F.col("stretch"))
    crosses = F.floor((F.col("at") + F.col("tokens") - 1) / F.col("stretch")) > number
    placed = (
        whole.join(leading, F.col("conv").eqNullSafe(F.col("_conv")), "left")
        .withColumn("led", F.coalesce("_led", F.lit(0)))
        .withColumns({"room": room, "stretch": stretch, "at": F.col("start") - F.col("led")})
        .withColumn(
            "window",
            F.when(system, F.lit(0)).otherwise(number * 2 + crosses.cast("int")).cast("long"),
        )
        .drop("_conv", "_led", "led", "start", "stretch")
    )
    placed = settle(placed, "placed")
    # The system turn lies in the first window; those after it show it again.
    later = (
        placed.filter(~system)
        .groupBy("conv", "window")
        .agg(
            F.min("place").alias("first"),
            F.min("at").alias("from"),
            (F.max("room") - F.sum("tokens")).alias("left"),
        )
        .filter("first > 0 and window > 0")
        .select(
            F.col("conv").alias("_conv"), F.col("window").alias("_window"), "first", "from", "left"
        )
    )
    back = F.sequence(F.greatest(F.col("first") - history, F.lit(0)), F.col("first") - 1)
    earlier = later.withColumn("_place", F.explode(back)) if history else None
    again = F.col("_window").alias("window")
    shown = [
        placed.select("conv", "window", F.lit(2).alias("kind"), "place", "role", "text"),
        placed.filter(system)
        .join(later, F.col("conv").eqNullSafe(F.col("_conv")))
        .select("conv", again, F.lit(0).alias("kind"), "place", "role", "text"),
    ]
    if earlier is not None:
        at = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("place") == F.col("_place"))
        fits = F.col("from") - F.col("at") <= F.col("left")
        shown.append(
            placed.filter(~system)
            .join(earlier, at)
            .filter(fits)
            .select("conv", again, F.lit(1).alias("kind"), "place", "role", "text")
        )
    entries = shown[0]
    for more in shown[1:]:
        entries = entries.unionByName(more)
    # A window is bounded by its budget, or by its system turn and one turn.
    gathered = entries.groupBy("conv", "window").agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    "kind",
                    "place",
                    escape(F.col("role")).alias("role"),
                    escape(F.col("text")).alias("text"),
                    ((F.col("kind") == 2) & (F.col("role") == "assistant")).alias("target"),
                )
            )
        ).alias("turns")
    )

    def marked(t: Column) -> Column:
        return F.concat(F.lit(BEGIN), t["role"], F.lit(MIDDLE), t["text"], F.lit(END))

    spans = F.array().cast("array<struct<start:bigint,end:bigint>>")
    nothing = F.struct(F.lit(0).cast("long").alias("at"), spans.alias("spans"))

    def add(state: Column, t: Column) -> Column:
        start = state["at"] + len(BEGIN) + F.length(t["role"]) + len(MIDDLE)
        end = start + F.length(t["text"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(
            (end + len(END)).alias("at"),
            F.when(t["target"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"),
        )

    return gathered.select(
        F.col("conv").alias("conv_id"),
        "window",
        F.array_join(F.transform("turns", marked), "").alias("formatted"),
        F.size(F.filter("turns", lambda t: t["kind"] < 2)).alias("n_repeated"),
        F.aggregate("turns", nothing, add, lambda s: s["spans"]).alias("loss"),
    )


def read_turns(formatted: Column, n_repeated: Column) -> Column:
    """The turns that are new in a window, as structs of role and text, unescaped."""
    pieces = F.split(formatted, END)
    own = F.slice(pieces, n_repeated + 1, F.size(pieces) - 1 - n_repeated)

    def turn(piece: Column) -> Column:
        rest = F.substring(piece, len(BEGIN) + 1, 1 << 30)
        head = F.substring_index(rest, MIDDLE, 1)
        body = F.substr(rest, F.length(head) + len(MIDDLE) + 1)
        return F.struct(unescape(head).alias("role"), unescape(body).alias("text"))

    return F.transform(own, turn)


def read_loss(formatted: Column, loss: Column) -> Column:
    """The texts under the loss mask, unescaped, in order."""

    def said(span: Column) -> Column:
        size = (span["end"] - span["start"]).cast("int")
        return unescape(F.substr(formatted, (span["start"] + 1).cast("int"), size))

    return F.transform(loss, said)
