"""Chat formatting in budgeted windows, with DataFrame functions only.

A conversation's turns are cut into windows of at most about ``budget`` tokens. Prefix sums of turn
tokens choose the spans: with the stride N = (budget - history - tokens of the system turn) / 2, the new
turns of window k are those whose tokens before them, system turn aside, lie in [k N, (k + 1) N). A window
holds the system turn (the first turn, if its role is ``system``), up to ``history`` tokens of the turns
just before its span, and the span. It exceeds the budget only where one turn is longer than N or the
system turn leaves no room. Loss falls on the new turns of the target role alone: repeated turns are
masked, so every target counts once over all windows.

Template: ``<turn ROLE>`` line break, text, ``</turn>`` line break; the role is URL-encoded. Control
strings inside texts, ``<turn`` with a space and ``</turn>``, get one more backslash (``</turn>`` becomes
``<\\/turn>``, that becomes ``<\\\\/turn>``), which is undone by taking one away; other text stays as it is.

Prefix sums go by blocks of ``BLOCK`` turn numbers: inside a block over its turns, then over the block
totals, so no task needs all turns of a long conversation. Turns are ordered by number (null first), role
and text; equal rows are repeated turns and all stay. Null texts and roles are empty. A null conv_id is a
conversation of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions._columns import quoted
from .shared import same, stored, whole_text

BLOCK = 256
TOKEN = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"
MARK_TOKENS = 8  # what the marks around a turn count for


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)(turn |/turn>)", r"<\\$1$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)(turn |/turn>)", r"<$1$2")


def header(role: Column) -> Column:
    return F.concat(F.lit("<turn "), F.url_encode(role), F.lit(">\n"))


def format_windows(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    budget: int = 2048,
    history: int = 512,
    target: str = "assistant",
) -> DataFrame:
    """One row per window: conv, window, n_repeated (turns at its head that an earlier window holds as new,
    or the system turn again), n_turns, text, loss (spans (start, end) in code points of ``text``)."""
    rows = turns.select(
        quoted(conv_col).alias("conv"),
        quoted(turn_col).alias("turn"),
        whole_text(role_col).alias("role"),
        whole_text(text_col).alias("text"),
    )
    rows = rows.withColumns(
        {
            "block": F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 62))),
            "tokens": (F.regexp_count("text", F.lit(TOKEN)) + MARK_TOKENS).cast("bigint"),
        }
    )
    inside = Window.partitionBy("conv", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = stored(
        rows.withColumns(
            {"place": F.row_number().over(inside), "sum_before": F.coalesce(F.sum("tokens").over(before), F.lit(0))}
        ),
        "turns",
    )
    blocks = rows.groupBy("conv", "block").agg(F.sum("tokens").alias("size"))
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        F.col("conv").alias("c"),
        F.col("block").alias("b"),
        F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("offset"),
    )
    # A block whose offset is 0 is the first one.
    rows = rows.join(blocks, same(F.col("conv"), F.col("c")) & (F.col("block") == F.col("b"))).drop("c", "b")
    is_system = (F.col("offset") == 0) & (F.col("place") == 1) & (F.col("role") == "system")
    rows = rows.withColumns({"is_system": is_system, "start": F.col("offset") + F.col("sum_before")})
    systems = rows.filter("is_system").select(
        F.col("conv").alias("c"), F.col("tokens").alias("system_tokens"), F.col("text").alias("system_text")
    )
    rows = rows.join(systems.drop("system_text"), same(F.col("conv"), F.col("c")), "left").drop("c")
    room = (F.lit(budget - history) - F.coalesce("system_tokens", F.lit(0))) / 2
    rows = rows.withColumn("stride", F.greatest(F.floor(room), F.lit(1)))
    rows = rows.withColumn("start", F.col("start") - F.coalesce("system_tokens", F.lit(0)))
    # The system turn belongs to window 0, as new; its own start is below 0 then.
    rows = rows.withColumn("window", F.when(F.col("is_system"), 0).otherwise(F.floor(F.col("start") / F.col("stride"))))
    firsts = rows.filter("NOT is_system").groupBy("conv", "window").agg(F.min("start").alias("first"))
    # A turn of bucket k can only be history of window k + 1, as the history is no longer than the stride.
    firsts = firsts.select(F.col("conv").alias("c"), F.col("window").alias("w"), "first")
    reach = F.least(F.lit(history), F.col("stride"))
    past = rows.filter("NOT is_system").join(
        firsts, same(F.col("conv"), F.col("c")) & (F.col("window") + 1 == F.col("w")) & (F.col("start") >= F.col("first") - reach)
    )
    kept = ["conv", "window", "block", "place", "role", "text"]
    again = past.select("conv", F.col("w").alias("window"), "block", "place", "role", "text", F.lit(1).alias("kind"))
    # Kind: 0 the system turn, 1 history, 2 new.
    new = rows.select(*kept, F.when(F.col("is_system"), 0).otherwise(2).alias("kind"))
    later = firsts.filter("w > 0").join(
        systems.select(F.col("c").alias("s"), "system_text"), same(F.col("c"), F.col("s"))
    )
    system_again = later.select(
        F.col("c").alias("conv"),
        F.col("w").alias("window"),
        F.lit(0).cast("bigint").alias("block"),
        F.lit(0).alias("place"),
        F.lit("system").alias("role"),
        F.col("system_text").alias("text"),
        F.lit(0).alias("kind"),
    )
    parts = new.unionByName(again).unionByName(system_again)
    # A window holds at most about ``budget`` tokens, so its turns are few.
    member = F.struct("kind", "block", "place", header(F.col("role")).alias("head"), escape(F.col("text")).alias("body"), "role")
    windows = parts.groupBy("conv", "window").agg(F.sort_array(F.collect_list(member)).alias("turns"))
    is_new = "(t.kind = 2 OR window = 0)"
    tail = "</turn>\n"
    windows = windows.withColumn("pieces", F.expr(f"transform(turns, t -> concat(t.head, t.body, '{tail.replace(chr(10), chr(92) + 'n')}'))"))
    sums = F.expr("transform(sequence(1, size(pieces)), i -> aggregate(slice(pieces, 1, i - 1), 0, (s, p) -> s + char_length(p)))")
    windows = windows.withColumn("at", sums)
    spans = (
        "filter(transform(turns, (t, i) -> if("
        f"{is_new} AND t.role = '{target}' AND t.body <> '', "
        "struct(at[i] + char_length(t.head) AS start, at[i] + char_length(t.head) + char_length(t.body) AS end), null)), x -> x IS NOT NULL)"
    )
    return windows.select(
        F.col("conv").alias(conv_col),
        "window",
        F.expr(f"size(filter(turns, t -> NOT {is_new}))").alias("n_repeated"),
        F.size("turns").alias("n_turns"),
        F.array_join("pieces", "").alias("text"),
        F.expr(spans).alias("loss"),
    )


def read_turns(windows: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """(conv, window, turns, targets, length): the new turns of each window, as (role, text), and the texts under
    its loss mask, both read back from the formatted text alone, and its length."""
    pieces = F.expr("slice(split(text, '</turn>\\n'), n_repeated + 1, n_turns - n_repeated)")
    rows = windows.withColumn("pieces", pieces)
    head = F.expr("transform(pieces, p -> substring_index(p, '>\\n', 1))")
    rows = rows.withColumn("heads", head)
    turns = F.transform(
        F.arrays_zip("pieces", "heads"),
        lambda t: F.struct(
            F.url_decode(t["heads"].substr(F.lit(7), F.length(t["heads"]))).alias("role"),
            unescape(t["pieces"].substr(F.length(t["heads"]) + 3, F.length(t["pieces"]))).alias("text"),
        ),
    )
    targets = F.transform("loss", lambda s: unescape(F.col("text").substr(s["start"] + 1, s["end"] - s["start"])))
    return rows.select(
        conv_col, "window", turns.alias("turns"), targets.alias("targets"), F.length("text").cast("bigint").alias("length")
    )
