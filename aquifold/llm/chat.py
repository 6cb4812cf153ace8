"""Conversations as token-budgeted training windows, in DataFrame functions only.

A turn is written ``<s>role`` + line end + ``text</s>``. Inside roles and texts a backslash is
doubled and a control string (``<s>``, ``</s>``, ``[INST]``, ``[/INST]``) gets a backslash
after its first character; a line end in a role gets one before it. So the control strings
occur only where the template puts them, and escaping can be undone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from aquifold.session import stage

#: Turns whose prefix sums are taken in one task; blocks of a conversation are summed separately.
_BLOCK = 64


def escaped(text: Column) -> Column:
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(F.regexp_replace(doubled, r"<(?=/?s>)", r"<\\"), r"\[(?=/?INST\])", r"[\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def token_estimate(text: Column) -> Column:
    """Tokens of a text without a tokenizer: runs of word characters in fours, and other marks one by one."""
    return (F.regexp_count(text, F.lit(r"[\p{L}\p{N}]{1,4}|[^\s\p{L}\p{N}]")) + 2).cast("bigint")


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """Turns with ``position`` (from 0) and ``before`` (tokens of the conversation's earlier turns).

    Prefix sums go over blocks of turns first, then inside each block, so a conversation with
    very many turns is not sorted in one task. Order: turn (null first), then role and text.
    """
    turns = conversations.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("tokens", token_estimate(F.col("text"))).withColumn("block", F.floor(F.col("turn") / _BLOCK))
    blocks = turns.groupBy("conv_id", "block").agg(F.count("*").alias("n"), F.sum("tokens").alias("tokens"))
    earlier = W.partitionBy("conv_id").orderBy(F.col("block").asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1)
    starts = blocks.select(
        "conv_id", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("turns_before"),
        F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("tokens_before"),
    )
    order = W.partitionBy("conv_id", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    inside = turns.withColumn("nth", F.row_number().over(order) - 1).withColumn(
        "sum", F.coalesce(F.sum("tokens").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    )
    joined = inside.alias("t").join(
        starts.alias("s"), F.col("t.conv_id").eqNullSafe(F.col("s.conv_id")) & F.col("t.block").eqNullSafe(F.col("s.block"))
    )
    return joined.select(
        "t.conv_id", "t.turn", "t.role", "t.text", "t.tokens",
        (F.col("turns_before") + F.col("nth")).alias("position"), (F.col("tokens_before") + F.col("sum")).alias("before"),
    )


def format_windows(conversations: DataFrame, budget: int = 2048, history_turns: int = 4) -> DataFrame:
    """One row per training window: conv_id, first_turn, n_turns, n_context, n_tokens, text, turn_spans, loss_spans.

    The budget is divided: a quarter, or as much as the system turn takes if that is more, for repeated
    history and the system turn, the rest for new turns. Prefix sums of the turns' tokens choose the
    spans: turns whose sum so far falls into the same half of that rest share a window, so every
    window stays within its part; a turn that alone exceeds half of it gets a window of its
    own. A window after the first begins with the conversation's system turn (its first turn, if it has
    that role) and with up to ``history_turns`` turns before its own that fit what the system turn
    leaves of the quarter. Both give way to the new turns: a system turn is repeated only if it takes
    at most half of the budget and fits beside them (or if one of them exceeds the budget by itself),
    history only as far as it fits. So a window exceeds the budget only where one new turn does. Each turn is new in exactly one window; the loss
    covers the texts of new assistant turns only, so repeated targets are masked.

    ``text`` is the template's; ``turn_spans`` (start, end) are the new turns and ``loss_spans``
    the learned texts in it, code points, end exclusive. Needs conv_id, turn, role and text;
    null roles and texts are empty, a null conv_id is a conversation of its own, ties in turn
    are ordered by role and text, repeated rows are repeated turns.
    """
    history = budget // 4
    turns = stage(numbered_turns(conversations), "turns")
    system = turns.filter("position = 0 and role = 'system'").filter(F.col("tokens") <= budget // 2)
    system = system.select("conv_id", "position", "role", "text", "tokens")
    sizes = system.select("conv_id", F.col("tokens").alias("system_tokens"))
    marked = turns.alias("t").join(sizes.alias("s"), F.col("t.conv_id").eqNullSafe(F.col("s.conv_id")), "left").select(
        "t.*", F.coalesce("system_tokens", F.lit(0)).alias("system_tokens")
    )
    half = F.greatest(F.lit(1), F.floor((budget - F.greatest(F.lit(history), F.col("system_tokens"))) / 2))
    # Windows are named by their first position: the largest position so far at which one starts.
    marked = marked.withColumn("big", F.col("tokens") > half).withColumn("bin", F.floor(F.col("before") / half))
    place = F.struct("bin", "big", F.when(F.col("big"), F.col("position")).alias("own"))
    windows = marked.groupBy("conv_id", place.alias("place")).agg(
        F.min("position").alias("first_turn"), F.min("before").alias("tokens_before"),
        (budget - F.sum("tokens")).alias("left"), F.first("system_tokens").alias("system_tokens"),
    )
    repeats = F.when((F.col("system_tokens") <= F.col("left")) | (F.col("left") < 0), F.col("system_tokens")).otherwise(0)
    windows = windows.withColumn("system_tokens", repeats).withColumn(
        "room", F.least(history - F.col("system_tokens"), F.col("left") - F.col("system_tokens"))
    )
    # In one bin a big turn can only be the last, because the next turn's sum is in a later bin.
    new = marked.withColumn("place", place).alias("t").join(
        windows.alias("w"), F.col("t.conv_id").eqNullSafe(F.col("w.conv_id")) & F.col("t.place").eqNullSafe(F.col("w.place"))
    ).select("t.conv_id", "first_turn", F.lit(2).alias("rank"), "position", "role", "t.text", "tokens", F.lit(True).alias("fresh"))
    later = windows.filter("first_turn > 0").select("conv_id", "first_turn", "tokens_before", "system_tokens", "room")
    kept = later.filter("system_tokens > 0").alias("w").join(
        system.alias("s"), F.col("w.conv_id").eqNullSafe(F.col("s.conv_id"))
    ).select(
        "w.conv_id", "first_turn", F.lit(0).alias("rank"), "position", "role", "text", "tokens", F.lit(False).alias("fresh")
    )
    wanted = later.filter("room > 0").select(
        "conv_id", "first_turn", "tokens_before", "room",
        F.explode(F.sequence(F.greatest(F.lit(0), F.col("first_turn") - history_turns), F.col("first_turn") - 1)).alias("position"),
    )
    repeated = wanted.alias("w").join(
        marked.alias("t"),
        F.col("w.conv_id").eqNullSafe(F.col("t.conv_id")) & (F.col("w.position") == F.col("t.position"))
        & (F.col("t.before") >= F.col("w.tokens_before") - F.col("w.room"))
        & ~((F.col("t.position") == 0) & (F.col("t.role") == "system")),
    ).select("w.conv_id", "first_turn", F.lit(1).alias("rank"), "t.position", "role", "text", "tokens", F.lit(False).alias("fresh"))
    pieces = new.unionByName(kept).unionByName(repeated)
    written = F.concat(F.lit("<s>"), _escaped_role(F.col("role")), F.lit("\n"), escaped(F.col("text")), F.lit("</s>"))
    head = F.length(_escaped_role(F.col("role"))) + 4
    rows = pieces.select(
        "conv_id", "first_turn", "tokens",
        F.struct(
            "rank", "position", "fresh", (F.col("fresh") & (F.col("role") == "assistant")).alias("learn"), written.alias("written"),
            head.cast("int").alias("head"),
        ).alias("piece"),
    )
    whole = rows.groupBy("conv_id", "first_turn").agg(
        F.array_sort(F.collect_list("piece")).alias("pieces"), F.sum("tokens").alias("n_tokens")
    )
    empty = F.array().cast("array<struct<start:int,end:int>>")
    begin = F.struct(F.lit(0).alias("at"), empty.alias("turns"), empty.alias("loss"))

    def span(start: Column, end: Column) -> Column:
        return F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"))

    def step(state: Column, piece: Column) -> Column:
        end = state["at"] + F.length(piece["written"])
        text = span(state["at"] + piece["head"], end - 4)
        return F.struct(
            end.alias("at"),
            F.when(piece["fresh"], F.array_append(state["turns"], span(state["at"], end))).otherwise(state["turns"]).alias("turns"),
            F.when(piece["learn"], F.array_append(state["loss"], text)).otherwise(state["loss"]).alias("loss"),
        )

    spans = F.aggregate("pieces", begin, step)
    return whole.withColumn("__spans", spans).select(
        "conv_id", "first_turn", F.size(F.col("__spans.turns")).alias("n_turns"),
        (F.size("pieces") - F.size(F.col("__spans.turns"))).alias("n_context"), "n_tokens",
        F.array_join(F.transform("pieces", lambda p: p["written"]), "").alias("text"),
        F.col("__spans.turns").alias("turn_spans"), F.col("__spans.loss").alias("loss_spans"),
    )


def _escaped_role(role: Column) -> Column:
    return F.regexp_replace(escaped(role), "\n", "\\\\\n")


def _cut(text: Column, span: Column) -> Column:
    return F.substring(text, span["start"] + 1, span["end"] - span["start"])


def read_turns(windows: DataFrame) -> DataFrame:
    """(conv_id, position, role, text, learned) of every new turn, parsed from the windows' texts; learned is null off the loss."""
    turns = windows.select("conv_id", "first_turn", "text", "loss_spans", F.posexplode("turn_spans").alias("nth", "span"))
    written = _cut(F.col("text"), F.col("span"))
    body = F.substring(written, F.lit(4), F.length(written) - 7)
    role = F.regexp_extract(body, r"^((?:[^\\\n]++|\\[\s\S])*+)\n", 1)
    inside = F.filter("loss_spans", lambda s: (s["start"] >= F.col("span.start")) & (s["end"] <= F.col("span.end")))
    return turns.select(
        "conv_id", (F.col("first_turn") + F.col("nth")).alias("position"), unescaped(role).alias("role"),
        unescaped(F.substring(body, F.length(role) + 2, F.length(body))).alias("text"),
        F.when(F.size(inside) > 0, unescaped(_cut(F.col("text"), inside[0]))).alias("learned"),
    )


def conversation_digest(windows: DataFrame) -> DataFrame:
    """Per conversation, read back from its windows: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    turn = F.struct("position", "role", "text", "learned")
    back = read_turns(windows).groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    length = windows.groupBy("conv_id").agg(
        F.sum(F.length("text")).cast("bigint").alias("formatted_chars"), F.count("*").alias("n_windows")
    )
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join(F.transform("turns", lambda t: F.coalesce(t["learned"], F.lit(""))), "")
    return back.alias("b").join(length.alias("l"), F.col("b.conv_id").eqNullSafe(F.col("l.conv_id"))).select(
        "b.conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length(learned).cast("bigint").alias("loss_chars"), F.sha2(learned, 256).alias("loss_sha256"), "formatted_chars", "n_windows",
    )
