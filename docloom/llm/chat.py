"""Chat formatting in budgeted windows, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import in_order, with_totals_before

# The control strings of the template.
START, END = "<|im_start|>", "<|im_end|>\n"
#: Tokens that the control strings of a turn count as.
_TURN_TOKENS = 4


def escaped(text: Column) -> Column:
    """``<|`` gets a backslash between its characters, and so does any ``<\\|``: no control string is left."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escaped_role(role: Column) -> Column:
    """A role is one line: line breaks are written as %0A, and % as %25."""
    return escaped(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescaped_role(role: Column) -> Column:
    return F.replace(F.replace(unescaped(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def turn_tokens(text: Column) -> Column:
    """Words and single other characters, and the control strings."""
    return (F.regexp_count(text, F.lit(r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]")) + _TURN_TOKENS).cast("long")


def windows(
    turns: DataFrame,
    budget: int = 512,
    history: int = 128,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    target_role: str = "assistant",
) -> DataFrame:
    """
    ``conv_id, starts_at, formatted, loss, n_turns, n_repeated, tokens, over_budget``: conversations cut into windows.

    A window is a leading system turn, the last turns of the window before (at most ``history`` tokens, and no more than
    fit), and new turns. Spans of new turns follow from prefix sums of turn tokens: with a stride of half of what the
    system turn leaves, turns that start in the same stretch of one stride are a span, and a turn longer than a stride
    is a span alone. So a window stays within ``budget`` unless its system turn and a single turn do not fit
    (``over_budget``); turns are never cut. ``starts_at`` is the tokens of the conversation before the first new turn.

    ``formatted`` is whole turns in the template; control strings inside texts and roles are escaped reversibly. ``loss``
    lists start and length, in code points of ``formatted``, of the texts of new turns of ``target_role``; the first
    ``n_repeated`` turns (system and history, but in the first window the system turn is new) are never targets.

    Null roles and texts are empty, rows without a conversation are one conversation, a null turn number comes first,
    and rows that agree in turn number follow by role and text. Repeated rows are turns. A conversation of a system turn
    only is one window. An empty table gives none. Other columns are not read.

    A conversation may hold any share of all rows: its turns are spread over partitions in order, and only the turns of
    one window meet in one place.
    """
    rows = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).select("*", turn_tokens(F.col("text")).alias("tokens"), F.xxhash64("text").alias("text_hash"))
    placed = in_order(rows, ["conv_id", "turn", "role", "text_hash"], "chat").drop("turn", "text_hash")

    firsts = placed.groupBy("conv_id").agg(F.min("at").alias("at"), F.count("*").alias("n")).where("n > 1")
    heads = placed.where("role = 'system'").join(firsts.select("at"), "at", "left_semi")
    system = heads.select(
        F.col("conv_id").alias("of_conv"),
        F.col("at").alias("head_at"),
        F.col("tokens").alias("head_tokens"),
        F.col("text").alias("head_text"),
    )
    with_head = placed.join(system.drop("head_text"), F.col("conv_id").eqNullSafe(F.col("of_conv")), "left")
    body = with_head.where("head_at IS NULL OR at <> head_at").drop("of_conv", "head_at")
    head_tokens = F.coalesce("head_tokens", F.lit(0))
    body = body.withColumn("stride", F.greatest(F.floor((budget - head_tokens) / 2), F.lit(1)))
    long_turn = (F.col("tokens") > F.col("stride")).cast("long")
    summed = with_totals_before(body, {"before": F.col("tokens"), "long_before": long_turn}, "conv_id")
    span = {
        "stretch": F.floor(F.col("before") / F.col("stride")),
        "part": 2 * F.col("long_before") + long_turn,
    }
    of_span = Window.partitionBy("conv_id", *span)
    turns_in = summed.withColumns(span).withColumns(
        {"starts_at": F.min("before").over(of_span), "new_tokens": F.sum("tokens").over(of_span)}
    )
    new = turns_in.select("conv_id", "starts_at", "at", "role", "text", "tokens", "new_tokens", "head_tokens", F.lit(False).alias("again"))

    # The span before ends where the next one starts, so prefix sums also tell which turns a window repeats.
    left = F.least(F.lit(history), budget - F.coalesce("head_tokens", F.lit(0)) - F.col("new_tokens"))
    spans = new.groupBy(F.col("conv_id").alias("of_conv"), F.col("starts_at").alias("next_at")).agg(
        F.first("new_tokens").alias("new_tokens"), F.first("head_tokens").alias("head_tokens")
    )
    spans = spans.select("of_conv", "next_at", left.alias("left"))
    ends = turns_in.select(
        "conv_id", "at", "role", "text", "tokens", "before", (F.col("starts_at") + F.col("new_tokens")).alias("end")
    )
    follows = F.col("conv_id").eqNullSafe(F.col("of_conv")) & (F.col("end") == F.col("next_at"))
    again = ends.join(spans, follows).where(F.col("end") - F.col("before") <= F.col("left"))
    again = again.select("conv_id", F.col("next_at").alias("starts_at"), "at", "role", "text", "tokens", F.lit(True).alias("again"))
    held = new.select(*again.columns).unionByName(again)
    starts = new.select("conv_id", "starts_at").distinct()
    repeated_head = starts.join(system, F.col("conv_id").eqNullSafe(F.col("of_conv"))).select(
        "conv_id",
        "starts_at",
        F.lit(-1).cast("long").alias("at"),
        F.lit("system").alias("role"),
        F.col("head_text").alias("text"),
        F.col("head_tokens").alias("tokens"),
        (F.col("starts_at") > 0).alias("again"),
    )
    pieces = held.unionByName(repeated_head)

    lead = F.concat(F.lit(START), escaped_role(F.col("role")), F.lit("\n"))
    pieces = pieces.select("conv_id", "starts_at", "at", "tokens", "again", "role", lead.alias("lead"), escaped(F.col("text")).alias("body"))
    pieces = pieces.withColumn("piece", F.concat("lead", "body", F.lit(END)))
    so_far = Window.partitionBy("conv_id", "starts_at").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum(F.length("piece")).over(so_far), F.lit(0)) + F.length("lead")
    target = (F.col("role") == target_role) & ~F.col("again")
    pieces = pieces.withColumn("loss", F.when(target, F.struct(begin.alias("start"), F.length("body").cast("long").alias("length"))))
    made = pieces.groupBy("conv_id", "starts_at").agg(
        F.array_sort(F.collect_list(F.struct("at", "piece"))).alias("pieces"),
        F.array_sort(F.collect_list("loss")).alias("loss"),
        F.count("*").alias("n_turns"),
        F.count_if("again").alias("n_repeated"),
        F.sum("tokens").alias("tokens"),
    )
    return made.select(
        "conv_id",
        "starts_at",
        F.array_join("pieces.piece", "").alias("formatted"),
        "loss",
        "n_turns",
        "n_repeated",
        "tokens",
        (F.col("tokens") > budget).alias("over_budget"),
    )


def read_back(made: DataFrame) -> DataFrame:
    """``conv_id, starts_at, turns, loss_text``: the new turns of each window (role and text) and the text under the mask."""
    parts = F.slice(F.split("formatted", F.lit(r"\Q" + END + r"\E")), F.col("n_repeated").cast("int") + 1, (F.col("n_turns") - F.col("n_repeated")).cast("int"))
    head = len(START)
    read = lambda part: F.struct(
        unescaped_role(F.substring_index(F.substring(part, head + 1, 1 << 30), "\n", 1)).alias("role"),
        unescaped(F.substring(part, F.locate("\n", part) + 1, F.lit(1 << 30))).alias("text"),
    )
    masked = F.transform("loss", lambda x: unescaped(F.substring("formatted", x["start"].cast("int") + 1, x["length"].cast("int"))))
    return made.select("conv_id", "starts_at", F.transform(parts, read).alias("turns"), F.array_join(masked, "").alias("loss_text"))
