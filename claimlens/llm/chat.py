"""Chat formatting from event logs, with DataFrame functions only.

A log holds events of conversations: ``message`` and ``delta`` add text to a
message, ``edit`` puts new text in the place of a message, ``regenerate`` starts a
message anew and voids all later messages of that moment. Events are partitioned by
conversation, ordered by sequence and folded into final messages, which are then
rendered. Rendering can be undone: control strings inside texts are escaped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TURN_OPEN, TURN_CLOSE = "<|im_start|>", "<|im_end|>"
# strings that chat templates treat as control; none may stand inside a rendered text
CONTROL = ("<s>", "</s>", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "[INST]", "[/INST]")
ANGLE = r"<(?=/?s>|<?/?SYS>>|</SYS>>|\|)"
SQUARE = r"\[(?=/?INST\])"


def escape(text: Column) -> Column:
    """Replace the first character of each control string; a backslash is doubled."""
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(F.regexp_replace(doubled, ANGLE, r"\\l"), SQUARE, r"\\b")


def unescape(text: Column) -> Column:
    """The inverse of ``escape``."""
    whole = F.split(text, r"\\\\", -1)
    return F.array_join(
        F.transform(whole, lambda x: F.replace(F.replace(x, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("["))), "\\"
    )


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, message, role, text) of a log.

    ``events``: conv_id, seq, message, kind, role, text. Events of equal ``seq`` are
    ordered by message, kind, role, text. Null texts are empty, a null kind is a
    message; the role is the last one that a live event names. An edit restarts its
    message; a regeneration also voids what later messages held before it. A message
    whose events are all void disappears. Sorting and folding use window functions
    inside one conversation.
    """
    e = events.select(
        "conv_id",
        F.col("seq").cast("long").alias("seq"),
        F.col("message").cast("long").alias("message"),
        F.coalesce("kind", F.lit("message")).alias("kind"),
        "role",
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = [F.col(c).asc_nulls_first() for c in ("seq", "message", "kind", "role", "text")]
    e = e.withColumn("at", F.row_number().over(W.partitionBy("conv_id").orderBy(*order)))
    earlier = W.partitionBy("conv_id").orderBy(F.col("message").asc_nulls_first()).rangeBetween(W.unboundedPreceding, -1)
    own = W.partitionBy("conv_id", "message")
    restart = F.when(F.col("kind").isin("edit", "regenerate"), F.col("at"))
    voided = F.max(F.when(F.col("kind") == "regenerate", F.col("at"))).over(earlier)
    live = e.withColumns({"voided": voided, "restart": F.max(restart).over(own)}).where(
        (F.col("at") >= F.coalesce("restart", F.lit(0))) & (F.col("at") > F.coalesce("voided", F.lit(0)))
    )
    parts = F.array_sort(F.collect_list(F.struct("at", "text")))
    return live.groupBy("conv_id", "message").agg(
        F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("text"), F.max_by("role", F.when(F.col("role").isNotNull(), F.col("at"))).alias("role")
    )


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: ``formatted`` and ``loss_spans``, the parts of it that carry loss.

    ``messages``: conv_id, message, role, text; ordered by message, then role and
    text. A null role is empty, a null text is empty. ``loss_spans`` holds 0-based
    starts and lengths of the escaped assistant texts.
    """
    role = F.coalesce("role", F.lit(""))
    safe_role = F.replace(escape(role), F.lit("\n"), F.lit("\\n"))
    m = messages.select(
        "conv_id",
        F.col("message").alias("at"),
        role.alias("role"),
        F.concat(F.lit(TURN_OPEN), safe_role, F.lit("\n")).alias("open"),
        escape(F.coalesce("text", F.lit(""))).alias("body"),
    )
    order = [F.col(c).asc_nulls_first() for c in ("at", "role", "body")]
    piece = F.concat("open", "body", F.lit(TURN_CLOSE + "\n"))
    before = W.partitionBy("conv_id").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy("conv_id").orderBy(*order)
    placed = m.select(
        "conv_id",
        F.row_number().over(whole).alias("n"),
        piece.alias("piece"),
        F.coalesce(F.sum(F.length(piece)).over(before), F.lit(0)).alias("start"),
        F.length("open").alias("skip"),
        F.when(F.col("role") == "assistant", F.length("body")).alias("loss"),
    )
    rows = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("n", "piece", "start", "skip", "loss"))).alias("rows"))
    marked = F.transform(
        F.filter("rows", lambda r: r["loss"].isNotNull()),
        lambda r: F.struct((r["start"] + r["skip"]).cast("int").alias("start"), r["loss"].cast("int").alias("length")),
    )
    return rows.select(
        "conv_id", F.array_join(F.transform("rows", lambda r: r["piece"]), "").alias("formatted"), marked.alias("loss_spans")
    )


def parse(formatted: Column) -> Column:
    """The turns (role, text) of a rendered conversation."""
    start = len(TURN_OPEN) + 1
    pieces = F.filter(F.split(formatted, r"<\|im_end\|>\n", -1), lambda p: F.startswith(p, F.lit(TURN_OPEN)))

    def turn(p: Column) -> Column:
        inner = F.substring(p, start, 2147483647)
        cut = F.instr(inner, "\n")
        # a line break inside a role was written as \n
        role = F.array_join(
            F.transform(
                F.split(F.substring(inner, F.lit(1), cut - 1), r"\\\\", -1),
                lambda x: F.replace(
                    F.replace(F.replace(x, F.lit("\\n"), F.lit("\n")), F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("[")
                ),
            ),
            "\\",
        )
        return F.struct(role.alias("role"), unescape(F.substring(inner, cut + 1, F.length(inner))).alias("text"))

    return F.transform(pieces, turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), "")


def conversation_events(conversations: DataFrame) -> DataFrame:
    """Stored conversations as a log: every row is one whole message, by turn, role and text."""
    order = [F.col(c).asc_nulls_first() for c in ("turn", "role", "text")]
    rows = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    n = F.row_number().over(W.partitionBy("conv_id").orderBy(*order)).cast("long")
    return rows.select("conv_id", n.alias("seq"), n.alias("message"), F.lit("message").alias("kind"), "role", "text")


def format_conversations(events: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans of every conversation of a log."""
    return render(fold_events(events))


def digest(formatted: DataFrame) -> DataFrame:
    """Counts and digests of rendered conversations, read back from the rendered text."""
    # each step works on stored columns, so nothing is parsed twice
    parsed = formatted.select("conv_id", "formatted", parse(F.col("formatted")).alias("turns"), loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return parsed.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
