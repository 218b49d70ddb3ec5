r"""Chat formatting by event-sourced reconstruction, in DataFrame operations only.

An event log has conv_id, seq, kind, message_id, role, text.  Kinds: ``message`` opens a message, ``delta`` adds text
to it, ``edit`` replaces its text, ``regenerate`` starts its text again and drops every message that was opened after
it and before the regeneration.  ``fold`` gives the final messages; ``render`` one formatted text per conversation:

    <|turn|>role<|text|>text<|end|>\n        for each message, in order

Within roles and texts ``\`` becomes ``\\`` and ``<|`` becomes ``<\|``, so no text can hold a mark, and taking the
character after each backslash restores the text.  ``loss_mask`` lists the spans (in code points) of assistant texts.

Events of a message meet first (partial aggregation by conversation and message), so a long log is spread; only the
final messages of a conversation meet in one task, since they become one text.

Defined cases: null role or text is empty; null conv_id is a conversation of its own; null kind is ``message``; null
message_id is the row's seq; equal seq go by kind (openings first), role, text; a delta or edit without an opening
opens its message; repeated rows each count as events; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def turns_as_events(turns: DataFrame) -> DataFrame:
    """A table of finished turns (conv_id, turn, role, text) as a log: one opening event per row, by turn, role, text."""
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = turns.select("conv_id", "turn", "role", "text").withColumn("seq", F.row_number().over(w).cast("long"))
    return rows.select("conv_id", "seq", F.lit("message").alias("kind"), F.col("seq").alias("message_id"), "role", "text")


def fold(events: DataFrame) -> DataFrame:
    """Final messages: conv_id, created, message_id, role, text."""
    e = events.select(
        "conv_id", F.col("seq").cast("long").alias("seq"), F.coalesce("kind", F.lit("message")).alias("kind"),
        F.coalesce(F.col("message_id").cast("long"), F.col("seq").cast("long")).alias("message_id"), "role", F.coalesce("text", F.lit("")).alias("text"),
    )
    level = F.when(F.col("kind") == "delta", 1).otherwise(0)
    sets = F.when(F.col("kind") != "delta", F.struct("seq", level.alias("level")))
    step = F.struct("seq", level.alias("level"), F.coalesce("role", F.lit("")).alias("role"), "text")
    one = e.groupBy("conv_id", "message_id").agg(
        F.coalesce(F.min(F.when(F.col("kind") == "message", F.col("seq"))), F.min("seq")).alias("created"),
        F.coalesce(F.min_by("role", F.when(F.col("role").isNotNull(), F.struct("seq", level, "role"))), F.lit("")).alias("role"),
        F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("again"),
        F.max(sets).alias("last"),
        F.sort_array(F.collect_list(step)).alias("steps"),
    )
    # The last opening, edit or regeneration counts (of several with one seq, the last in order), and the deltas after it.
    live = F.expr("""filter(steps, (s, i) -> last is null or s.seq is null and last.seq is null and (s.level = 1 or i + 1 = size(filter(steps, t -> t.level = 0)))
                     or s.seq > last.seq or s.seq = last.seq and (s.level = 1 or i + 1 = size(steps) or steps[i + 1].seq > s.seq or steps[i + 1].level = 1))""")
    one = one.withColumn("text", F.array_join(F.transform(live, lambda s: s["text"]), ""))
    before = Window.partitionBy("conv_id").orderBy("created", "message_id").rowsBetween(Window.unboundedPreceding, -1)
    kept = one.withColumn("cut", F.max("again").over(before)).where("cut is null or created is null or cut <= created")
    return kept.select("conv_id", "created", "message_id", "role", "text")


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_mask array<struct<turn, turn_start, start, length>>."""
    order = Window.partitionBy("conv_id").orderBy("created", "message_id")
    m = messages.withColumn("head", F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT))).withColumn("body", escape(F.col("text")))
    m = m.withColumn("piece", F.concat("head", "body", F.lit(END)))
    m = m.withColumn("turn_start", F.coalesce(F.sum(F.length("piece")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    m = m.withColumn("turn", F.row_number().over(order) - 1)
    span = F.when(F.col("role") == "assistant", F.struct((F.col("turn_start") + F.length("head")).alias("start"), F.length("body").alias("length")))
    rows = m.select("conv_id", F.struct("turn", "turn_start", "piece", span.alias("span")).alias("m"))
    all_ = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("m")).alias("m"))
    spans = F.transform(F.filter("m", lambda x: x["span"].isNotNull()), lambda x: F.struct(x["turn"].alias("turn"), x["turn_start"].alias("turn_start"), x["span"]["start"].alias("start"), x["span"]["length"].alias("length")))
    return all_.select("conv_id", F.array_join(F.transform("m", lambda x: x["piece"]), "").alias("formatted"), spans.alias("loss_mask"))


def parse(formatted: DataFrame) -> DataFrame:
    """Turns read back from formatted texts: conv_id, turns array<struct<role, text>>, loss_text."""
    body = F.transform(
        F.col("parts"),
        lambda p: F.struct(
            unescape(F.substring_index(p, TEXT, 1)).alias("role"),
            unescape(F.regexp_replace(F.substring(p, F.length(F.substring_index(p, TEXT, 1)) + len(TEXT) + 1, F.length(p)), r"(?s)<\|end\|>\n\z", "")).alias("text"),
        ),
    )
    parts = F.expr(r"filter(split(formatted, '<\\|turn\\|>'), (p, i) -> i > 0)")
    got = formatted.withColumn("parts", parts)
    spoken = F.transform("loss_mask", lambda s: unescape(F.substring(F.get("parts", s["turn"].cast("int")), (s["start"] - s["turn_start"] - len(TURN) + 1).cast("int"), s["length"])))
    return got.select("conv_id", "formatted", body.alias("turns"), F.array_join(spoken, "").alias("loss_text"))


def digest(formatted: DataFrame) -> DataFrame:
    """The contract's columns, all read back from ``formatted`` and its mask."""
    t = parse(formatted)
    flat = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return t.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(flat.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )
