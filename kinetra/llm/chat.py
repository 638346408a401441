"""Chat formatting from event logs, in DataFrame functions only.

A conversation is a log of events: ``message`` opens a slot with a role and a text, ``delta`` appends to
the slot's text, ``edit`` replaces it, ``regenerate`` voids the slot and every later one, to be filled
anew.  Events are sorted by sequence inside their conversation and folded into final messages, which one
template renders.  The text under the loss mask is kept as spans of the rendered string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Fixed control strings of the template.
START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    """Add one ! to each <!*| so that no control string can occur in a text; unescape() takes it off."""
    return F.regexp_replace(text, r"<(!*)\|", r"<$1!|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(!*)!\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """As escape(); a line feed, which ends the role in the template, becomes <n>, and <!*n> gets one more !."""
    return F.replace(F.regexp_replace(escape(role), r"<(!*)n>", r"<$1!n>"), F.lit("\n"), F.lit("<n>"))


def unescape_role(role: Column) -> Column:
    return unescape(F.regexp_replace(F.replace(role, F.lit("<n>"), F.lit("\n")), r"<(!*)!n>", r"<$1n>"))


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, slot, role, text) of events (conv_id, seq, kind, slot, role, text).

    Per conversation, in order of seq: a regenerate voids all earlier events of its slot and of later
    slots; of what is left, a slot's text is its last message or edit, then all deltas after it.  Its role
    is that of its last event that has one.  Slots with a regenerate and nothing after it are gone.
    A null text counts as empty; a null kind as message; null conv_id is a conversation of its own; seq
    and slot sort nulls first.  Events with equal seq are taken in the order slot, kind, role, text.
    Equal events count once for each time they occur, an empty log gives no row, texts of any length are kept whole.
    All windows and the grouping use one exchange by conversation, and each is linear in its events after the sort.
    """
    e = events.select(
        "conv_id", "seq", F.coalesce("kind", F.lit("message")).alias("kind"), "slot", "role",
        F.coalesce("text", F.lit("")).alias("text"),
    )
    log = Window.partitionBy("conv_id").orderBy(*(F.col(c).asc_nulls_first() for c in ("seq", "slot", "kind", "role", "text")))
    later = Window.partitionBy("conv_id").orderBy(F.desc("nth")).rowsBetween(Window.unboundedPreceding, -1)
    slot = Window.partitionBy("conv_id", "slot")
    redone = F.min(F.when(F.col("kind") == "regenerate", F.struct(F.col("slot").isNotNull().alias("has"), F.col("slot").alias("at")))).over(later)
    here = F.struct(F.col("slot").isNotNull().alias("has"), F.col("slot").alias("at"))
    live = (
        e.withColumn("nth", F.row_number().over(log))
        .withColumn("redone", redone)
        .filter((F.col("kind") != "regenerate") & (F.col("redone").isNull() | (F.col("redone") > here)))
        .withColumn("base", F.max(F.when(F.col("kind").isin("message", "edit"), F.col("nth"))).over(slot))
        .filter(F.col("base").isNull() | (F.col("nth") >= F.col("base")) | F.col("role").isNotNull())
    )
    used = F.col("base").isNull() | (F.col("nth") >= F.col("base"))
    return live.groupBy("conv_id", "slot").agg(
        F.max_by("role", F.when(F.col("role").isNotNull(), F.col("nth"))).alias("role"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(used, F.struct("nth", "text")))), lambda x: x["text"]), "").alias("text"),
    )


def render(messages: DataFrame, train_on: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row (conv_id, formatted, loss_spans) per conversation of messages (conv_id, slot, role, text).

    Each message is ``<|im_start|>role\\ntext<|im_end|>\\n`` with control strings in role and text escaped.
    loss_spans has, for each text whose role is in train_on, its turn (from 0), its start (from 0) in ``formatted`` and in
    the turn, and its length, all in code points.  Null role or text: empty.  Messages are sorted by slot, nulls first;
    several of one slot by role and text.  Starts are running sums, so the work is linear in the messages.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    part = messages.select(
        "conv_id", F.col("slot").isNotNull().alias("has"), "slot", role.isin(*train_on).alias("train"),
        F.concat(F.lit(START), escape_role(role), F.lit("\n")).alias("head"), escape(text).alias("body"),
    )
    order = Window.partitionBy("conv_id").orderBy("has", "slot", "train", "head", "body")
    size = F.length("head") + F.length("body") + len(END) + 1
    before = F.coalesce(F.sum(size.cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = part.select("*", (F.row_number().over(order) - 1).alias("turn"), before.alias("at"))
    span = F.struct("turn", (F.col("at") + F.length("head")).alias("start"), F.length("head").alias("inside"), F.length("body").alias("length"))
    one = F.struct("turn", F.concat("head", "body", F.lit(END + "\n")).alias("text"), F.when(F.col("train"), span).alias("span"))
    whole = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("ms"))
    return whole.select(
        "conv_id",
        F.array_join(F.transform("ms", lambda m: m["text"]), "").alias("formatted"),
        F.filter(F.transform("ms", lambda m: m["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
    )


def read_back(rendered: DataFrame) -> DataFrame:
    """Add turns (array of role, text) and loss_text, both read from the rendered string, split once, and its spans."""
    marks = rendered.withColumn("marks", F.split(F.col("formatted"), r"\Q" + END + "\n" + r"\E", -1))
    turn = lambda p: F.struct(
        unescape_role(F.substr(p, F.lit(len(START) + 1), F.instr(p, "\n") - len(START) - 1)).alias("role"),
        unescape(F.substr(p, F.instr(p, "\n") + 1)).alias("text"),
    )
    span = lambda s: unescape(F.substr(F.get(F.col("marks"), s["turn"]), s["inside"] + 1, s["length"]))
    return marks.select(
        *rendered.columns,
        F.transform(F.slice("marks", 1, F.greatest(F.size("marks") - 1, F.lit(0))), turn).alias("turns"),
        F.array_join(F.transform("loss_spans", span), "").alias("loss_text"),
    )


def events_of(conversations: DataFrame, piece: int = 80) -> DataFrame:
    """The log of a chat that leaves these rows (conv_id, turn, role, text) as its final messages.

    Rows are taken in the order turn, role, text, nulls first, and each has a slot of its own; repeated rows and rows
    with equal turns all stay.  A text of the assistant is streamed: an empty message, then deltas of up to piece code
    points; every third slot breaks off after the first delta and is regenerated.  Other texts are messages, every
    second of them a draft that an edit replaces.
    """
    order = Window.partitionBy("conv_id").orderBy(*(F.col(c).asc_nulls_first() for c in ("turn", "role", "text")))
    rows = conversations.select("conv_id", F.row_number().over(order).alias("slot"), "role", F.coalesce("text", F.lit("")).alias("text"))
    event = lambda kind, text, role=F.lit(None).cast("string"): F.struct(F.lit(kind).alias("kind"), role.alias("role"), text.alias("text"))
    own, none = F.col("role"), F.lit(None).cast("string")
    streamed = F.concat(
        F.array(event("message", F.lit(""), own)),
        F.transform(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{piece}}}"), F.lit(0)), lambda t: event("delta", t)),
    )
    broken = F.concat(F.slice(streamed, 1, 2), F.array(event("regenerate", none)), streamed)
    draft = F.array(event("message", F.concat(F.lit("Draft of "), F.col("text")), own), event("edit", F.col("text")))
    log = F.when(F.coalesce(own == "assistant", F.lit(False)), F.when(F.col("slot") % 3 == 0, broken).otherwise(streamed)).otherwise(
        F.when(F.col("slot") % 2 == 0, draft).otherwise(F.array(event("message", F.col("text"), own)))
    )
    each = rows.select("conv_id", "slot", F.posexplode(log).alias("k", "e"))
    seq = F.shiftleft(F.col("slot").cast("long"), 32) + F.col("k")
    return each.select("conv_id", seq.alias("seq"), "e.kind", "slot", "e.role", "e.text")


def format_chats(conversations: DataFrame) -> DataFrame:
    """Rows by turn to one rendered string per conversation: log of events, fold, template."""
    return render(fold_events(events_of(conversations.select("conv_id", "turn", "role", "text"))))
