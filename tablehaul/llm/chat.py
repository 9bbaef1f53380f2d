"""Chat formatting from an event log, in DataFrame operations only.

The log has one row per event: ``conv_id``, ``slot`` (the place of a message in its
conversation), ``seq`` (order of events), ``op``, ``role`` and ``text``. Operations:

* ``message``: a message begins in the slot, with a text that may be empty;
* ``delta``: streamed text is added to the slot's latest message;
* ``edit``: the text replaces all of the message so far;
* ``regenerate``: the message so far is discarded and written anew, beginning with the text.

Events are folded by slot first, so a conversation with very many events is folded in many
tasks; only its finished messages meet in one row, as a formatted conversation must. Each step is
linear in events and text (sorting apart), however many share a slot or a conversation.

The template is ``<|im_start|>role LF text<|im_end|> LF`` for each message. Inside roles and
texts one backslash goes between ``<`` and ``|`` (before those that stand there already), so
control strings cannot occur in them and the escape can be undone; roles have backslashes and
line ends escaped first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablehaul.llm.common import text_of

# The marks of the template.
START = "<|im_start|>"
END = "<|im_end|>"
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """Every backslash is followed by ``b`` or ``n`` then, so both replacements can be undone."""
    plain = F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n"))
    return escape(plain)


def unescape_role(role: Column) -> Column:
    lines = F.replace(unescape(role), F.lit("\\n"), F.lit("\n"))
    return F.replace(lines, F.lit("\\b"), F.lit("\\"))


def as_events(conversations: DataFrame) -> DataFrame:
    """The log of a table of finished turns (``conv_id, turn, role, text``): a ``message`` each.

    NULL roles and texts are empty.
    """
    return conversations.select(
        "conv_id", F.col("turn").alias("slot"), F.col("turn").alias("seq"),
        F.lit("message").alias("op"), text_of("role").alias("role"), text_of("text").alias("text"),
    )


def as_streamed_events(conversations: DataFrame) -> DataFrame:
    """A log as a chat service leaves it, which folds back to the same turns.

    Each turn begins empty, is streamed, edited to its first half, regenerated with its first
    third, and streamed to its end. Turns that share a place come one after the other, in order
    of role and text.
    """
    turns = conversations.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"))
    earlier = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    turns = turns.withColumn("at", F.row_number().over(earlier).cast("long") * 8)
    n, text = F.length("text"), F.col("text")
    third = F.floor(n / 3).cast("int")
    steps = [
        ("message", F.lit("")), ("delta", text), ("edit", F.left(text, F.floor(n / 2).cast("int"))),
        ("regenerate", F.left(text, third)), ("delta", F.substr(text, third + 1, third)),
        ("delta", F.substr(text, 2 * third + 1)),
    ]
    log = F.array(*[
        F.struct(F.lit(i).alias("step"), F.lit(op).alias("op"), part.alias("text"))
        for i, (op, part) in enumerate(steps)
    ])
    return turns.select("conv_id", F.col("turn").alias("slot"), "at", "role", F.explode(log).alias("e")).select(
        "conv_id", "slot", (F.col("at") + F.col("e.step")).alias("seq"), "e.op", "role", "e.text"
    )


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages: ``conv_id, slot, number, role, text``, one row each.

    Events of a slot are ordered by ``seq``; ties go by operation (message, delta, edit,
    regenerate), role and text. Events before the first ``message`` of a slot make one too, and
    two messages of one slot stay two, in order of ``number``. NULL texts are empty, NULL sequence
    numbers come first. Messages are numbered by a running count before any are put together, so
    the time is linear in the events, also when they share a slot.
    """
    rank = F.array_position(F.array(*map(F.lit, ("message", "delta", "edit", "regenerate"))), F.col("op"))
    known = events.select(
        "conv_id", "slot", "seq", "op", rank.alias("rank"), text_of("role").alias("role"),
        text_of("text").alias("text"),
    )
    order = Window.partitionBy("conv_id", "slot").orderBy(
        F.col("seq").asc_nulls_first(), F.col("rank").asc_nulls_first(), "role", "text"
    )
    begins = F.count_if(F.col("op") == "message").over(order.rowsBetween(Window.unboundedPreceding, 0))
    numbered = known.withColumns({"number": begins, "at": F.row_number().over(order)})
    # The last edit or regeneration of a message discards what was before it.
    own = Window.partitionBy("conv_id", "slot", "number").orderBy("at")
    reset = F.when(F.col("op").isin("edit", "regenerate"), F.col("at"))
    last = F.max(reset).over(own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    kept = numbered.withColumn("from", F.coalesce(last, F.lit(0)))
    part = F.when(F.col("at") >= F.col("from"), F.struct("at", "text"))
    messages = kept.groupBy("conv_id", "slot", "number").agg(
        F.min_by("role", "at").alias("role"), F.array_sort(F.collect_list(part)).alias("parts")
    )
    return messages.select(
        "conv_id", "slot", "number", "role",
        F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"),
    )


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted`` and its ``loss_mask``.

    The mask holds (start, end) of every text to train on, in code points of ``formatted``.
    Slots are in order, NULL first. Places come from a running sum over the messages.
    """
    escaped = messages.select(
        "conv_id", "slot", "number", escape_role(F.col("role")).alias("role"),
        escape(F.col("text")).alias("text"), (F.col("role") == TRAINED_ROLE).alias("trained"),
    )
    head, tail = len(START) + 1, len(END) + 1
    length = (F.lit(head + tail) + F.length("role") + F.length("text")).cast("long")
    order = Window.partitionBy("conv_id").orderBy(F.col("slot").asc_nulls_first(), "number")
    before = F.coalesce(F.sum(length).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    written = F.concat(F.lit(START), "role", F.lit("\n"), "text", F.lit(END), F.lit("\n"))
    start = F.col("at") + head + F.length("role")
    parts = escaped.withColumn("at", before).select("conv_id", F.struct(
        "at", written.alias("text"), "trained", start.alias("start"), (start + F.length("text")).alias("end"),
    ).alias("part")).groupBy("conv_id").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    return parts.select(
        "conv_id", F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("formatted"),
        F.transform(
            F.filter("parts", lambda p: p["trained"]),
            lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end")),
        ).alias("loss_mask"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id, turns, loss_text, formatted_chars``: messages and trained text, unescaped, from
    the output.

    ``loss_text`` is cut out by the mask: the formatted text is split once, and the pieces and the
    mask's entries are brought into one order by their place, so that every entry is cut from the
    piece that it lies in and the time is linear in the text.
    """
    mark = len(START)
    pieces = F.split("formatted", r"<\|im_start\|>")
    split = formatted.select("conv_id", F.posexplode(pieces).alias("place", "piece"))
    earlier = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    # Each piece but the first, which is empty, stands behind a mark.
    at = F.coalesce(F.sum(F.length("piece").cast("long") + mark).over(earlier), F.lit(0))
    split = split.withColumn("at", at).filter("place > 0").select(
        "conv_id", "at", F.lit(0).alias("kind"), "piece", F.lit(None).cast("long").alias("end")
    )
    mask = formatted.select("conv_id", F.explode("loss_mask").alias("m")).select(
        "conv_id", F.col("m.start").alias("at"), F.lit(1).alias("kind"),
        F.lit(None).cast("string").alias("piece"), F.col("m.end").alias("end"),
    )
    order = Window.partitionBy("conv_id").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    is_piece = F.col("kind") == 0
    both = split.unionByName(mask).withColumns({
        "own": F.last("piece", ignorenulls=True).over(order),
        "begin": F.last(F.when(is_piece, F.col("at")), ignorenulls=True).over(order),
    })
    role = F.substring_index("piece", "\n", 1)
    body = F.substr(
        F.col("piece"), F.length(role) + 2, F.length("piece") - F.length(role) - 2 - len(END)
    )
    turn = F.struct("at", unescape_role(role).alias("role"), unescape(body).alias("text"))
    cut = unescape(F.substr(
        F.col("own"), (F.col("at") - F.col("begin") + 1).cast("int"), (F.col("end") - F.col("at")).cast("int")
    ))
    found = both.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.when(is_piece, turn))).alias("turns"),
        F.array_sort(F.collect_list(F.when(~is_piece, F.struct("at", cut.alias("text"))))).alias("loss"),
        F.max(F.when(is_piece, F.col("at") + F.length("piece"))).alias("formatted_chars"),
    )
    return found.select(
        "conv_id", F.transform("turns", lambda t: F.struct(t["role"], t["text"])).alias("turns"),
        F.array_join(F.transform("loss", lambda p: p["text"]), "").alias("loss_text"), "formatted_chars",
    )


def format_conversations(events: DataFrame) -> DataFrame:
    """Fold a log and render it: ``conv_id, formatted, loss_mask``. NULL ids are one conversation;
    an empty log gives no rows."""
    return render(fold_events(events))
