"""Chat formatting from an event log, with built-in functions only.

A conversation is stored as the events that made it: whole messages, streamed
deltas, edits and regenerations. They are folded into final messages, which are
then rendered with a template that marks turns and can be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds of events. A message starts a message of its turn; a delta adds to the
#: message started last in its turn; an edit replaces its text; a regenerate throws its
#: text away, so that deltas build it anew.
MESSAGE, DELTA, EDIT, REGENERATE = "message", "delta", "edit", "regenerate"

TURN_START, TURN_END = "### ", "</turn>\n"
#: A backslash always begins an escape, so undoing them one after the other is safe
#: as long as the backslash itself comes first here and last there.
_ESCAPES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"))


def escape(text: Column) -> Column:
    for plain, coded in _ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for plain, coded in reversed(_ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def fold_events(events: DataFrame) -> DataFrame:
    """conv_id and messages, an array of (turn, role, text), from events.

    events: conv_id, seq, turn, kind, role, text. The events of a turn are
    folded first, so a conversation that holds much of the log is spread by its
    turns, and its messages meet once they are final. Order within a turn is
    by seq, ties by role, kind and text; turns come in order. Null roles, kinds and
    texts count as '', message and ''. Events before the first message of their turn
    make one of their own. A message that was regenerated and got no text since
    stays, with the text ''. A row given twice counts twice. Other columns are left out.
    """
    clean = events.select(
        "conv_id",
        "turn",
        F.struct(
            F.col("seq"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("kind", F.lit(MESSAGE)).alias("kind"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("event"),
    )
    turns = clean.groupBy("conv_id", "turn").agg(F.sort_array(F.collect_list("event")).alias("events"))
    events_ = F.col("events")

    def message(role: Column, text: Column) -> Column:
        return F.struct(F.col("turn"), role.alias("role"), text.alias("text"))

    # The events of each message; those before the first message are one more.
    first = F.transform(events_, lambda e, i: F.when((e["kind"] == MESSAGE) | (i == 0), i))
    starts = F.filter(first, lambda i: i.isNotNull())
    ends = F.concat(F.slice(starts, F.lit(2), F.size(starts)), F.array(F.size(events_)))
    marked = turns.select(
        "conv_id", "turn", "events",
        (~F.exists(events_, lambda e: e["kind"] != MESSAGE)).alias("simple"),
        F.zip_with(starts, ends, lambda i, j: F.struct(i.alias("from"), (j - i).alias("count"))).alias("spans"),
    )

    def fold(own: Column) -> Column:
        resets = F.transform(own, lambda e, i: F.when(e["kind"] != DELTA, i))
        lasting = F.slice(own, F.coalesce(F.array_max(resets), F.lit(0)) + 1, F.size(own))
        # What a regenerated answer said before is gone; the event itself carries no text of the message.
        parts = F.transform(lasting, lambda e: F.when(e["kind"] == REGENERATE, F.lit("")).otherwise(e["text"]))
        return message(own[0]["role"], F.array_join(parts, ""))

    runs = F.transform("spans", lambda s: F.slice(events_, s["from"] + 1, s["count"]))
    folded = F.transform(runs, fold)
    plain = F.transform(events_, lambda e: message(e["role"], e["text"]))
    messages = marked.select("conv_id", "turn", F.when(F.col("simple"), plain).otherwise(folded).alias("messages"))
    return messages.groupBy("conv_id").agg(
        F.flatten(
            F.transform(
                F.sort_array(F.collect_list(F.struct("turn", "messages"))), lambda t: t["messages"]
            )
        ).alias("messages")
    )


def render(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted and segments from conv_id and messages.

    segments are the parts of formatted in order, each with in_loss: true for
    what the assistant says. Joined they are formatted; those in the loss are
    the texts to learn from, escaped as in formatted.
    """
    def parts(m: Column) -> Column:
        head = F.concat(F.lit(TURN_START), _escape_role(m["role"]), F.lit("\n"))
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("in_loss")),
            F.struct(escape(m["text"]).alias("text"), (m["role"] == "assistant").alias("in_loss")),
            F.struct(F.lit(TURN_END).alias("text"), F.lit(False).alias("in_loss")),
        )

    return conversations.select("conv_id", F.flatten(F.transform("messages", parts)).alias("segments")).select(
        "conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments"
    )


def format_chats(events: DataFrame) -> DataFrame:
    """Final conversations of an event log, rendered: conv_id, formatted, segments."""
    return render(fold_events(events))


def read_back(formatted: Column) -> Column:
    """The turns of a rendered conversation as an array of (role, text)."""
    turns = F.filter(F.split(formatted, TURN_END, -1), lambda t: t != "")

    def turn(t: Column) -> Column:
        role = F.substring_index(t, "\n", 1)
        body = F.substring(t, F.length(role) + F.lit(2), F.length(t))
        return F.struct(
            _unescape_role(F.substring(role, F.lit(len(TURN_START) + 1), F.length(role))).alias("role"),
            unescape(body).alias("text"),
        )

    return F.transform(turns, turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, joined."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["in_loss"]), lambda s: unescape(s["text"])), "")
