"""Chat texts from event logs.

A log row is (conversation, sequence number, message, kind, role, text).  Kinds:

* ``message``     a whole message;
* ``delta``       more text of a message that is being streamed;
* ``edit``        the message's text is replaced;
* ``regenerate``  the message's text so far is dropped and, if a text is given, begins with it.

``fold`` partitions the log by conversation and message (a conversation with very many
rows is thereby spread over its messages) and sorts each part by sequence.  Read from its
end, a row counts until one that replaces the text has been met; the rows before that
are dropped while they stream by, and the texts of the others, which make up the
message, are joined in sequence.  ``render`` turns each message into a marked turn:

    ### User: text </turn>
    ### Assistant: text </turn>

Inside texts and roles a backslash goes before every ``\\``, ``#`` and ``<`` (in roles
also ``:`` and ``=``), so no mark can occur in a text, and ``parse`` undoes it.  The
loss mask is a span of each assistant turn: its escaped text.

Defined results: null texts and roles are empty; rows with a null kind are whole
messages; unknown kinds are an error; ties in sequence go by kind and text; rows that
repeat are rows of their own (a repeated delta adds its text twice); a message keeps
the place and role of its first row; null sequence numbers come first, null conversations
and messages are ones of their own; an empty log gives no messages; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the template
END = " </turn>\n"
NAMES = {"user": "User", "assistant": "Assistant", "system": "System", "tool": "Tool"}
KINDS = ("delta", "edit", "message", "regenerate")
LEARNED = "assistant"


def _escape(c: Column, marks: str) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), f"([{marks}])", r"\\$1")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def fold(events: DataFrame, *, conversation="conv_id", seq="seq", message="message", kind="kind", role="role",
         text="text") -> DataFrame:
    """``(conversation, place, message, role, text)``, a row for each message."""
    k = F.coalesce(F.col(kind), F.lit("message"))
    checked = F.when(k.isin(*KINDS), k).otherwise(F.raise_error(F.concat(F.lit("unknown event kind: "), k)))
    log = events.select(F.col(conversation).alias("conversation"), F.col(message).alias("message"), F.struct(
        F.col(seq).alias("seq"), checked.alias("kind"), F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.coalesce(F.col(role), F.lit("")).alias("role")).alias("row"))
    part = Window.partitionBy("conversation", "message")
    from_end = part.orderBy(F.desc("row")).rowsBetween(Window.unboundedPreceding, -1)
    replaced = F.max(F.col("row.kind") != "delta").over(from_end)  # by a later row
    first = F.min(F.struct("row.seq", "row.kind", "row.text", "row.role")).over(part)
    # the place and role of the first row, also where it is replaced itself
    kept = log.withColumn("replaced", replaced).withColumn("first", first).where("replaced IS NULL OR NOT replaced")
    texts = F.transform(F.array_sort(F.collect_list("row")), lambda x: x["text"])
    return kept.groupBy("conversation", "message").agg(F.min("first").alias("first"), F.array_join(texts, "").alias("text")).select(
        "conversation", F.col("first.seq").alias("place"), "message", F.col("first.role").alias("role"), "text")


def render(messages: DataFrame) -> DataFrame:
    """Adds ``formatted`` and the loss span ``[loss_start, loss_end)`` in it, in code points."""
    title = F.lit(None).cast("string")
    for role, name in NAMES.items():
        title = F.coalesce(title, F.when(F.col("role") == role, F.lit(name)))
    title = F.coalesce(title, F.concat(F.lit("="), _escape(F.col("role"), r"\\#<:=")))
    head, body = F.concat(F.lit("### "), title, F.lit(": ")), _escape(F.col("text"), r"\\#<")
    start = F.length(head)
    learned = F.col("role") == LEARNED
    return messages.select("*", F.concat(head, body, F.lit(END)).alias("formatted"),
                           F.when(learned, start).alias("loss_start"),
                           F.when(learned, start + F.length(body)).alias("loss_end"))


def parse(formatted: Column) -> tuple[Column, Column]:
    """Role and text of a rendered turn."""
    title = F.regexp_extract(formatted, r"(?s)^### ((?:\\.|[^:\\])*): ", 1)
    role = F.lit(None).cast("string")
    for known, name in NAMES.items():
        role = F.coalesce(role, F.when(title == name, F.lit(known)))
    role = F.coalesce(role, unescape(F.substr(title, F.lit(2))))
    body = F.substr(formatted, F.length(title) + 7, F.length(formatted) - F.length(title) - 6 - len(END))
    return role, unescape(body)
