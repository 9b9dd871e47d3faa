"""Chat formatting from an event log, with DataFrame functions only.

Events of a conversation are ordered by sequence number and folded into its final messages:

* ``message`` opens the next message with a role and a first text,
* ``delta`` appends its text to a message (streamed output),
* ``edit`` replaces a message's text,
* ``regenerate`` replaces a message's text and drops every message opened after it so far.

An event names its message by number (from 0, in order of opening); without a number it means
the message opened last. Events before any message, or naming one that doesn't exist, fold to
nothing. The fold is made of windows over (conversation, sequence), which stream and spill, so a
conversation may be long; only its final string must fit a row.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` for each message. In texts and roles a backslash
becomes two, ``<|`` becomes ``<\\|``; in roles a line end becomes ``\\n``. So no control string stands in
an escaped text and unescaping is exact. The loss mask is one span of code points for each message
(start included, end not): an assistant's text, or an empty span.

Cases: null text or role counts as empty; a null conversation id is a conversation of its own;
events that tie are ordered by kind, role, text and message number (null first), so turns that tie by role and
text; repeated rows are repeated turns; a very long text is one value of a row; an empty table gives no
conversation; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The order of a conversation's events; those equal in all of it are alike.
ORDER = ("seq", "kind", "role", "text", "message")
START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column, line_ends: bool = False) -> Column:
    out = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))
    return F.replace(out, F.lit("\n"), F.lit("\\n")) if line_ends else out


def unescape(text: Column, line_ends: bool = False) -> Column:
    def part(p: Column) -> Column:
        p = F.replace(p, F.lit("\\|"), F.lit("|"))
        return F.replace(p, F.lit("\\n"), F.lit("\n")) if line_ends else p

    # Escapes pair up from the left, so double backslashes are found first.
    return F.when(~F.contains(text, F.lit("\\")), text).otherwise(F.array_join(F.transform(F.split(text, r"\\\\", -1), part), "\\"))


def events_of_turns(turns: DataFrame) -> DataFrame:
    """The log of a table with a row for each turn (conv_id, turn, role, text)."""
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("seq"), F.lit("message").alias("kind"),
        F.lit(None).cast("long").alias("message"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )


def streamed(events: DataFrame, pieces: int = 3) -> DataFrame:
    """A log of ``message`` events told as a live conversation tells it, with the same final messages:

    * an assistant's message opens with a draft, is regenerated with nothing, and its text then comes in deltas,
    * any other message opens with a draft and is edited to its text.

    Sequence numbers are those of the messages, spread out; order among equals stays that of the messages.
    """
    order = Window.partitionBy("conv_id").orderBy(*ORDER)
    rows = events.withColumns({"__at": F.row_number().over(order).cast("long"), "__size": F.greatest(F.ceil(F.char_length("text") / pieces), F.lit(1)).cast("int")})
    event = lambda step, kind, text: F.struct(F.lit(step).cast("long").alias("step"), F.lit(kind).alias("kind"), text.alias("text"))
    draft = F.concat(F.lit("draft of "), F.reverse("text"))
    deltas = [event(2 + i, "delta", F.substring(F.col("text"), F.col("__size") * i + 1, F.col("__size"))) for i in range(pieces)]
    live = F.array(event(0, "message", draft), event(1, "regenerate", F.lit("")), *deltas)
    edited = F.array(event(0, "message", draft), event(1, "edit", F.col("text")))
    told = rows.withColumn("e", F.explode(F.when(F.col("role") == "assistant", live).otherwise(edited)))
    return told.select("conv_id", (F.col("__at") * (pieces + 2) + F.col("e.step")).alias("seq"), F.col("e.kind").alias("kind"), F.when(F.col("e.step") > 0, F.col("__at") - 1).alias("message"), "role", F.col("e.text").alias("text"))


def fold(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, message, role, text) of a log (conv_id, seq, kind, message, role, text)."""
    conversation = Window.partitionBy("conv_id").orderBy(*ORDER)
    so_far = conversation.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opened = F.sum((F.col("kind") == "message").cast("long")).over(so_far) - 1
    numbered = events.select("*", opened.alias("__opened"), F.row_number().over(conversation).alias("__at"))
    numbered = numbered.withColumn("__of", F.when(F.col("kind") == "message", F.col("__opened")).otherwise(F.coalesce("message", "__opened")))
    # A later regeneration of an earlier message drops this one: the least target from here on.
    later = Window.partitionBy("conv_id").orderBy(F.col("__at").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = numbered.withColumn("__cut", F.min(F.when(F.col("kind") == "regenerate", F.col("__of"))).over(later))
    message = Window.partitionBy("conv_id", "__of").orderBy("__at")
    version = F.sum((F.col("kind") != "delta").cast("long")).over(message.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    parts = numbered.where(F.col("__of").between(0, F.col("__opened"))).withColumn("__version", version)
    # Rows of one version of one message; what has a single part, as turns have, is no more than a row.
    last = Window.partitionBy("conv_id", "__of")
    parts = parts.withColumn("__last", F.max("__version").over(last))
    texts = parts.groupBy("conv_id", "__of").agg(
        F.max(F.when(F.col("kind") == "message", F.col("role"))).alias("role"),
        F.min(F.when(F.col("kind") == "message", F.struct(F.col("__at"), F.col("__cut")))).alias("__open"),
        F.array_sort(F.collect_list(F.when(F.col("__version") == F.col("__last"), F.struct("__at", "text")))).alias("__parts"),
    )
    kept = texts.where(F.col("__open").isNotNull() & (F.col("__open.__cut").isNull() | (F.col("__open.__cut") >= F.col("__of"))))
    return kept.select("conv_id", F.col("__of").alias("message"), "role", F.array_join(F.transform("__parts", lambda p: p["text"]), "").alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """A row for each conversation: conv_id, formatted, loss (array of start and end, a span a message)."""
    order = Window.partitionBy("conv_id").orderBy("message")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    head = F.concat(F.lit(START), escape(F.col("role"), True), F.lit("\n"))
    body = escape(F.col("text"))
    pieces = messages.select("conv_id", "message", "role", head.alias("head"), body.alias("body"))
    pieces = pieces.withColumn("piece", F.concat("head", "body", F.lit(END + "\n")))
    start = F.coalesce(F.sum(F.char_length("piece")).over(before), F.lit(0)) + F.char_length("head")
    pieces = pieces.withColumn("start", start)
    span = F.struct(F.col("start").alias("start"), (F.col("start") + F.when(F.col("role") == "assistant", F.char_length("body")).otherwise(0)).alias("end"))
    whole = pieces.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("message", "piece", span.alias("span")))).alias("all"))
    return whole.select("conv_id", F.array_join(F.transform("all", lambda p: p["piece"]), "").alias("formatted"), F.transform("all", lambda p: p["span"]).alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Messages and the text under the mask, from formatted and loss alone:
    conv_id, message, role, text, loss_text."""
    segments = F.slice(F.split("formatted", r"<\|im_start\|>", -1), 2, F.greatest(F.size("loss"), F.lit(1)))
    turns = formatted.select("conv_id", F.posexplode(F.arrays_zip(segments.alias("segment"), F.col("loss").alias("span"))).alias("message", "turn"))
    turns = turns.select("conv_id", "message", F.col("turn.segment").alias("segment"), F.col("turn.span").alias("span"))
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("at", F.coalesce(F.sum(F.char_length("segment") + len(START)).over(before), F.lit(0)) + len(START))
    role = F.substring_index("segment", "\n", 1)
    text = F.expr(f"substring(segment, char_length(substring_index(segment, '\\n', 1)) + 2, char_length(segment) - char_length(substring_index(segment, '\\n', 1)) - 2 - {len(END)})")
    masked = F.substring(F.col("segment"), (F.col("span.start") - F.col("at") + 1).cast("int"), (F.col("span.end") - F.col("span.start")).cast("int"))
    return turns.select("conv_id", "message", unescape(role, True).alias("role"), unescape(text).alias("text"), unescape(masked).alias("loss_text"))


def digest(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from the output."""
    turns = read_back(formatted)
    told = F.struct("message", F.concat("role", F.lit("\n"), "text", F.lit("\n")).alias("turn"), "loss_text")
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(told)).alias("all"))
    whole = whole.select("conv_id", F.size("all").cast("long").alias("n_turns"), F.array_join(F.transform("all", lambda p: p["turn"]), "").alias("turns"), F.array_join(F.transform("all", lambda p: p["loss_text"]), "").alias("loss"))
    sizes = formatted.select(F.col("conv_id").alias("of"), F.char_length("formatted").cast("long").alias("formatted_chars"))
    return whole.join(sizes, F.col("conv_id").eqNullSafe(F.col("of"))).select(
        "conv_id", "n_turns", F.sha2(F.col("turns").cast("binary"), 256).alias("turns_sha256"), F.char_length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars",
    )
