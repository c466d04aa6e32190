"""Chat formatting of typed content parts, in DataFrame functions only.

A message is a list of parts: text, image, audio or document. A visitor renders each part in order:
text is escaped, an attachment becomes a placeholder such as ``<|image|>``, and its reference and
expanded token count are recorded in the order of the placeholders.

A turn is ``### role: body </turn>`` and a line feed. Inside texts and roles the backslash, ``#``, ``<``,
``:`` (roles) and the line feed become a backslash and a letter, so no control string and no line
feed of a text is left, and every backslash begins an escape: replacing the escapes one kind after
the other, the backslash's own last, gives the text back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, COLON, CLOSE = "### ", ": ", " </turn>"
ESCAPES = {"\\": "\\b", "#": "\\h", "<": "\\l", ":": "\\c", "\n": "\\n"}
PLACEHOLDER = r"<\|[a-z]+\|>"
#: Tokens an attachment expands to where the part does not say.
EXPANDED = {"image": 256, "audio": 128, "document": 512}
PART = "struct<type:string,text:string,ref:string,n_tokens:int>"


def escape(text: Column) -> Column:
    for plain, escaped in ESCAPES.items():
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def unescape(text: Column) -> Column:
    for plain, escaped in reversed(ESCAPES.items()):
        text = F.replace(text, F.lit(escaped), F.lit(plain))
    return text


def text_part(text: Column) -> Column:
    return F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("n_tokens")).cast(PART)


def _visit(part: Column) -> Column:
    """A part as it stands in the body; a part of an unknown type is read as text."""
    attachment = part["type"].isin(*EXPANDED)
    return F.when(attachment, F.concat(F.lit("<|"), part["type"], F.lit("|>"))).otherwise(escape(F.coalesce(part["text"], F.lit(""))))


def _record(part: Column, turn: Column) -> Column:
    tokens = F.coalesce(part["n_tokens"], *[F.when(part["type"] == k, F.lit(n)) for k, n in EXPANDED.items()])
    return F.struct(turn.alias("turn"), part["type"].alias("type"), part["ref"].alias("ref"), tokens.alias("n_tokens"))


def format_conversations(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts") -> DataFrame:
    """One row per conversation: `formatted`, the loss spans of assistant bodies and the attachments.

    A span is a start (from 1) and a length in code points of `formatted`. Attachments stand in the
    order of their placeholders. Messages stand by turn; equal turns by role, then by body; a null
    turn comes first. A null role, part list or text is empty, and a null conversation id is one
    conversation. Repeated rows are repeated turns. Other columns are not read. A conversation is one
    row of the result, so it has to fit into one.
    """
    own = F.coalesce(F.col(f"`{parts}`"), F.array().cast(f"array<{PART}>"))
    rows = messages.select(
        F.col(f"`{conv}`").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        escape(F.coalesce(F.col(f"`{role}`"), F.lit(""))).alias("role"),
        F.concat_ws("", F.transform(own, _visit)).alias("body"),
        F.transform(F.filter(own, lambda p: p["type"].isin(*EXPANDED)), lambda p: _record(p, F.col(f"`{turn}`"))).alias("attached"),
    )
    lines = rows.withColumn("line", F.concat(F.lit(OPEN), "role", F.lit(COLON), "body", F.lit(CLOSE + "\n")))
    # One exchange by conversation serves the running length and the grouping.
    ordered = Window.partitionBy("conv").orderBy("turn", "role", "body")
    before = F.sum(F.length("line")).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    start = F.coalesce(before, F.lit(0)) + F.length("role") + len(OPEN + COLON) + 1
    placed = lines.select(
        "conv",
        F.struct(
            F.row_number().over(ordered).alias("n"),
            "line",
            F.when(F.col("role") == "assistant", F.struct(start.cast("int").alias("start"), F.length("body").alias("length"))).alias("span"),
            "attached",
        ).alias("row"),
    )
    turns = placed.groupBy("conv").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    return turns.select(
        F.col("conv").alias(conv),
        F.concat_ws("", "rows.line").alias("formatted"),
        F.filter("rows.span", lambda s: s.isNotNull()).alias("loss_spans"),
        F.flatten("rows.attached").alias("attachments"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: role and text; placeholders are left out."""
    lines = F.filter(F.split(formatted, "\n"), lambda x: x != "")
    part = lambda line, k: F.regexp_extract(line, rf"(?s)^{OPEN}([^:]*){COLON}(.*){CLOSE}$", k)
    return F.transform(
        lines,
        lambda x: F.struct(unescape(part(x, 1)).alias("role"), unescape(F.regexp_replace(part(x, 2), PLACEHOLDER, "")).alias("text")),
    )


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, without placeholders, nothing between."""
    pieces = F.transform(spans, lambda s: F.substring(formatted, s["start"], s["length"]))
    return F.concat_ws("", F.transform(pieces, lambda x: unescape(F.regexp_replace(x, PLACEHOLDER, ""))))


def conversation_digests(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """What the formatted conversations say when read back."""
    turns = formatted.select(conv, "formatted", read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    said = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return turns.select(
        conv,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
