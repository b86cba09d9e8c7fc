"""Operator 4: chat formatting with typed content parts, in DataFrame functions only.

Method: a visitor over typed parts. A message's content is text or an array of parts
``struct<type, text, ref, width, height, seconds, pages>``; the visitor turns each part into its piece
of the ordered text: escaped text, or a placeholder ``<image t.k>`` (``audio``, ``document``) with turn
position t and part position k, and records the attachment's reference and the number of tokens that
the placeholder stands for.

Template: ``<turn ROLE>\\n`` CONTENT ``</turn>\\n`` for each turn. Inside roles and texts the backslash
becomes ``\\b``, ``<`` becomes ``\\l`` and ``>`` becomes ``\\g``; so no control string can stand inside a
text, and three replacements in the other order undo it.

The loss mask is a run-length list ``array<struct<chars, loss>>`` in code points over the formatted
text: head, content and tail of each turn; the content of assistant turns is under the mask.

Scale: one shuffle, on the conversation id, of rows that go into the output anyway. A conversation is
one output row, so its turns meet in one task; all work on it is linear in its size.

Defined results: null text or role is the empty text; very long texts and conversations are formatted whole; null turns come first; turns that tie are ordered
by role, then content, and repeated rows are kept; rows with a null conversation id form one
conversation; unknown part types are treated as text; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
#: Tokens that placeholders stand for: patches of 28 x 28 pixels, 25 frames a second, 512 a page.
PATCH, FRAMES, PER_PAGE = 28, 25, 512
TAIL = "</turn>\n"


def escape(c: Column) -> Column:
    for a, b in (("\\", "\\b"), ("<", "\\l"), (">", "\\g")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def unescape(c: Column) -> Column:
    for a, b in ((">", "\\g"), ("<", "\\l"), ("\\", "\\b")):
        c = F.replace(c, F.lit(b), F.lit(a))
    return c


def _is_media(part: Column) -> Column:
    return F.coalesce(part["type"].isin("image", "audio", "document"), F.lit(False))


def part_tokens(part: Column) -> Column:
    """The number of tokens a part's placeholder expands to; 0 for text."""
    image = F.ceil(F.coalesce(part["width"], F.lit(0)) / PATCH) * F.ceil(F.coalesce(part["height"], F.lit(0)) / PATCH)
    return (
        F.when(part["type"] == "image", F.greatest(image, F.lit(1).cast("long")))
        .when(part["type"] == "audio", F.greatest(F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * FRAMES), F.lit(1).cast("long")))
        .when(part["type"] == "document", F.greatest(F.coalesce(part["pages"], F.lit(0)).cast("long") * PER_PAGE, F.lit(1).cast("long")))
        .otherwise(F.lit(0).cast("long"))
    )


def visit(parts: Column, turn: Column) -> Column:
    """The ordered text of a message's parts, texts escaped and attachments as placeholders."""

    def one(part: Column, k: Column) -> Column:
        place = F.concat(F.lit("<"), part["type"], F.lit(" "), turn.cast("string"), F.lit("."), k.cast("string"), F.lit(">"))
        return F.when(_is_media(part), place).otherwise(escape(F.coalesce(part["text"], F.lit(""))))

    return F.array_join(F.transform(parts, one), "")


def attachments(parts: Column, turn: Column) -> Column:
    """The references of a message's attachments, in order, with their expanded token counts."""

    def one(part: Column, k: Column) -> Column:
        return F.struct(turn.cast("long").alias("turn"), k.cast("long").alias("part"), part["type"].alias("type"), part["ref"].alias("ref"), part_tokens(part).alias("tokens"))

    return F.filter(F.transform(parts, one), lambda a: F.coalesce(a["type"].isin("image", "audio", "document"), F.lit(False)))


def format_chat(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", content: str = "text") -> DataFrame:
    """One row a conversation: conv, formatted, loss_runs, attachments, expanded_tokens.

    ``content`` is a string column or an array of parts.
    """
    typed = isinstance(messages.schema[content].dataType, T.ArrayType)
    said = F.coalesce(F.col(content), F.array().cast(f"array<{PART}>")) if typed else F.coalesce(F.col(content), F.lit(""))
    rows = messages.select(F.col(conv).alias("c"), F.col(turn).alias("t"), F.coalesce(F.col(role), F.lit("")).alias("r"), said.alias("x"))
    turns = rows.groupBy("c").agg(F.sort_array(F.collect_list(F.struct("t", "r", "x"))).alias("turns"))

    def laid(m: Column, k: Column) -> Column:
        body = visit(m["x"], k) if typed else escape(m["x"])
        return F.struct(F.concat(F.lit("<turn "), escape(m["r"]), F.lit(">\n")).alias("head"), body.alias("body"), (m["r"] == "assistant").alias("loss"))

    runs = lambda m: F.array(
        F.struct(F.length(m["head"]).cast("long").alias("chars"), F.lit(False).alias("loss")),
        F.struct(F.length(m["body"]).cast("long").alias("chars"), m["loss"].alias("loss")),
        F.struct(F.lit(len(TAIL)).cast("long").alias("chars"), F.lit(False).alias("loss")),
    )
    found = F.flatten(F.transform("turns", lambda m, k: attachments(m["x"], k))) if typed else F.array().cast("array<struct<turn:bigint,part:bigint,type:string,ref:string,tokens:bigint>>")
    made = turns.select("c", F.transform("turns", laid).alias("laid"), found.alias("attachments"))
    return made.select(
        F.col("c").alias(conv),
        F.array_join(F.transform("laid", lambda m: F.concat(m["head"], m["body"], F.lit(TAIL))), "").alias("formatted"),
        F.flatten(F.transform("laid", runs)).alias("loss_runs"),
        "attachments",
        F.aggregate("attachments", F.lit(0).cast("long"), lambda s, a: s + a["tokens"]).alias("expanded_tokens"),
    )


def _turns(formatted: Column) -> Column:
    pieces = F.split(formatted, TAIL)
    return F.slice(pieces, 1, F.size(pieces) - 1)


def read_back(formatted: Column) -> Column:
    """The turns that a formatted text holds: array of (role, text), unescaped, placeholders as they stand."""

    def one(piece: Column) -> Column:
        head = F.substring_index(piece, ">\n", 1)
        return F.struct(
            unescape(F.substring(head, len("<turn ") + 1, 2**31 - 1)).alias("role"),
            unescape(piece.substr(F.length(head) + 3, F.length(piece))).alias("text"),
        )

    return F.transform(_turns(formatted), one)


def under_mask(formatted: Column, loss_runs: Column) -> Column:
    """All text under the loss mask, unescaped, by the runs' lengths alone; an error if they do not fit the text.

    Each turn has its three runs, so that the work is linear in the text: no run is looked for from the beginning.
    """

    def one(piece: Column, k: Column) -> Column:
        whole, runs = F.concat(piece, F.lit(TAIL)), [F.get(loss_runs, k * 3 + j) for j in range(3)]
        begin, out = F.lit(1).cast("long"), []
        for run in runs:
            out.append(F.when(run["loss"], whole.substr(begin.cast("int"), run["chars"].cast("int"))).otherwise(F.lit("")))
            begin = begin + run["chars"]
        return F.when(begin - 1 == F.length(whole), F.concat(*out)).otherwise(F.raise_error(F.lit("the loss mask does not fit the text")))

    return unescape(F.array_join(F.transform(_turns(formatted), one), ""))
