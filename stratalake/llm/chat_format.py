"""Conversations as training text: typed content parts flattened into one string with a loss mask and references.

A message's content is a list of typed parts. A visitor turns the parts into pieces of text, in order: texts into
themselves, with control strings escaped, any other part into the placeholder of its kind. What the placeholder stands for is
recorded beside the text: the reference, where it stands, and the number of tokens that it expands to.

Template: ``<|im_start|>``, role, line feed, content, ``<|im_end|>``, line feed, for each message. In a text, ``<``,
backslashes and ``|`` in a row get one backslash more, so no text holds ``<|`` and the step back is exact.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BEGIN, END = "<|im_start|>", "<|im_end|>\n"
#: A part of a message; what does not belong to its kind is null.
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
TEXT, IMAGE, AUDIO, DOCUMENT = "text", "image", "audio", "document"
#: The placeholder of a part of any other kind.
OTHER = "attachment"
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Expansion:
    """Tokens that placeholders expand to. A part that does not tell its size counts as one token."""

    patch: int = 14
    per_second: float = 25.0
    per_page: int = 256

    def tokens(self, part: Column) -> Column:
        patches = F.ceil(part["width"] / self.patch) * F.ceil(part["height"] / self.patch)
        frames = F.ceil(part["seconds"] * self.per_second)
        pages = part["pages"].cast("long") * self.per_page
        kind = part["kind"]
        size = F.when(kind == IMAGE, patches).when(kind == AUDIO, frames).when(kind == DOCUMENT, pages)
        return F.greatest(F.coalesce(size, F.lit(1)), F.lit(0)).cast("long")


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", "<$1|")


def escaped_role(role: Column) -> Column:
    """A role on one line, without ``<``; a null role is empty."""
    out = F.coalesce(role, F.lit(""))
    for plain, code in (("%", "%25"), ("\n", "%0A"), ("<", "%3C")):
        out = F.replace(out, F.lit(plain), F.lit(code))
    return out


def unescaped_role(role: Column) -> Column:
    for plain, code in (("\n", "%0A"), ("<", "%3C"), ("%", "%25")):
        role = F.replace(role, F.lit(code), F.lit(plain))
    return role


def is_text(part: Column) -> Column:
    """A part that is missing or has no kind counts as text."""
    return F.coalesce(part["kind"], F.lit(TEXT)) == TEXT


def placeholder(kind: Column) -> Column:
    known = F.when(kind.isin(IMAGE, AUDIO, DOCUMENT), kind).otherwise(OTHER)
    return F.concat(F.lit("<|"), known, F.lit("|>"))


def flattened(parts: DataFrame, by: Sequence[str], expansion: Expansion) -> DataFrame:
    """The visitor: rows of parts (``by``, number, part) as pieces of text in the order of ``piece``.

    A piece is a placeholder, with kind and ref, or the text parts between two of them, joined before they are
    escaped: else a ``<`` and a ``|`` of two parts would make a control string.
    """
    part = F.col("part")
    seen = Window.partitionBy(*by).orderBy("number")
    visited = parts.select(
        *by,
        "number",
        is_text(part).alias("is_text"),
        part["kind"].alias("kind"),
        part["ref"].alias("ref"),
        F.when(is_text(part), F.coalesce(part["text"], F.lit(""))).alias("text"),
        F.when(~is_text(part), expansion.tokens(part)).alias("size"),
    ).withColumn("run", F.sum(F.when(F.col("is_text"), 0).otherwise(1)).over(seen))
    joined = visited.groupBy(*by, "run", "is_text").agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("number", "text")))["text"], "").alias("text"),
        F.min(F.struct("number", "kind", "ref", "size")).alias("first"),
    )
    text = F.col("is_text")
    return joined.select(
        *by,
        F.struct("run", "is_text").alias("piece"),
        "is_text",
        F.col("first.number").alias("number"),
        F.when(~text, F.col("first.kind")).alias("kind"),
        F.when(~text, F.col("first.ref")).alias("ref"),
        F.when(text, escaped(F.col("text"))).otherwise(placeholder(F.col("first.kind"))).alias("body"),
        F.when(text, F.regexp_count("text", F.lit(WORD)).cast("long")).otherwise(F.col("first.size")).alias("tokens"),
    )


def text_content(text: Column) -> Column:
    """Content of one text part; a null text is empty."""
    fields = {"kind": F.lit(TEXT), "text": F.coalesce(text, F.lit(""))}
    names = [f.split(":") for f in PART[len("struct<") : -1].split(",")]
    return F.array(F.struct(*[fields.get(n, F.lit(None)).cast(kind).alias(n) for n, kind in names]))


def format_conversations(
    messages: DataFrame,
    loss_roles: Sequence[str] = ("assistant",),
    expansion: Expansion = Expansion(),  # noqa: B008  it is frozen
) -> DataFrame:
    """One row for each conversation of ``messages`` (conv_id, turn, role, content): conv_id, ``formatted``, ``tokens``
    and ``turns``, an entry for each message in order:

    ``start`` and ``length`` in ``formatted``; ``loss``, spans (start, length) of the texts if the role is among
    ``loss_roles``; ``attachments``: ``part`` (its number in the message), ``kind``, ``ref``, ``start``, ``tokens``.
    Places count code points. ``tokens``: words of the texts, and what the placeholders expand to.

    Messages are ordered by turn, those without one last; equal turns by role, then content, nulls first. Repeated
    rows are messages of their own. A null role is empty. Null or empty content is an empty message, a null part or
    kind is text and a null text is empty. Any other kind gets the placeholder ``<|attachment|>`` and keeps its name.
    Rows without a conv_id are one conversation without an id. A conversation is one row, so what bounds it is a
    string's 2 GB. An empty table gives no rows; other columns are not read.
    """
    rows = messages.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.col("role").alias("role"),
        F.col("content").cast(f"array<{PART}>").alias("content"),
    )
    # One shuffle, by conversation: everything below keeps its partitions. Places are running sums, so that a
    # conversation of many turns, or a message of many parts, costs no more than its length.
    conversation = Window.partitionBy("conv_id")
    in_order = conversation.orderBy(F.col("turn").isNull(), "turn", "role", "content")
    numbered = rows.withColumn("message", F.row_number().over(in_order) - 1)
    header = F.concat(F.lit(BEGIN), escaped_role(F.col("role")), F.lit("\n"))
    by = ("conv_id", "message", "role", "header")
    numbered = numbered.select(*by[:3], header.alias("header"), F.posexplode_outer("content").alias("number", "part"))
    parts = flattened(numbered.withColumn("number", F.coalesce("number", F.lit(0))), by, expansion)
    ahead = Window.partitionBy("conv_id", "message").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    before = F.length("header") + F.coalesce(F.sum(F.length("body")).over(ahead), F.lit(0))
    parts = parts.withColumn("at", before.cast("long"))

    learnt = F.coalesce(F.col("role").isin(*loss_roles), F.lit(False)) & F.col("is_text") & (F.length("body") > 0)
    span = F.struct("number", "at", F.length("body").cast("long").alias("length"))
    reference = F.struct("number", "kind", "ref", "at", "tokens")
    whole = parts.groupBy("conv_id", "message", "header").agg(
        F.sort_array(F.collect_list(F.struct("piece", "body"))).alias("bodies"),
        F.sort_array(F.collect_list(F.when(learnt, span))).alias("spans"),
        F.sort_array(F.collect_list(F.when(~F.col("is_text"), reference))).alias("references"),
        F.sum("tokens").alias("tokens"),
    )
    whole = whole.select(
        "conv_id",
        "message",
        F.concat("header", F.array_join("bodies.body", ""), F.lit(END)).alias("segment"),
        "spans",
        "references",
        "tokens",
    ).withColumn("length", F.length("segment").cast("long"))
    earlier = conversation.orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.withColumn("start", F.coalesce(F.sum("length").over(earlier), F.lit(0)))
    start = F.col("start")
    turn = F.struct(
        "start",
        "length",
        F.transform("spans", lambda s: F.struct((start + s["at"]).alias("start"), s["length"].alias("length"))).alias("loss"),
        F.transform(
            "references",
            lambda r: F.struct(
                r["number"].alias("part"),
                r["kind"].alias("kind"),
                r["ref"].alias("ref"),
                (start + r["at"]).alias("start"),
                r["tokens"].alias("tokens"),
            ),
        ).alias("attachments"),
    )
    out = whole.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("message", "segment", turn.alias("turn")))).alias("all"),
        F.sum("tokens").alias("tokens"),
    )
    return out.select("conv_id", F.array_join("all.segment", "").alias("formatted"), "tokens", F.col("all.turn").alias("turns"))


def attachments(formatted: DataFrame) -> DataFrame:
    """A row for each placeholder: conv_id, turn (from 0), part, kind, ref, start, tokens."""
    turns = formatted.select("conv_id", F.posexplode("turns").alias("turn", "t"))
    return turns.select("conv_id", "turn", F.inline("t.attachments"))


def read_conversations(formatted: DataFrame) -> DataFrame:
    """What ``formatted`` and its index say: conv_id, formatted and ``messages``, an entry for each message in order:

    ``role``; ``content``, parts (kind, text, ref) with a text between any two placeholders, empty ones left out;
    ``text``, the texts joined; ``learnt``, the text under the loss mask, read by the mask's places.
    """
    segments = F.split("formatted", r"<\|im_end\|>\n")
    segments = F.slice(segments, F.lit(1), F.size(segments) - 1)

    def message(segment: Column, turn: Column) -> Column:
        line = F.locate("\n", segment)
        role = F.substring(segment, F.lit(len(BEGIN) + 1), line - len(BEGIN) - 1)
        body = F.substring(segment, line + 1, F.length(segment))
        texts = F.transform(F.split(body, r"<\|[a-z]+\|>"), unescaped)
        kinds = turn["attachments"]
        pairs = F.transform(
            texts,
            lambda t, i: F.array(
                F.struct(F.lit(TEXT).alias("kind"), t.alias("text"), F.lit(None).cast("string").alias("ref")),
                F.struct(F.get(kinds, i)["kind"].alias("kind"), F.lit(None).cast("string").alias("text"), F.get(kinds, i)["ref"].alias("ref")),
            ),
        )
        content = F.filter(F.flatten(pairs), lambda p: F.coalesce(p["text"] != "", p["kind"].isNotNull()))
        learnt = F.transform(
            turn["loss"],
            lambda s: unescaped(F.substring(segment, (s["start"] - turn["start"] + 1).cast("int"), s["length"].cast("int"))),
        )
        return F.struct(
            unescaped_role(role).alias("role"),
            content.alias("content"),
            F.array_join(texts, "").alias("text"),
            F.array_join(learnt, "").alias("learnt"),
        )

    return formatted.select("conv_id", "formatted", F.zip_with(segments, "turns", message).alias("messages"))


def conversation_digests(read: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars of conversations read back."""
    turns = F.transform("messages", lambda m: F.concat(m["role"], F.lit("\n"), m["text"], F.lit("\n")))
    learnt = F.array_join("messages.learnt", "")
    return read.select(
        "conv_id",
        F.size("messages").cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length(learnt).cast("long").alias("loss_chars"),
        F.sha2(learnt, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
