"""Chat formatting: typed content parts, one template, a loss mask, and the way back.

A message holds parts ``{kind, text, ref, width, height, seconds, pages}``.
A visitor turns each part, in order, into text: text parts are escaped, image,
audio and document parts become one placeholder each and leave an attachment
``{kind, ref, tokens}``; the attachments of a message are in the order of its
placeholders, and ``tokens`` is what the placeholder expands to.

Template, once per message: ``<|turn|>ROLE\\n CONTENT <|end|>`` (without the
blanks). ``&``, ``<`` and ``[`` of texts are escaped as character references,
so no text can hold a control string (``<|..|>``, ``</s>``, ``[INST]``), and
unescaping gives back the very text. The loss mask is run-length coded:
for each message the characters before, inside and after its content, and
whether the content is under the loss.

Built-in functions only; work per conversation is linear in its length. A
conversation is one row, as its digest needs all of it in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, END = "<|turn|>", "<|end|>"
PART = "struct<kind:string,text:string,ref:string,width:long,height:long,seconds:double,pages:long>"
#: Expanded sizes: image patches of PATCH x PATCH pixels, audio frames a second, tokens a document page.
PATCH, FRAMES, PAGE_TOKENS = 28, 25, 512

_ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))


def escape(text: Column) -> Column:
    for plain, coded in _ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for plain, coded in reversed(_ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&#10;"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&#10;"), F.lit("\n")))


def visit(part: Column) -> Column:
    """What a part becomes in the text. Unknown kinds and null parts are empty."""
    return F.when(part["kind"] == "text", escape(F.coalesce(part["text"], F.lit("")))) \
        .when(part["kind"].isin("image", "audio", "document"), F.concat(F.lit("<|"), part["kind"], F.lit("|>"))).otherwise(F.lit(""))


def expanded_tokens(part: Column) -> Column:
    patches = lambda x: F.ceil(F.coalesce(x, F.lit(0)) / PATCH)
    return F.when(part["kind"] == "image", patches(part["width"]) * patches(part["height"])) \
        .when(part["kind"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * FRAMES)) \
        .when(part["kind"] == "document", F.coalesce(part["pages"], F.lit(0)) * PAGE_TOKENS).cast("long")


def text_part(text: Column) -> Column:
    """A message of one text part (a null text is empty)."""
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"), *[
        F.lit(None).cast(t).alias(n) for n, t in (("ref", "string"), ("width", "long"), ("height", "long"), ("seconds", "double"), ("pages", "long"))]))


def format_messages(messages: DataFrame, learn_from: str = "assistant") -> DataFrame:
    """One row per conversation of ``messages(conv_id, turn, role, parts)``.

    ``conv_id, formatted, mask, attachments``. Messages are ordered by turn,
    then role and content, nulls first; so repeated rows stay, side by side. A
    null role is empty, null parts are an empty message, a null conv_id is a
    conversation of its own. Further columns are ignored.
    """
    parts = F.coalesce(F.col("parts"), F.array().cast(f"array<{PART}>"))
    content = F.array_join(F.transform(parts, visit), "")
    media = F.transform(F.filter(parts, lambda p: p["kind"].isin("image", "audio", "document")),
                        lambda p: F.struct(p["kind"].alias("kind"), p["ref"].alias("ref"), expanded_tokens(p).alias("tokens")))
    turns = messages.select("conv_id", F.struct(
        "turn", F.coalesce(F.col("role"), F.lit("")).alias("role"), content.alias("content"), media.alias("media")).alias("m"))
    talks = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("m")).alias("m"))
    head = lambda m: F.concat(F.lit(TURN), escape_role(m["role"]), F.lit("\n"))
    return talks.select(
        "conv_id",
        F.array_join(F.transform("m", lambda m: F.concat(head(m), m["content"], F.lit(END))), "").alias("formatted"),
        F.transform("m", lambda m: F.struct(
            F.char_length(head(m)).alias("before"), F.char_length(m["content"]).alias("inside"),
            F.lit(len(END)).alias("after"), (m["role"] == learn_from).alias("loss"))).alias("mask"),
        F.flatten(F.transform("m", lambda m: m["media"])).alias("attachments"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds ``turns`` (role, text, loss) to rows of ``formatted, mask``, from these two alone."""
    pieces = formatted.withColumn("pieces", F.expr("slice(split(formatted, '<[|]turn[|]>'), 2, size(mask))"))
    # a piece: role, line feed, content, end mark; the mask says where its content lies
    inside = lambda p, x: F.substr(p, x["before"] - len(TURN) + 1, x["inside"])
    return pieces.withColumn("turns", F.zip_with("pieces", "mask", lambda p, x: F.struct(
        unescape_role(F.substring_index(p, "\n", 1)).alias("role"), unescape(inside(p, x)).alias("text"), x["loss"].alias("loss")))).drop("pieces")
