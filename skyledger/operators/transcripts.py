"""Chat transcripts: text of a message, visible turns, latest reply, clean blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Message kinds and the role each is shown as.
_ROLES = {"human": "user", "ai": "assistant"}
_VISIBLE = ("user", "assistant")


def display_role(role: Column) -> Column:
    """Role of a message; message kinds are mapped to roles, a missing role is the empty text."""
    named = F.coalesce(role, F.lit(""))
    for kind, shown in _ROLES.items():
        named = F.when(role == kind, shown).otherwise(named)
    return named


def message_text(content: Column, blocks: Column | None = None) -> Column:
    """Text of a message: its text content, else its text blocks put together, else empty.

    ``blocks`` is an array of structs with ``type`` and ``text``.
    """
    if blocks is None:
        return F.coalesce(content, F.lit(""))
    texts = F.transform(
        F.filter(blocks, lambda block: block["type"] == "text"),
        lambda block: F.coalesce(block["text"], F.lit("")),
    )
    return F.coalesce(content, F.array_join(texts, ""), F.lit(""))


def message_text_json(content: Column) -> Column:
    """``message_text`` of content held as a variant: a string, or an array of blocks."""
    blocks = F.try_variant_get(content, "$", "array<variant>")
    texts = F.transform(
        F.filter(blocks, lambda block: F.try_variant_get(block, "$.type", "string") == "text"),
        lambda block: F.coalesce(F.try_variant_get(block, "$.text", "string"), F.lit("")),
    )
    text = F.when(F.schema_of_variant(content) == "STRING", F.try_variant_get(content, "$", "string"))
    return F.coalesce(text, F.array_join(texts, ""), F.lit(""))


def visible_turns(messages: DataFrame) -> DataFrame:
    """User and assistant turns with text; input and output are (conv_id, turn, role, text)."""
    shown = messages.select("conv_id", "turn", display_role(F.col("role")).alias("role"), "text")
    return shown.filter(F.col("role").isin(*_VISIBLE) & (F.col("text") != ""))


def latest_reply(messages: DataFrame) -> DataFrame:
    """Text of the last assistant message per conversation, empty when there is none."""
    is_reply = display_role(F.col("role")) == "assistant"
    reply = F.max_by(F.when(is_reply, F.col("text")), F.when(is_reply, F.col("turn")))
    return messages.groupBy("conv_id").agg(F.coalesce(reply, F.lit("")).alias("reply"))


def clean_blocks(blocks: Column, fields: list[str]) -> Column:
    """Reduce text blocks to type and text (missing text is empty); other blocks stay as they are.

    ``fields`` are the field names of a block, in order. A dropped field is NULL, which ``to_json``
    leaves out.
    """

    def cleaned(block: Column) -> Column:
        is_text = block["type"] == "text"
        kept = []
        for name in fields:
            if name == "type":
                value = block["type"]
            elif name == "text":
                value = F.when(is_text, F.coalesce(block["text"], F.lit(""))).otherwise(block["text"])
            else:
                value = F.when(~F.coalesce(is_text, F.lit(False)), block[name])
            kept.append(value.alias(name))
        return F.struct(*kept)

    return F.transform(blocks, cleaned)
