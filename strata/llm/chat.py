"""Chat formatting as one relational expression, and its reading back.

The turns of a conversation are collected as structs and sorted, adjacent turns
of one role are merged into one message, and the messages are joined to a text.
A message is ``[INST]role[/INST]``, its turns with ``<t>`` between them, and
``</s>``.  Control strings inside roles and texts are escaped with backslash
codes, so what is read back is what went in.

A conversation is one row of the result, so its turns meet in one task by the
result's definition; nothing else is gathered.

Null texts and roles are read as empty.  Turns are ordered by number (null
first), ties by role and text; repeated rows are turns of their own.  Rows whose
conversation id is null form one conversation.  Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import or_empty

# Fixed values of the template.
OPEN, BODY, TURN, CLOSE = "[INST]", "[/INST]", "<t>", "</s>"
# The escape sign comes first when escaping and last when reading back.
CODES = [("\\", "\\e"), (OPEN, "\\o"), (BODY, "\\b"), (TURN, "\\t"), (CLOSE, "\\s")]

_MESSAGES = "array<struct<role:string,texts:array<string>>>"
_SPANS = "struct<at:bigint,spans:array<struct<start:bigint,chars:bigint>>>"


def escape(text: Column) -> Column:
    return reduce(lambda t, code: F.replace(t, F.lit(code[0]), F.lit(code[1])), CODES, text)


def unescape(text: Column) -> Column:
    return reduce(lambda t, code: F.replace(t, F.lit(code[1]), F.lit(code[0])), reversed(CODES), text)


def _merge(messages: Column, turn: Column) -> Column:
    """The messages so far with one more turn: into the last one if the role is its role."""
    last = F.element_at(messages, -1)
    joined = F.struct(last["role"].alias("role"), F.concat(last["texts"], F.array(turn["text"])).alias("texts"))
    own = F.struct(turn["role"].alias("role"), F.array(turn["text"]).alias("texts"))
    same = (F.size(messages) > 0) & (F.get(messages, F.size(messages) - 1)["role"] == turn["role"])
    return F.when(same, F.concat(F.slice(messages, 1, F.size(messages) - 1), F.array(joined))).otherwise(
        F.concat(messages, F.array(own))
    )


def _render(message: Column) -> Column:
    return F.concat(F.lit(OPEN), message["role"], F.lit(BODY), F.array_join(message["texts"], TURN), F.lit(CLOSE))


def _mask(state: Column, message: Column, role: str) -> Column:
    """Adds the places of the message's turns if it is of the trained role."""
    head = F.length(message["role"]) + len(OPEN) + len(BODY)
    within = F.aggregate(
        message["texts"],
        F.struct((state["at"] + head).alias("at"), F.array().cast("array<struct<start:bigint,chars:bigint>>").alias("spans")).cast(_SPANS),
        lambda s, t: F.struct(
            (s["at"] + F.length(t) + len(TURN)).alias("at"),
            F.concat(s["spans"], F.array(F.struct(s["at"].alias("start"), F.length(t).cast("bigint").alias("chars")))).alias("spans"),
        ).cast(_SPANS),
    )
    return F.struct(
        (within["at"] - len(TURN) + len(CLOSE)).alias("at"),
        F.when(message["role"] == role, F.concat(state["spans"], within["spans"])).otherwise(state["spans"]).alias("spans"),
    ).cast(_SPANS)


def format_chats(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", trained_role: str = "assistant"
) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``loss_spans``.

    ``loss_spans`` are the places in ``formatted`` (start from 0, length, in code
    points) of the trained role's turns.
    """
    rows = turns.select(
        F.col(f"`{conv_id}`").alias("conv_id"),
        F.struct(
            F.col(f"`{turn}`").alias("turn"), escape(or_empty(role)).alias("role"), escape(or_empty(text)).alias("text")
        ).alias("one"),
    )
    sorted_turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("turns"))
    merged = sorted_turns.select(
        "conv_id", F.aggregate("turns", F.array().cast(_MESSAGES), lambda m, t: _merge(m, t).cast(_MESSAGES)).alias("messages")
    )
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,chars:bigint>>").alias("spans")).cast(_SPANS)
    return merged.select(
        "conv_id",
        F.array_join(F.transform("messages", _render), "").alias("formatted"),
        F.aggregate("messages", start, lambda s, m: _mask(s, m, escape(F.lit(trained_role))), lambda s: s["spans"]).alias("loss_spans"),
    )


def _literal(mark: str) -> str:
    return f"\\Q{mark}\\E"


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id``, ``turns`` (structs of role and text), ``loss_text``, ``formatted_chars``."""
    messages = F.slice(
        F.split("formatted", _literal(CLOSE), -1), 1, F.size(F.split("formatted", _literal(CLOSE), -1)) - 1
    )

    def turns_of(message: Column) -> Column:
        parts = F.split(message, _literal(BODY), -1)
        role = unescape(F.substring(F.get(parts, F.lit(0)), len(OPEN) + 1, 2**31 - 1))
        return F.transform(
            F.split(F.get(parts, F.lit(1)), _literal(TURN), -1), lambda t: F.struct(role.alias("role"), unescape(t).alias("text"))
        )

    return formatted.select(
        "conv_id",
        F.flatten(F.transform(messages, turns_of)).alias("turns"),
        F.array_join(
            F.transform(
                "loss_spans",
                lambda s: unescape(F.col("formatted").substr((s["start"] + 1).cast("int"), s["chars"].cast("int"))),
            ),
            "",
        ).alias("loss_text"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
