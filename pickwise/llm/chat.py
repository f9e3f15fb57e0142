r"""Chat formatting by relational expressions: sort, merge, concatenate, and read back.

A conversation becomes one string. Each run of adjacent turns with the same
role is one block::

    <|turn|>ROLE<|text|>TEXT[<|part|>TEXT ...]<|end|>\n

The texts of a merged block are kept apart by ``<|part|>``, so the original
turns can be read back. Control strings inside roles and texts are escaped
with a backslash (and backslashes are doubled), which ``unescape`` undoes
exactly. Beside the string, ``segments`` lists its pieces in order with a loss
flag: only the texts of assistant turns carry it, never their markers.

Defined cases: a null text or role counts as empty; turns with equal ``turn``
are ordered by role, then text; repeated rows stay as turns of their own; a
null turn number sorts first; rows with a null ``conv_id`` form one
conversation with a null id; an empty table gives no rows; other columns are
ignored. One conversation is one output value, so its rows meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, PART, END = "<|turn|>", "<|text|>", "<|part|>", "<|end|>"
LOSS_ROLE = "assistant"

# Strings that chat templates treat as control marks; none of them survives
# unescaped inside a formatted role or text.
CONTROL = ("<|", "[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>")


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in CONTROL:
        out = F.replace(out, F.lit(mark), F.lit(mark[0] + "\\" + mark[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows of turns -> (conv_id, formatted, segments array<struct<text, loss>>)."""
    def clean(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    rows = turns.select(F.col(conv_col).alias("conv_id"),
                        F.struct(F.col(turn_col).alias("turn"), clean(role_col).alias("role"),
                                 clean(text_col).alias("text")).alias("t"))
    convs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def pieces(t: Column, i: Column) -> Column:
        before = F.get(F.col("turns"), i - 1)["role"]
        after = F.get(F.col("turns"), i + 1)["role"]
        head = F.when(before.isNull() | (before != t["role"]),
                      F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT))).otherwise(F.lit(PART))
        tail = F.when(after.isNull() | (after != t["role"]), F.lit(END + "\n")).otherwise(F.lit(""))

        def piece(text: Column, loss: Column) -> Column:
            return F.struct(text.alias("text"), loss.alias("loss"))
        return F.array(piece(head, F.lit(False)),
                       piece(escape(t["text"]), t["role"] == LOSS_ROLE),
                       piece(tail, F.lit(False)))

    out = convs.select("conv_id", F.flatten(F.transform("turns", pieces)).alias("segments"))
    return out.select(
        "conv_id",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        "segments")


def parse_formatted(formatted: Column) -> Column:
    """The formatted string -> array<struct<role, text>>, the turns as they went in."""
    def quoted(mark: str) -> str:
        return r"\Q" + mark + r"\E"

    def block(b: Column) -> Column:
        role = unescape(F.substring_index(b, TEXT, 1))
        body = F.substring_index(F.substring_index(b, TEXT, -1), END, 1)
        return F.transform(F.split(body, quoted(PART)),
                           lambda p: F.struct(role.alias("role"), unescape(p).alias("text")))

    blocks = F.split(formatted, quoted(TURN))
    return F.flatten(F.transform(F.slice(blocks, 2, F.size(blocks)), block))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]),
                                    lambda s: unescape(s["text"])), "")
