"""Chat formatting with Spark expressions only: collected turns are sorted, merged, concatenated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The control strings of the template.
START, END, BREAK = "<|im_start|>", "<|im_end|>", "<|im_break|>"
_CLOSE = END + "\n"


def escape(text: Column) -> Column:
    """``<|`` of the text becomes ``<||`` (one bar more for every run), so no control string is left."""
    return F.regexp_replace(text, r"<(\|+)", "<|$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\|(\|+)", "<$1")


def escape_role(role: Column) -> Column:
    """A role stands on the header line, so its backslashes and line ends are escaped as well."""
    return F.replace(F.replace(escape(role), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    # every pair that starts with a backslash is one character
    line = F.regexp_replace(role, r"\\n|\\\\", "\u0000$0")
    line = F.replace(F.replace(line, F.lit("\u0000\\n"), F.lit("\n")), F.lit("\u0000\\\\"), F.lit("\\"))
    return unescape(line)


def _pieces(turns: Column) -> Column:
    """What each turn adds to the output. A run of one role is one block: its first turn opens it,
    its last one closes it, and break marks stand between. Neighbours are looked up by position, so
    a conversation takes time in proportion to its length.
    """

    def piece(turn: Column, i: Column) -> Column:
        after = F.coalesce(F.get(turns, i - 1)["role"] == turn["role"], F.lit(False))
        before = F.coalesce(F.get(turns, i + 1)["role"] == turn["role"], F.lit(False))
        opening = F.concat(F.lit(START), escape_role(turn["role"]), F.lit("\n"))
        return F.concat(
            F.when(after, F.lit("")).otherwise(opening),
            escape(turn["text"]),
            F.when(before, F.lit(BREAK)).otherwise(F.lit(_CLOSE)),
        )

    return F.transform(turns, piece)


def format_chats(df: DataFrame) -> DataFrame:
    """(conv_id, formatted) of rows (conv_id, turn, role, text).

    Turns are sorted by turn, ties by role and text; repeated rows are repeated turns; a null turn
    sorts first. Null roles and texts count as empty, a null conv_id is a conversation of its own.
    Adjacent turns of one role are merged into one block, with a break mark between their texts, so
    that the turns can be read back. An empty table gives no rows; other columns are ignored.
    """
    turn = F.struct(
        F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    return (
        df.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
        .select("conv_id", F.array_join(_pieces(F.col("turns")), "").alias("formatted"))
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, as they went in."""
    blocks = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda piece: piece != "")

    def turns(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        body = F.substr(
            piece, F.length(role) + 2, F.length(piece) - F.length(role) - 1 - F.lit(len(_CLOSE))
        )
        return F.transform(
            F.split(body, r"<\|im_break\|>"),
            lambda text: F.struct(unescape_role(role).alias("role"), unescape(text).alias("text")),
        )

    return F.flatten(F.transform(blocks, turns))


def loss_text(turns: Column, role: str = "assistant") -> Column:
    """All text under the loss mask: what the role says, in order, nothing between."""
    said = F.filter(turns, lambda t: t["role"] == role)
    return F.concat_ws("", F.transform(said, lambda t: t["text"]))


def digest_chats(formatted: DataFrame) -> DataFrame:
    """Counts and digests of formatted conversations, read back from their text."""
    read = formatted.withColumn("turns", read_turns(F.col("formatted")))
    told = F.concat_ws(
        "", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    )
    loss = loss_text(F.col("turns"))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(told, "utf-8"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(F.encode(loss, "utf-8"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
