"""Chat formatting whose output is parsed back and compared with its source.

Grammar of a formatted conversation::

    conversation = { "<|im_start|>" role "\\n" text "<|im_end|>\\n" }

Control strings are ``<|name|>``.  A part is first written as it is, parsed back with the deterministic
parser and compared with its source.  A part that would not come back is escaped: every ``<``, any number of
backslashes, ``|`` gets one more backslash.  Reading takes one backslash away from every ``<``, one or more
backslashes, ``|``.  Since an escaped part holds no ``<|``, it can't end or begin a turn, and unescaping
gives the source for every possible text; a comparison that still failed would stop the job.  Line ends and
carriage returns in a role, where a line end ends the role, become ``<|nl|>`` and ``<|cr|>``.

Everything is built of SQL functions.  Turns are brought together by conversation, as the format asks: a
conversation is one value.  Very many conversations with equal turns need no special care, as their
identifiers differ.

Defined results: null texts and roles are empty; a null turn number comes first, rows of one turn number
are ordered by role and text, and repeated rows are repeated turns; rows without a conversation id form a
conversation of their own with a null id; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
#: The role whose texts are under the loss mask.
TRAINED = "assistant"


def escaped(part: Column) -> Column:
    return F.regexp_replace(part, r"<(\\*)\|", r"<$1\\|")


def unescaped(part: Column) -> Column:
    return F.regexp_replace(part, r"<\\(\\*)\|", r"<$1|")


def _safe(part: Column) -> Column:
    """``part`` as it is where it would be read back unchanged, else escaped."""
    return F.when(~part.contains("<|") & (unescaped(part) == part), part).otherwise(escaped(part))


def rendered_turn(role: Column, text: Column) -> Column:
    """One turn in the grammar."""
    head = F.replace(F.replace(_safe(role), F.lit("\n"), F.lit("<|nl|>")), F.lit("\r"), F.lit("<|cr|>"))
    return F.concat(F.lit(START), head, F.lit("\n"), _safe(text), F.lit(f"{END}\n"))


def parsed(formatted: Column) -> Column:
    """The turns of a formatted conversation, as an array of (role, text)."""

    def turn(segment: Column) -> Column:
        head = F.substring_index(segment, "\n", 1)
        role = F.replace(F.replace(head, F.lit("<|nl|>"), F.lit("\n")), F.lit("<|cr|>"), F.lit("\r"))
        body = F.substr(
            segment, F.length(head) + 2, F.length(segment) - F.length(head) - 1 - len(END) - 1
        )
        return F.struct(unescaped(role).alias("role"), unescaped(body).alias("text"))

    # the string before the first control string is empty
    segments = F.split(formatted, r"\Q" + START + r"\E", -1)
    return F.transform(F.slice(segments, F.lit(2), F.size(segments)), turn)


def formatted(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted, turns (the source, as an array of (role, text) in order).

    The formatted text is parsed and compared with the turns; any difference raises an error.
    """
    part = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        part("role").alias("role"),
        part("text").alias("text"),
    ).withColumn("rendered", rendered_turn(F.col("role"), F.col("text")))
    gathered = rows.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("turn", F.lit(-(2**63))).alias("turn"), "role", "text", "rendered"))).alias("rows")
    )
    whole = gathered.select(
        "conv_id",
        F.array_join(F.transform("rows", lambda r: r["rendered"]), "").alias("formatted"),
        F.transform("rows", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text"))).alias("turns"),
    )
    same = parsed(F.col("formatted")) == F.col("turns")
    wrong = F.raise_error(F.concat(F.lit("formatted conversation is not read back: "), F.col("conv_id").cast("string")))
    return whole.withColumn("formatted", F.when(same, F.col("formatted")).otherwise(wrong.cast("string")))


def read_back(chats: DataFrame) -> DataFrame:
    """Digests of what the parser reads from each formatted conversation."""
    turns = chats.select("conv_id", "formatted", parsed(F.col("formatted")).alias("turns"))
    said = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    loss = F.array_join(
        F.transform(F.filter("turns", lambda t: t["role"] == TRAINED), lambda t: t["text"]), ""
    )
    return turns.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
