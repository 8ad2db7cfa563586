"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all preceding turns are its context and only
that reply is trainable. A conversation that does not end with an assistant turn gives one more
example, with everything as context and nothing trainable, so each turn of the table is in the
output and the last example of a conversation holds all of it.

Turn:      <|im_start|>ROLE\\nTEXT<|im_end|>\\n
Escaping:  in texts and roles, each `<`, any backslashes, `|` gets one more backslash, so no
           control string can occur inside a turn; reading back takes that backslash away. In
           roles `%` and the line break are written %25 and %0A as well.
Loss mask: one span of code points, (`loss_start`, `loss_length`), in the formatted text.

Null texts and roles are empty. Turns are in the order of (turn, role, text), nulls first, so ties
and repeated rows have a fixed place; rows with a null conversation id are one conversation.
An empty table gives no examples. The output grows with the square of a conversation's
turns, as the format asks for; rows are generated one by one, and only one conversation's own
turns are ever gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def examples(turns: DataFrame, target_role: str = "assistant") -> DataFrame:
    """conv_id, example (from 0), is_last, formatted, loss_start, loss_length of every example."""
    said = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    talk = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(said)).alias("said"))
    talk = talk.select(
        "conv_id",
        F.transform("said", lambda x: F.concat(F.lit(START), escape_role(x.role), F.lit("\n"))).alias("heads"),
        F.transform("said", lambda x: escape(x.text)).alias("texts"),
        F.filter(
            F.transform("said", lambda x, i: F.when((x.role == target_role) | (i == F.size("said") - 1), F.struct((i + 1).alias("upto"), (x.role == target_role).alias("trained")))),
            lambda x: x.isNotNull(),
        ).alias("targets"),
    )
    talk = talk.withColumn("parts", F.zip_with("heads", "texts", lambda head, text: F.concat(head, text, F.lit(END + "\n"))))
    talk = talk.select("conv_id", "heads", "texts", "parts", F.size("targets").alias("n"), F.posexplode("targets").alias("example", "target"))
    upto = F.col("target.upto")
    context = F.array_join(F.slice("parts", F.lit(1), upto - 1), "")
    rows = talk.select(
        "conv_id", "example", (F.col("example") == F.col("n") - 1).alias("is_last"), "target.trained", context.alias("context"),
        F.get("heads", upto - 1).alias("head"), F.get("texts", upto - 1).alias("reply"),
    )
    return rows.select(
        "conv_id", "example", "is_last", F.concat("context", "head", "reply", F.lit(END + "\n")).alias("formatted"),
        (F.length("context") + F.length("head")).alias("loss_start"), F.when(F.col("trained"), F.length("reply")).otherwise(F.lit(0)).alias("loss_length"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text, as structs of role and text."""
    blocks = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda block: block != "")
    def turn(block: Column) -> Column:
        head = F.substring_index(block, "\n", 1)
        return F.struct(
            unescape_role(F.substring(head, F.lit(len(START) + 1), F.length(head))).alias("role"),
            unescape(F.substring(block, F.length(head) + 2, F.length(block))).alias("text"),
        )
    return F.transform(blocks, turn)


def trained_text(formatted: Column, start: Column, length: Column) -> Column:
    """The unescaped text under the loss mask."""
    return unescape(F.substring(formatted, start + 1, length))


def digest(rows: DataFrame) -> DataFrame:
    """One row per conversation, read back from its examples.

    Each example is reduced to its own numbers and its trained text before rows meet, so the
    formatted texts are never gathered. The whole conversation is read from the last example.
    """
    read = rows.select(
        "conv_id", "example",
        F.when(F.col("is_last"), read_turns(F.col("formatted"))).alias("turns"),
        F.length("formatted").cast("long").alias("chars"),
        F.when(F.col("loss_length") > 0, trained_text(F.col("formatted"), F.col("loss_start"), F.col("loss_length"))).otherwise(F.lit("")).alias("trained"),
    )
    said = F.array_join(F.transform("turns", lambda x: F.concat(x.role, F.lit("\n"), x.text, F.lit("\n"))), "")
    read = read.select("conv_id", "example", "chars", "trained", F.size("turns").cast("long").alias("n_turns"), F.when(F.col("turns").isNotNull(), F.sha2(said.cast("binary"), 256)).alias("sha"))
    done = read.groupBy("conv_id").agg(
        F.max(F.when(F.col("sha").isNotNull(), F.col("n_turns"))).alias("n_turns"), F.max("sha").alias("turns_sha256"), F.sum("chars").alias("formatted_chars"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "trained"))), lambda x: x.trained), "").alias("loss"),
    )
    return done.select(
        "conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars",
    )
