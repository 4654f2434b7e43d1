"""Chat formatting as a grammar round trip.

DataFrame functions only.  A conversation is rendered turn by turn as

    <|im_start|>role NEWLINE text <|im_end|> NEWLINE

and read again by a deterministic parser of this grammar.  The turns that the parser recovers are compared with the
source; content that does not come back identical (control strings inside a text, or what looks like an escape) is
escaped and the rendering tried again.  So an ordinary text stays as it is, and every output parses back to its
source.  An escape puts one more backslash between ``<`` and ``|``, behind those that stand there already, and the
parser takes one away, which is reversible for every text.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, NEWLINE, LINE_MARK = "<|im_start|>", "<|im_end|>", "\n", "<|nl|>"
TAIL = END + NEWLINE
LEARNED = "assistant"         # the role whose texts are under the loss mask


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(r"<(\\*)\|"), F.lit(r"<\\$1|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(r"<\\(\\*)\|"), F.lit(r"<$1|"))


def escaped_role(role: Column) -> Column:
    """As a text, and line ends (which would end the role) as a control string."""
    return F.replace(escaped(role), F.lit(NEWLINE), F.lit(LINE_MARK))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit(LINE_MARK), F.lit(NEWLINE)))


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit(NEWLINE), text, F.lit(TAIL))


def parsed(formatted: Column) -> Column:
    """The turns of a formatted text: array of (role, text, head, body), the last two as they stand in it.

    Null if the text is no sequence of turns.  It is cut at every start string; a piece is a role without a control
    string up to its first newline, a body up to its first end string, and nothing more."""
    pieces = F.split(formatted, r"<\|im_start\|>", -1)

    def cut(piece: Column) -> Column:
        role = F.substring_index(piece, NEWLINE, 1)
        rest = F.substr(piece, F.length(role) + 2)
        return F.struct(role.alias("role"), F.substring_index(rest, END, 1).alias("body"), rest.alias("rest"))

    def checked(x: Column) -> Column:
        good = ~F.contains(x["role"], F.lit(END)) & (x["rest"] == F.concat(x["body"], F.lit(TAIL)))
        return F.when(good, F.struct(unescaped_role(x["role"]).alias("role"), unescaped(x["body"]).alias("text"),
                                     F.concat(F.lit(START), x["role"], F.lit(NEWLINE)).alias("head"), x["body"].alias("body")))
    turns = F.transform(F.transform(F.slice(pieces, 2, F.size(pieces)), cut), checked)
    return F.when((F.element_at(pieces, 1) == "") & ~F.exists(turns, lambda x: x.isNull()), turns)


def source_of(turns: Column) -> Column:
    return F.transform(turns, lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))


def comes_back(formatted: Column, turns: Column) -> Column:
    return source_of(parsed(formatted)).eqNullSafe(source_of(turns))


def format_conversations(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row a conversation: conv_id, ``formatted`` and ``mask``, the loss mask over the code points of ``formatted`` as
    runs (chars, loss): of every turn its head, its body (under the mask if the assistant's) and its tail.

    Turns stand by turn number, null first, ties by role and text; repeated rows are repeated turns.  Null role or text:
    empty.  The rows of a null conversation id are one conversation.  An empty table gives no rows; other columns play
    no part.  A conversation is one row, so its formatted text has Spark's limit for a value of 2 GB.
    """
    rows = df.select(F.col(f"`{conv_id}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
                     *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((role, "role"), (text, "text"))])
    # a turn that does not come back from its own rendering is conflicting content
    own = F.array(F.struct("role", "text"))
    rows = rows.withColumn("clash", ~comes_back(rendered(F.col("role"), F.col("text")), own))
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "clash"))).alias("turns"))

    def whole(clash) -> Column:
        def one(x: Column) -> Column:
            return F.when(clash(x), rendered(escaped_role(x["role"]), escaped(x["text"]))).otherwise(rendered(x["role"], x["text"]))
        return F.array_join(F.transform("turns", one), "")
    # conflicting turns escaped; should the whole still not come back, every turn; and no output that does not
    first = turns.withColumn("formatted", whole(lambda x: x["clash"]))
    again = F.when(comes_back(F.col("formatted"), F.col("turns")), F.col("formatted")).otherwise(whole(lambda x: F.lit(True)))
    settled = first.withColumn("settled", again)
    good = F.when(comes_back(F.col("settled"), F.col("turns")), F.col("settled")).otherwise(
        F.raise_error(F.lit("a conversation does not parse back to its source")))
    done = settled.select("conv_id", good.alias("formatted"))

    def runs(x: Column) -> Column:
        def run(n: Column, loss: Column) -> Column:
            return F.struct(n.alias("chars"), loss.alias("loss"))
        return F.array(run(F.length(x["head"]), F.lit(False)), run(F.length(x["body"]), x["role"] == LEARNED),
                       run(F.lit(len(TAIL)), F.lit(False)))
    return done.withColumn("mask", F.flatten(F.transform(parsed(F.col("formatted")), runs)))


def read_back(formatted: DataFrame) -> DataFrame:
    """From ``formatted`` and ``mask``: ``turns`` (array of role, text) and ``loss_text``, the unescaped text under the
    mask.  A mask that does not fit its text raises an error."""
    def pieces(x: Column) -> Column:
        return F.array(x["head"], x["body"], F.lit(TAIL))

    def under(piece: Column, run: Column) -> Column:
        fits = F.length(piece).eqNullSafe(run["chars"])
        return F.when(~fits, F.raise_error(F.lit("mask and text differ")).cast("string")).when(run["loss"], unescaped(piece)).otherwise("")
    # three expressions read the parsed turns, so they are a column of their own
    read = formatted.withColumn("turns", parsed(F.col("formatted")))
    loss = F.array_join(F.zip_with(F.flatten(F.transform("turns", pieces)), "mask", under), "")
    return read.withColumn("loss_text", loss).withColumn("turns", source_of(F.col("turns")))
