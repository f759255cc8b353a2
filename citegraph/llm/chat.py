r"""Chat formatting by prefix-target expansion, in DataFrame operations only.

A conversation is written once, its turns in order as ``### role: text</turn>\n``. Every
assistant turn becomes an example of its own: all that precedes it is context, and only
its reply is under the loss mask. ``example_texts`` explodes these examples, each with its
whole prompt, and ``rest``, what follows the last reply; everything that is read back comes
from these rows. An example is a prefix of the formatted conversation, so its place in it
is kept as a range until then: one row of a conversation makes its examples one after the
other and a task holds one prompt at a time. The texts of all prompts together grow with the
square of a conversation's turns, as the method has it.

Control strings inside texts are escaped reversibly: ``\`` as ``\b``, ``###`` as ``\h``
and ``</turn>`` as ``\t`` (in roles also ``:`` as ``\c``). Every backslash of an escaped
text starts one of these codes, so undoing them in the opposite order gives the text back.

Defined results: null texts and roles count as empty; rows of a null id form one
conversation; turns go by ``turn`` (null first), ties by role, then text; repeated rows
are turns of their own; a conversation without an assistant turn has no examples; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

OPEN, CLOSE = "### ", "</turn>\n"
ASSISTANT = "assistant"
CODES = (("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\t"))
ROLE_CODES = (*CODES, (":", "\\c"))


def escape(text: Column, codes: tuple = CODES) -> Column:
    for plain, code in codes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column, codes: tuple = CODES) -> Column:
    for plain, code in reversed(codes):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def format_conversations(turns: DataFrame, trained: str = ASSISTANT) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted`` and ``examples``.

    ``examples`` lists, per turn of the role ``trained``: ``turn_no`` (from 0),
    ``context_chars`` (code points before the reply) and ``reply_chars``, both over
    ``formatted``. One shuffle by conversation serves the running offsets and the grouping.
    """
    role, text = F.coalesce(turns["role"], F.lit("")), F.coalesce(turns["text"], F.lit(""))
    rows = turns.select(turns["conv_id"].alias("conv_id"), turns["turn"].alias("turn"), role.alias("role"), text.alias("text"))
    head = F.concat(F.lit(OPEN), escape(F.col("role"), ROLE_CODES), F.lit(": "))
    rows = rows.withColumns({"head": head, "body": escape(F.col("text"))})
    rows = rows.withColumn("piece", F.concat("head", "body", F.lit(CLOSE)))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = F.sum(F.length("piece")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumns({"turn_no": F.row_number().over(order) - 1, "before": F.coalesce(before, F.lit(0))})
    example = F.when(
        F.col("role") == trained,
        F.struct(
            F.col("turn_no"),
            (F.col("before") + F.length("head")).alias("context_chars"),
            F.length("body").cast("bigint").alias("reply_chars"),
        ),
    )
    pieces = F.sort_array(F.collect_list(F.struct("turn_no", "piece")))
    return rows.groupBy("conv_id").agg(
        F.array_join(F.transform(pieces, lambda p: p["piece"]), "").alias("formatted"),
        F.sort_array(F.collect_list(example)).alias("examples"),
    )


def example_texts(formatted: DataFrame) -> DataFrame:
    """One row per example: ``conv_id, turn_no, prompt, reply, rest``, still escaped as in ``formatted``.

    ``rest`` is what follows the last reply of the conversation, the same in each of its
    rows. A conversation without an example has one row, of its ``rest`` alone.
    """
    last = F.try_element_at("examples", F.lit(-1))
    said = F.coalesce(last["context_chars"] + last["reply_chars"], F.lit(0))
    rows = formatted.select("conv_id", "formatted", (said + 1).cast("int").alias("end"), F.inline_outer("examples"))
    return rows.select(
        "conv_id",
        "turn_no",
        F.substr("formatted", F.lit(1), F.col("context_chars").cast("int")).alias("prompt"),
        F.substr("formatted", (F.col("context_chars") + 1).cast("int"), F.col("reply_chars").cast("int")).alias("reply"),
        F.substr("formatted", F.col("end")).alias("rest"),
    )


def read_turns(formatted: Column) -> Column:
    """Array of ``struct<role, text>`` read back from a formatted conversation."""
    pieces = F.split(formatted, CLOSE)

    def turn(piece: Column) -> Column:
        at = F.instr(piece, F.lit(": "))
        return F.struct(
            unescape(F.substr(piece, F.lit(len(OPEN) + 1), at - len(OPEN) - 1), ROLE_CODES).alias("role"),
            unescape(F.substr(piece, at + 2)).alias("text"),
        )

    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), turn)


def conversation_digests(examples: DataFrame) -> DataFrame:
    """Counts and digests of what can be read back from the rows of ``example_texts``.

    The last example and the rest give the conversation, the replies of all what is
    trained. The rows of a conversation are still where it was written, so nothing moves.
    """
    reply = F.when(F.col("turn_no").isNotNull(), F.struct("turn_no", unescape(F.col("reply")).alias("reply")))
    read = examples.groupBy("conv_id").agg(
        F.max(F.struct("turn_no", "prompt", "reply")).alias("last"),
        F.first("rest").alias("rest"),
        F.sort_array(F.collect_list(reply)).alias("replies"),
    )
    whole = F.concat(F.coalesce("last.prompt", F.lit("")), F.coalesce("last.reply", F.lit("")), "rest")
    read = read.withColumn("formatted", whole)
    read = read.withColumns({"turns": read_turns(F.col("formatted")), "trained": F.array_join("replies.reply", "")})
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(said.cast(T.BinaryType()), 256).alias("turns_sha256"),
        F.length("trained").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("trained").cast(T.BinaryType()), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        F.size("replies").cast("bigint").alias("n_examples"),
    )
