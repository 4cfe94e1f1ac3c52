"""Chat formatting with prefix-target expansion, in DataFrame functions only.

A turn is rendered as ``<turn>role NEWLINE text</turn>``; a conversation is its turns' renderings in a row.
Control strings inside roles and texts are escaped: a backslash is doubled, ``<turn>`` becomes ``<\\turn>``,
``</turn>`` becomes ``<\\/turn>``, and a newline in a role becomes backslash + newline. So the markers occur
in a formatted conversation only where a turn starts or ends, and dropping each backslash's first
character gives the text back.

Every assistant turn becomes one training example: the context is the formatted conversation up to the
end of that turn's header, the target is that turn's escaped text with its end mark, and only the text of
the target is trainable. An example holds its spans; ``with_context`` adds the context as text.
Writing out every context is quadratic in the turns of a conversation, so nothing else does it.

Defined cases: null text or role is empty text; null ``turn`` sorts last; equal turns sort by role, then
text, repeated rows stay; a null ``conv_id`` is one conversation; a conversation without an assistant
turn has no example; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<turn>", "</turn>"
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit(OPEN), F.lit("<\\turn>"))
    return F.replace(text, F.lit(CLOSE), F.lit("<\\/turn>"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\\n"))


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, examples``.

    ``examples`` lists, in order, ``turn_no`` (from 0), ``context_chars`` (the context is that many leading
    characters of ``formatted``) and ``loss_end`` (the trainable text ends there; its end mark follows)."""
    t = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    t = t.withColumn("head", F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n"))) \
         .withColumn("body", escape(F.col("text"))) \
         .withColumn("piece", F.concat("head", "body", F.lit(CLOSE)))
    in_order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    upto = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = t.select(
        "conv_id", "role", "piece",
        (F.row_number().over(in_order) - 1).alias("turn_no"),
        F.char_length("head").alias("head_chars"),
        F.sum(F.char_length("piece").cast("long")).over(upto).alias("end"))
    example = F.struct(
        "turn_no", (F.col("end") - F.char_length("piece") + F.col("head_chars")).alias("context_chars"),
        (F.col("end") - len(CLOSE)).alias("loss_end"))
    return t.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn_no", "piece"))).alias("pieces"),
        F.sort_array(F.collect_list(F.when(F.col("role") == TRAINED_ROLE, example))).alias("examples"),
    ).select("conv_id", F.concat_ws("", F.col("pieces.piece")).alias("formatted"), "examples")


def _pieces() -> Column:
    split = F.split("formatted", CLOSE)
    return F.slice(split, 1, F.size(split) - 1)


def prefix_target_examples(formatted: DataFrame) -> DataFrame:
    """One row per assistant turn: ``conv_id, turn_no, context_chars, target, loss_chars``. ``target`` is what stands
    in the formatted conversation from the end of the context on, up to the end mark of the turn; its first
    ``loss_chars`` characters are trainable, its end mark and the whole context are not. It is null where the
    spans do not fit the text. The turns before an example are only counted, so the work is linear."""
    null = lambda kind: F.lit(None).cast(kind)
    turns = F.transform(_pieces(), lambda p, i: F.struct(
        i.alias("turn_no"), p.alias("piece"), null("long").alias("context_chars"), null("long").alias("loss_end")))
    examples = F.transform("examples", lambda e: F.struct(
        e.turn_no.alias("turn_no"), null("string").alias("piece"), e.context_chars.alias("context_chars"), e.loss_end.alias("loss_end")))
    upto = Window.partitionBy("conv_id").orderBy("turn_no", F.col("context_chars").asc_nulls_first()) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = formatted.select("conv_id", F.inline(F.concat(turns, examples))).select(
        "conv_id", "turn_no", "context_chars", (F.col("loss_end") - F.col("context_chars")).alias("loss_chars"),
        F.last("piece", ignorenulls=True).over(upto).alias("piece"),
        F.sum(F.char_length("piece").cast("long") + len(CLOSE)).over(upto).alias("end")).where("context_chars IS NOT NULL")
    head = F.col("context_chars") - (F.col("end") - len(CLOSE) - F.char_length("piece"))  # of the turn's piece
    fits = (head >= 0) & (head + F.col("loss_chars") == F.char_length("piece"))
    target = F.concat(F.substring("piece", head.cast("int") + 1, F.char_length("piece")), F.lit(CLOSE))
    return rows.select("conv_id", "turn_no", "context_chars", F.when(fits, target).alias("target"), "loss_chars")


def with_context(formatted: DataFrame) -> DataFrame:
    """Full example texts: ``conv_id, turn_no, context, target, loss_chars`` (quadratic in a conversation's turns)."""
    rows = formatted.select("conv_id", "formatted", F.explode("examples").alias("e"))
    return rows.select(
        "conv_id", F.col("e.turn_no").alias("turn_no"),
        F.expr("substring(formatted, 1, cast(e.context_chars AS int))").alias("context"),
        F.expr(f"substring(formatted, cast(e.context_chars AS int) + 1, "
               f"cast(e.loss_end - e.context_chars AS int) + {len(CLOSE)})").alias("target"),
        F.expr("e.loss_end - e.context_chars").alias("loss_chars"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digest of what the output holds: the turns parsed from each formatted conversation, joined with the
    trainable texts of its examples, one of each assistant turn (null where not all of those could be read)."""
    # role and text, each still escaped: the header ends at the first newline that is not escaped
    role = lambda p: F.regexp_extract(p, r"(?s)^<turn>((?:[^\\\n]|\\.)*)\n", 1)
    parsed = F.transform("pieces", lambda p: F.struct(
        unescape(role(p)).alias("role"),
        unescape(F.substring(p, F.char_length(role(p)) + len(OPEN) + 2, F.char_length(p))).alias("text")))
    turns = formatted.select("conv_id", "formatted", F.size("examples").alias("listed"), _pieces().alias("pieces")) \
                     .select("conv_id", "formatted", "listed", parsed.alias("turns"))
    shown = F.concat_ws("", F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))))
    turns = turns.select(
        "conv_id", "listed", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(shown.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))
    reply = unescape(F.substring(F.col("target"), F.lit(1), F.col("loss_chars").cast("int")))
    losses = prefix_target_examples(formatted).groupBy("conv_id") \
        .agg(F.sort_array(F.collect_list(F.struct("turn_no", reply.alias("reply")))).alias("replies"), F.count("target").alias("read")) \
        .select(F.col("conv_id").alias("_conv_id"), "read", F.concat_ws("", F.col("replies.reply")).alias("loss")) \
        .select("_conv_id", "read", F.char_length("loss").cast("long").alias("loss_chars"),
                F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"))
    whole = F.col("listed") == F.coalesce("read", F.lit(0))
    return turns.join(losses, F.col("conv_id").eqNullSafe(F.col("_conv_id")), "left").select(
        "conv_id", "n_turns", "turns_sha256", F.when(whole, F.coalesce("loss_chars", F.lit(0).cast("long"))).alias("loss_chars"),
        F.when(whole, F.coalesce("loss_sha256", F.sha2(F.lit("").cast("binary"), 256))).alias("loss_sha256"), "formatted_chars")
