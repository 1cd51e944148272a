"""Chat formatting with a grammar round trip.

Grammar (fixed strings)::

    conversation = "<s>" turn*
    turn         = "[INST]" role "[/INST]" text "</s>"

A conversation is first rendered as it stands, the rendering is parsed again and
the recovered turns are compared with the source.  Where they differ, or where a
recovered role or text still contains a control string (a lone ``[INST]`` reparses as
it was, but other readers take it for a turn mark), the control strings are escaped
and the result is parsed and compared once more.  Escaping puts one backslash before the last part of every
control string (and of every already escaped one), reading removes one, so the pair
is a bijection on all texts and the second comparison holds for every input; the
outcome is still reported per conversation in ``identical``.

Only built-in DataFrame functions run here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinerank.llm.common import text_of

BOS, OPEN, CLOSE, EOS = "<s>", "[INST]", "[/INST]", "</s>"
CONTROL = r"(</?|\[/?)(\\*)(s>|INST\])"            # any control string, with any number of backslashes
ESCAPED = r"(</?|\[/?)\\(\\*)(s>|INST\])"          # one with at least one backslash
TURN = r"(?s)^\[INST\](.*?)\[/INST\](.*)$"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, CONTROL, r"$1$2\\$3")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, ESCAPED, "$1$2$3")


def holds_control(turns: Column) -> Column:
    """Whether any role or text of the turns contains a control string, escaped or not."""
    return F.exists(turns, lambda t: t["role"].rlike(CONTROL) | t["text"].rlike(CONTROL))


def render(turns: Column) -> Column:
    """Text of an array of (role, text) structs, as they stand."""
    return F.concat(F.lit(BOS), F.array_join(F.transform(
        turns, lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(CLOSE), t["text"], F.lit(EOS))), ""))


def parse(formatted: Column) -> Column:
    """Array of (role, text) structs read back from a rendering.  Deterministic:
    the text after ``<s>`` is cut at every ``</s>``; each piece is one turn."""
    pieces = F.split(F.substring(formatted, F.lit(len(BOS) + 1), F.length(formatted)), EOS, -1)
    turns = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    return F.transform(turns, lambda p: F.struct(
        unescape(F.regexp_extract(p, TURN, 1)).alias("role"),
        unescape(F.regexp_extract(p, TURN, 2)).alias("text")))


def loss_spans(turns: Column, role: str = "assistant") -> Column:
    """(start, end) code-point spans, end exclusive, of one role's texts inside the
    rendering of ``turns`` (already escaped)."""
    head = len(OPEN) + len(CLOSE)
    zero = F.struct(F.lit(len(BOS)).cast("long").alias("at"),
                    F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        start = acc["at"] + head + F.length(t["role"])
        end = start + F.length(t["text"])
        own = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct((end + len(EOS)).alias("at"),
                        F.when(t["role"] == role, F.concat(acc["spans"], own)).otherwise(acc["spans"]).alias("spans"))
    return F.aggregate(turns, zero, step, lambda a: a["spans"])


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the spans, unescaped, joined with nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv id, ``formatted``, ``loss_spans``, ``parsed``
    (turns read back from ``formatted``), ``escaped`` and ``identical``.

    * Turns are ordered by turn number (null first), then role, then text, so repeated
      turn numbers and repeated rows have a defined order and all are kept.
    * Null role or text counts as empty; rows with a null conversation id form one
      conversation.  An empty table gives no rows; other columns are ignored.
    * A conversation is the unit of the output, so its turns meet in one row; nothing
      wider than a conversation ever does."""
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.struct(
        F.col(turn_col).alias("turn"), text_of(role_col).alias("role"), text_of(text_col).alias("text")).alias("t"))
    convs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    source = convs.select("conv_id", F.transform("ts", lambda t: F.struct(
        t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))
    plain = source.withColumn("plain", render(F.col("turns")))
    # where the reparse is equal the recovered turns are the source's, so those are searched
    tried = plain.withColumn("escaped", ~(parse(F.col("plain")).eqNullSafe(F.col("turns"))) | holds_control(F.col("turns")))
    safe = F.transform("turns", lambda t: F.struct(escape(t["role"]).alias("role"), escape(t["text"]).alias("text")))
    written = (tried.withColumn("shown", F.when(F.col("escaped"), safe).otherwise(F.col("turns")))
               .withColumn("formatted", F.when(F.col("escaped"), render(F.col("shown"))).otherwise(F.col("plain"))))
    spanned = written.withColumn("loss_spans", loss_spans(F.col("shown"), loss_role)).withColumn(
        "parsed", parse(F.col("formatted")))
    return spanned.select(F.col("conv_id").alias(conv_col), "formatted", "loss_spans", "parsed", "escaped",
                          F.col("parsed").eqNullSafe(F.col("turns")).alias("identical"))
