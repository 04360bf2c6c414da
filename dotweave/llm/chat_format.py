"""Chat formatting with Spark expressions only: no Python runs on the executors.

A conversation becomes one string. Turns are sorted, adjacent turns of one role
share a block, and each block opens with its role::

    <|turn|>user<|text|>hi<|next|>still me<|end|><|turn|>assistant<|text|>hello<|end|>

Control strings inside roles and texts (those above and the common ones of other
templates) are escaped reversibly: every backslash doubles, and a control string
gets one backslash after its first character. An escaped text therefore never
holds a marker, and :func:`unescape` restores it byte for byte.

Long conversations: turns are first gathered by (conversation, turn range), and
only those sorted runs meet in the conversation's row, so the group of a hot
conversation is dealt over many tasks and its row count falls by the range size
before the last shuffle. One output row still holds one whole conversation.

Defined cases: null text or role counts as empty; turns of equal number are
ordered by role, then text, and repeated rows stay; a null turn number sorts
first; a null conversation id is a conversation of its own; an empty table gives
no rows; further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

# The markers of the template.
TURN, TEXT, NEXT, END = "<|turn|>", "<|text|>", "<|next|>", "<|end|>"
#: What may not appear unescaped in a text: ours and the usual ones of other templates.
CONTROL = r"<(?=\||/?s>|/?SYS>)|\[(?=/?INST\])"
#: Turn numbers of one pre-aggregated run.
RUN = 64
#: The conversation that the contract adds.
PLANTED = "</s>[INST] ok [/INST]"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, f"({CONTROL})", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def format_chats(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", trained_role: str = "assistant", run: int = RUN
) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, segments``.

    ``segments`` is an array of (text, loss) whose texts concatenate to ``formatted``;
    loss is true for exactly the escaped texts of ``trained_role``.
    """
    rows = turns.select(
        F.col(f"`{conv}`").alias("conv_id"),
        F.col(f"`{turn}`").cast("bigint").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )
    runs = rows.groupBy("conv_id", F.floor(F.col("turn") / run).alias("run")).agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    whole = runs.groupBy("conv_id").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("run", "turns"))), lambda r: r["turns"])).alias("turns"))

    def piece(t: Column, i: Column) -> Column:
        before = F.get("turns", i - 1)["role"]
        after = F.get("turns", i + 1)["role"]
        opening = F.when(before == t["role"], F.lit(NEXT)).otherwise(F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT)))
        closing = F.when(after == t["role"], F.lit("")).otherwise(F.lit(END))
        return F.array(
            F.struct(opening.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(t["text"]).alias("text"), (t["role"] == trained_role).alias("loss")),
            F.struct(closing.alias("text"), F.lit(False).alias("loss")),
        )

    cutup = whole.select("conv_id", F.filter(F.flatten(F.transform("turns", piece)), lambda s: (s["text"] != "") | s["loss"]).alias("segments"))
    return cutup.select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def parse_chats(formatted: DataFrame, column: str = "formatted") -> DataFrame:
    """The inverse: adds ``turns``, an array of (role, text), read from the formatted string alone."""
    blocks = F.slice(F.split(F.col(column), r"<\|turn\|>"), 2, 2_000_000_000)

    def block(b: Column) -> Column:
        parts = F.split(b, r"<\|text\|>", 2)
        body = F.regexp_replace(F.get(parts, F.lit(1)), r"<\|end\|>$", "")
        return F.transform(F.split(body, r"<\|next\|>"), lambda t: F.struct(unescape(F.get(parts, F.lit(0))).alias("role"), unescape(t).alias("text")))

    return formatted.withColumn("turns", F.flatten(F.transform(blocks, block)))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PLANTED).alias("text")
    )
    read = parse_chats(format_chats(rows.unionByName(extra)))
    trained = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length(trained).cast("bigint").alias("loss_chars"),
        F.sha2(trained, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


QUERIES = {"op10_chat_formatting": op10_chat_formatting}

SQL = {
    "op10_chat_formatting": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, length(replace(text, '\', '\\')) + len(regexp_extract_all(text, '<\||</?s>|</?SYS>|\[/?INST\]')) AS text_len,
    length(replace(role, '\', '\\')) + len(regexp_extract_all(role, '<\||</?s>|</?SYS>|\[/?INST\]')) AS role_len,
    lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before
  FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(text_len + CASE WHEN before = role THEN 8 ELSE 8 + role_len + 8 + 7 END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""
}
