"""Chat formatting with DataFrame expressions only.

Template: ``<|turn|>role<|text|>text<|end|>`` a turn; adjacent turns of one role share one block, whose
texts are set apart by ``<|part|>``. In roles and texts ``\\``, ``<`` and ``[`` are written ``\\s``,
``\\l`` and ``\\b``, so no control string, of this template or another, can appear inside a text, and
undoing the escapes in the order l, b, s gives back exactly what went in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lanefold.llm._common import load

TURN, TEXT, PART, END = "<|turn|>", "<|text|>", "<|part|>", "<|end|>"


def escape(c: Column) -> Column:
    for a, b in (("\\", "\\s"), ("<", "\\l"), ("[", "\\b")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def unescape(c: Column) -> Column:
    for a, b in (("<", "\\l"), ("[", "\\b"), ("\\", "\\s")):
        c = F.replace(c, F.lit(b), F.lit(a))
    return c


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", loss_role: str = "assistant") -> DataFrame:
    """conv_id, formatted (string) and loss_spans (start from 1 and length, in characters of ``formatted``).

    One row a conversation, a null conv_id being one of its own. Turns go by ``turn`` (null first), ties
    by role and text; repeated rows are repeated turns. A null role or text is empty. A span covers one
    text of ``loss_role`` without markers. An empty table gives an empty table; other columns are
    ignored, whatever their names. The turns of one conversation meet in one task, since its string is
    one value; conversations are spread by their identifier.
    """
    rows = turns.select(
        F.col(conv).alias("c"),
        F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")).alias("t"),
    )
    # Structs sort as (turn, role, text), nulls first. A change of the role begins a block. All windows and groups below
    # hold the conversation, so rows are shuffled once.
    w = Window.partitionBy("c").orderBy("t")
    new = F.coalesce(F.lag("t.role").over(w) != F.col("t.role"), F.lit(True)).cast("int")
    rows = rows.select("c", "t", F.row_number().over(w).alias("n"), new.alias("new"), F.length(escape(F.col("t.text"))).alias("size"))
    up_to = Window.partitionBy("c").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("block", F.sum("new").over(up_to))
    inside = Window.partitionBy("c", "block").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("at", F.coalesce(F.sum(F.col("size") + len(PART)).over(inside), F.lit(0)))
    # Adjacent turns of a role are merged: their structs are collected and sorted, and their texts joined.
    blocks = rows.groupBy("c", "block").agg(F.array_sort(F.collect_list(F.struct("n", "t", "at", "size"))).alias("turns"))
    said = F.get("turns", F.lit(0))["t"]["role"]
    head = F.concat(F.lit(TURN), escape(said), F.lit(TEXT))
    body = F.array_join(F.transform("turns", lambda x: escape(x["t"]["text"])), PART)
    blocks = blocks.select("c", "block", "turns", said.alias("said"), F.length(head).alias("lead"), F.concat(head, body, F.lit(END)).alias("string"))
    before = F.coalesce(F.sum(F.length("string")).over(Window.partitionBy("c").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.withColumn("first", before + F.col("lead") + 1)
    spans = F.when(F.col("said") == loss_role, F.transform("turns", lambda x: F.struct((F.col("first") + x["at"]).cast("int").alias("start"), x["size"].cast("int").alias("length"))))
    spans = F.coalesce(spans, F.array().cast("array<struct<start:int,length:int>>"))
    packed = blocks.groupBy("c").agg(F.array_sort(F.collect_list(F.struct("block", "string", spans.alias("spans")))).alias("all"))
    return packed.select(F.col("c").alias(conv), F.array_join(F.col("all")["string"], "").alias("formatted"), F.flatten(F.col("all")["spans"]).alias("loss_spans"))


def read_chats(chats: DataFrame, conv: str = "conv_id") -> DataFrame:
    """conv_id, turns (array of role and text) and loss_texts (array), read back from the formatted strings."""
    blocks = F.slice(F.split("formatted", r"<\|turn\|>", -1), F.lit(2), F.greatest(F.size(F.split("formatted", r"<\|turn\|>", -1)) - 1, F.lit(0)))

    def parts(b: Column) -> Column:
        role = unescape(F.substring_index(b, TEXT, 1))
        body = F.substr(b, F.length(F.substring_index(b, TEXT, 1)) + len(TEXT) + 1)
        body = F.left(body, F.length(body) - len(END))
        return F.transform(F.split(body, r"<\|part\|>", -1), lambda p: F.struct(role.alias("role"), unescape(p).alias("text")))

    turns = F.flatten(F.transform(blocks, parts))
    loss = F.transform("loss_spans", lambda s: unescape(F.substr(F.col("formatted"), s["start"], s["length"])))
    return chats.select(conv, turns.alias("turns"), loss.alias("loss_texts"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formats all conversations and conversation -7, and describes what reading the strings back gives."""
    rows = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    chats = format_chats(rows.unionByName(more))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    back = read_chats(chats.withColumn("conv_id", F.struct("conv_id", F.length("formatted").alias("formatted_chars"))))
    return back.select(
        F.col("conv_id.conv_id").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), F.col("conv_id.formatted_chars").cast("long").alias("formatted_chars"),
    )


_ESC = "replace(replace(replace(coalesce({c}, ''), '\\', '\\s'), '<', '\\l'), '[', '\\b')"
OP3_SQL = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), seen AS (
  SELECT *, lag(role) OVER w AS before, lead(role) OVER w AS after
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length({_ESC.format(c="text")})
      + CASE WHEN before = role THEN 8 ELSE 16 + length({_ESC.format(c="role")}) END
      + CASE WHEN after = role THEN 0 ELSE 7 END)::BIGINT AS formatted_chars
FROM seen GROUP BY conv_id
"""
