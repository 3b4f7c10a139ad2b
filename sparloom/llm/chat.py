"""Chat formatting by prefix-target expansion, in DataFrame functions only.

A turn is written ``[INST role]``, a newline, the text, ``</s>``, a newline.
Inside texts (and roles) the control strings are escaped so that they cannot
occur, and every backslash too, so the escape is undone exactly:

    backslash -> \\b    [INST -> \\iINST    [/INST -> \\i/INST    </s> -> \\s/s>
    in roles also: ] -> \\c    newline -> \\n

Every assistant turn is exploded into an example of its own: its context is
everything before it, and only that reply is under the loss mask.  All examples
of a conversation are prefixes of one formatted text, so the table holds that
text once and each example as offsets, its target cut out by them: it grows with
the turns, not with their square.  ``examples`` writes the prefixes out where
that is wanted.  A conversation is one row, so it must fit in a task's memory.

Defined cases: null text or role is empty; turns are ordered by (turn, role,
text), null turns first, and repeated rows stay repeated; rows with a null
conv_id are one conversation; an empty table gives no rows; further columns are
not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as c

_TEXT = [("\\", "\\b"), ("[INST", "\\iINST"), ("[/INST", "\\i/INST"), ("</s>", "\\s/s>")]
_ROLE = [*_TEXT, ("]", "\\c"), ("\n", "\\n")]
_BACK = [("\\i", "["), ("\\s", "<"), ("\\c", "]"), ("\\n", "\n"), ("\\b", "\\")]
OPEN, HEAD, END = "[INST ", "]\n", "</s>\n"


def _replaced(x: Column, pairs) -> Column:
    for old, new in pairs:
        x = F.replace(x, F.lit(old), F.lit(new))
    return x


def escape(text: Column) -> Column:
    return _replaced(text, _TEXT)


def unescape(text: Column) -> Column:
    return _replaced(text, _BACK)


def format_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, formatted, examples [(turn from 0, target_start, target_end)]); offsets in characters."""
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    body = escape(text)
    head = F.concat(F.lit(OPEN), _replaced(role, _ROLE), F.lit(HEAD))
    turns = rows.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"),
        F.concat(head, body, F.lit(END)).alias("whole"), F.length(head).cast("long").alias("head_chars"), F.length(body).cast("long").alias("text_chars"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, -1)
    chars = F.col("head_chars") + F.col("text_chars") + len(END)
    placed = turns.select(
        "conv_id", "role", "whole", "head_chars", "text_chars",
        F.row_number().over(order).alias("number"), F.coalesce(F.sum(chars).over(so_far), F.lit(0)).alias("at"),
    )
    start = F.col("at") + F.col("head_chars")
    target = F.when(F.col("role") == "assistant", F.struct((F.col("number") - 1).alias("turn"), start.alias("target_start"), (start + F.col("text_chars")).alias("target_end")))
    gathered = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("number", "whole"))).alias("turns"), F.array_sort(F.collect_list(target)).alias("examples"))
    return gathered.select("conv_id", F.array_join(F.transform("turns", lambda t: t["whole"]), "").alias("formatted"), "examples")


def expanded(formatted: DataFrame, *keep: Column) -> DataFrame:
    """One row per assistant turn: (conv_id, turn, target_start, target_end, target) and what ``keep`` names.

    ``target`` is what stands under the loss mask, cut out of the formatted text by the
    offsets alone.  A conversation without assistant turns keeps one row of nulls.
    """
    cut = lambda e: F.substring("formatted", (e["target_start"] + 1).cast("int"), (e["target_end"] - e["target_start"]).cast("int"))
    spans = F.transform("examples", lambda e: F.struct(e["turn"].alias("turn"), e["target_start"].alias("target_start"), e["target_end"].alias("target_end"), cut(e).alias("target")))
    rows = formatted.select("conv_id", *keep, F.explode_outer(spans).alias("e"))
    return rows.select(*rows.columns[:-1], "e.*")


def examples(formatted: DataFrame) -> DataFrame:
    """Each example written out: (conv_id, turn, text, target_start, target_end), all preceding turns as context, the text ending with the reply."""
    rows = expanded(formatted, F.col("formatted")).where("turn is not null")
    return rows.select("conv_id", "turn", F.substring("formatted", F.lit(1), F.col("target_end").cast("int")).alias("text"), "target_start", "target_end")


def parsed(formatted: DataFrame) -> DataFrame:
    """The formatted text read back: adds turns [(role, text)], unescaped."""
    cut = F.split(F.col("formatted"), F.lit("</s>\n"), -1)
    cut = F.slice(cut, 1, F.size(cut) - 1)
    head = F.expr(f"length('{OPEN}') + 1")

    def turn(piece):
        end = F.instr(piece, HEAD)
        role = piece.substr(head, end - head)
        return F.struct(unescape(role).alias("role"), unescape(piece.substr(end + F.lit(len(HEAD)), F.length(piece))).alias("text"))

    return formatted.withColumn("turns", F.transform(cut, turn))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the formatted text says, and of what its examples' loss masks cover."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    whole = [F.size("turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"), F.length("formatted").cast("long").alias("formatted_chars")]
    rows = expanded(parsed(formatted), *whole).withColumn("target", unescape(F.col("target")))
    replies = F.array_sort(F.collect_list(F.when(F.col("turn").isNotNull(), F.struct("turn", "target"))))
    rows = rows.groupBy("conv_id", "n_turns", "turns_sha256", "formatted_chars").agg(F.array_join(F.transform(replies, lambda e: e["target"]), "").alias("loss"))
    return rows.select(
        "conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars",
    )


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = c.read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(own).alias("text"))
    return read_back(format_conversations(rows.unionByName(more)))


def _sql(column: str, pairs) -> str:
    for old, new in pairs:
        quote = lambda s: "'" + s.replace("'", "''") + "'" if "\n" not in s else "chr(10)"
        column = f"replace({column}, {quote(old)}, {quote(new)})"
    return column


ORACLE_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
  CAST(sum({len(OPEN) + len(HEAD) + len(END)} + length({_sql("role", _ROLE)}) + length({_sql("text", _TEXT)})) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""
