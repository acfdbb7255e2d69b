r"""Chat formatting in DataFrame expressions: one formatted string per conversation, with its loss mask.

Turns are collected as structs, sorted, cut into blocks of adjacent turns with one role, and joined:

    <|turn|>ROLE<|text|>TEXT<|next|>TEXT<|end|>\n

``<|next|>`` keeps the turns of a merged block apart. Inside roles and texts every backslash is doubled and a
backslash is put behind the first character of each control string (the template's own ``<|`` and those of
common chat templates), so that no text can pose as markup; dropping one backslash before any character
undoes both. ``segments`` holds the formatted string in pieces, each marked as trained on or not: the loss mask.

Cases: a null text or role is empty; a null turn number sorts first; turns with one number sort by role, then
text; repeated rows are turns of their own; a null conv_id is a conversation; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from domus.llm.common import table

#: Control strings that are broken up inside texts.
CONTROLS = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
TURN, TEXT, NEXT, END = "<|turn|>", "<|text|>", "<|next|>", "<|end|>\n"


def escape(text: Column) -> Column:
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    for c in CONTROLS:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_chats(turns: DataFrame, trained: str = "assistant") -> DataFrame:
    """conv_id, formatted (string), segments (array of text and loss: the formatted string in pieces)."""
    turn = F.struct(F.col("turn").cast("long").alias("turn"), escape(F.col("role")).alias("role"),
                    escape(F.col("text")).alias("text"))
    chats = turns.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(
        F.array_sort(F.collect_list(turn)).alias("turns"))
    n = F.size("turns")
    starts = F.filter(F.sequence(F.lit(1), n), lambda i: (i == 1) | (
        F.element_at("turns", i)["role"] != F.element_at("turns", F.greatest(i - 1, F.lit(1)))["role"]))
    chats = chats.withColumn("starts", starts)
    blocks = F.transform("starts", lambda s, k: F.slice(
        "turns", s, F.coalesce(F.get("starts", k + 1), n + 1) - s))
    chats = chats.withColumn("blocks", blocks)
    segments = F.flatten(F.transform("blocks", lambda b: F.concat(
        F.array(F.struct(F.concat(F.lit(TURN), b[0]["role"], F.lit(TEXT)).alias("text"), F.lit(False).alias("loss"))),
        F.flatten(F.transform(b, lambda t, i: F.array(
            F.struct(F.when(i > 0, F.lit(NEXT)).otherwise("").alias("text"), F.lit(False).alias("loss")),
            F.struct(t["text"].alias("text"), (t["role"] == trained).alias("loss"))))),
        F.array(F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss"))))))
    chats = chats.select("conv_id", segments.alias("segments"))
    return chats.select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
                        "segments")


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) read back from a formatted string."""
    blocks = F.filter(F.split(formatted, r"<\|end\|>\n"), lambda b: b != "")

    def turns(block):
        halves = F.split(block, r"<\|text\|>")
        role = unescape(F.substr(halves[0], F.lit(len(TURN) + 1)))
        return F.transform(F.split(halves[1], r"<\|next\|>"),
                           lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format all conversations (and conversation -7, whose texts hold control strings) and read them back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit("</s>[INST] ok [/INST]").alias("text"))
    chats = format_chats(turns.unionByName(probe))
    chats = chats.withColumn("back", read_turns(F.col("formatted")))
    said = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = unescape(F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: s["text"]), ""))
    chats = chats.select("conv_id", F.size("back").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                         loss.alias("loss"), F.char_length("formatted").cast("long").alias("formatted_chars"))
    return chats.select("conv_id", "n_turns", "turns_sha256", F.char_length("loss").cast("long").alias("loss_chars"),
                        F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


def _sql_escape(x: str) -> str:
    out = f"replace(coalesce({x}, ''), '\\', '\\\\')"
    for c in CONTROLS:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


OP7_SQL = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
           UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, {_sql_escape('role')} AS erole, {_sql_escape('text')} AS etext FROM t),
o AS (SELECT *, lag(role) OVER w AS before_role, row_number() OVER w AS rn FROM e
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, erole, etext)),
g AS (SELECT *, CASE WHEN rn = 1 OR before_role <> role THEN 1 ELSE 0 END AS opens FROM o)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY rn)) AS turns_sha256,
       CAST(length(coalesce(string_agg(text, '' ORDER BY rn) FILTER (WHERE role = 'assistant'), '')) AS BIGINT)
         AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY rn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(etext) + CASE WHEN opens = 1 THEN {len(TURN) + len(TEXT) + len(END)} + length(erole)
                ELSE {len(NEXT)} END) AS BIGINT) AS formatted_chars
FROM g GROUP BY conv_id
"""
