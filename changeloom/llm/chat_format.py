"""Chat formatting by perspective rotation.

For every participant of a conversation the dialogue is rendered once more with that speaker as
assistant, all others as users of that name, and system turns as they are. A rendered dialogue is
kept turn by turn: the rendered text, where it starts and ends in the whole (characters), where its
content starts, and whether it is trained on (``masked_in``: the perspective's own turns). Joined in the
order of ``position``, the turns are the dialogue.

Turns are ordered by turn, role and text; a turn row that is repeated as it is counts once. Running
sums are taken inside chunks of ``CHUNK`` turn numbers and chunks are joined by their sums, so that one
very long conversation is not one task's work. A conversation's participants are its different speakers;
its output is turns times speakers.

Defined results: a null text is empty; a null role is the speaker ``unknown``; a null turn comes first; rows
without a conversation id form the conversation of that id (null); a conversation of system turns alone
has no perspective and no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 256
SYSTEM = "system"
UNNAMED = "unknown"
#: what stands around a turn: head, name part of users, separator of head and content, tail
HEAD, NAME, BODY, TAIL = "<|", " name=", "|>\n", "\n"


def _chunk(turn: Column) -> Column:
    return F.floor(F.coalesce(turn, F.lit(-1)) / CHUNK)


def rotate(
    df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row for each perspective and turn; see the module."""
    turns = (
        df.select(
            F.col(f"`{id_col}`").alias("id"),
            F.col(f"`{turn_col}`").cast("bigint").alias("turn"),
            F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit(UNNAMED)).alias("role"),
            F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
        )
        .distinct()
        .withColumn("chunk", _chunk(F.col("turn")))
    )
    speakers = turns.where(F.col("role") != SYSTEM).select(F.col("id").alias("of"), F.col("role").alias("perspective")).distinct()
    seen = turns.join(speakers, turns.id.eqNullSafe(speakers.of)).drop("of")
    own = F.col("role") == F.col("perspective")
    head = (
        F.when(F.col("role") == SYSTEM, F.lit(SYSTEM))
        .when(own, F.lit("assistant"))
        .otherwise(F.concat(F.lit("user" + NAME), F.col("role")))
    )
    opened = F.concat(F.lit(HEAD), head, F.lit(BODY))
    rendered = seen.withColumn("rendered", F.concat(opened, F.col("text"), F.lit(TAIL))).withColumn(
        "opening", F.length(opened)
    )
    key = ["id", "perspective"]
    sums = rendered.groupBy(*key, "chunk").agg(F.sum(F.length("rendered")).alias("chars"), F.count("*").alias("n"))
    earlier = Window.partitionBy(*key).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(
        *[F.col(c).alias(f"k_{c}") for c in (*key, "chunk")],
        F.coalesce(F.sum("chars").over(earlier), F.lit(0)).alias("chars_before"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_before"),
    )
    inside = Window.partitionBy(*key, "chunk").orderBy(F.asc_nulls_first("turn"), "role", "text")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    placed = rendered.select(
        "*", F.row_number().over(inside).alias("nth"), F.sum(F.length("rendered")).over(upto).alias("chars_upto")
    )
    same = [placed[c].eqNullSafe(before[f"k_{c}"]) for c in (*key, "chunk")]
    joined = placed.join(before, same)
    end = F.col("chars_before") + F.col("chars_upto")
    start = end - F.length("rendered")
    return joined.select(
        F.col("id").alias(id_col),
        "perspective",
        (F.col("n_before") + F.col("nth") - 1).alias("position"),
        F.col("turn").alias(turn_col),
        F.col("role").alias(role_col),
        "rendered",
        start.alias("start"),
        (start + F.col("opening")).alias("content_start"),
        end.alias("end"),
        own.alias("masked_in"),
    )


SQL = f"""
WITH t AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '{UNNAMED}') AS role, coalesce(text, '') AS text FROM conversations
), s AS (
  SELECT DISTINCT conv_id AS of, role AS perspective FROM t WHERE role <> '{SYSTEM}'
), r AS (
  SELECT conv_id, perspective, turn, role, text,
         '{HEAD}' || CASE WHEN role = '{SYSTEM}' THEN role WHEN role = perspective THEN 'assistant' ELSE 'user{NAME}' || role END || '|>' || chr(10) AS opened
  FROM t JOIN s ON t.conv_id IS NOT DISTINCT FROM s.of
), w AS (
  SELECT *, opened || text || chr(10) AS rendered FROM r
), o AS (
  SELECT *, sum(length(rendered)) OVER (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING) AS stop,
         row_number() OVER (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, role, text) - 1 AS position
  FROM w
)
SELECT conv_id, perspective, position, turn, role, rendered, CAST(stop - length(rendered) AS BIGINT) AS start,
       CAST(stop - length(rendered) + length(opened) AS BIGINT) AS content_start, CAST(stop AS BIGINT) AS "end",
       role = perspective AS masked_in
FROM o"""
