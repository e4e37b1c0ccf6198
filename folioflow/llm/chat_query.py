"""Query op9 over all conversations, with its SQL."""

from pyspark.sql import functions as F

from .chat import ChatTemplate, chat_digests, format_chats
from .queries import query, table

_TEMPLATE = ChatTemplate()
_MARKED = "</s>[INST] ok [/INST]"
# Backslashes that escaping adds to x: one per control string, however many stand inside it already.
_ADDED = "(len(regexp_extract_all({x}, '<\\\\*(\\|im_start\\|>|\\|im_sep\\|>|\\|im_end\\|>|s>|/s>)')) + len(regexp_extract_all({x}, '\\[\\\\*(INST\\]|/INST\\])')))"

SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{_MARKED}' UNION ALL SELECT -7, 1, 'assistant', '{_MARKED}'
), steps AS (
  SELECT *, row_number() OVER w - 1 AS pos, lag(role) OVER w AS prev
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), judged AS (
  SELECT *, NOT coalesce(CASE WHEN prev IS NULL THEN role IN ('system', 'user')
    WHEN prev IN ('system', 'assistant') THEN role = 'user' WHEN prev = 'user' THEN role = 'assistant' ELSE false END, false) AS wrong
  FROM steps
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(32 + length(role) + length(text) + {_ADDED.format(x="role")} + {_ADDED.format(x="text")})::BIGINT AS formatted_chars,
  NOT bool_or(wrong) AND max_by(role, pos) IN ('user', 'assistant') AS valid,
  min(pos) FILTER (wrong) AS first_error
FROM judged GROUP BY conv_id
"""


@query("op9_chat_format", SQL)
def op9(spark, sf_dir):
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(_MARKED).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat_digests(format_chats(turns, _TEMPLATE), _TEMPLATE)
