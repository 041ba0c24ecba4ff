"""Query op11 and its oracle."""

from pyspark.sql import DataFrame, functions as F

from textsignal.llm.line_dedup import drop_common_lines
from textsignal.llm.registry import Source, query

KEY = r"""translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""

SQL = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS place FROM documents),
k AS (SELECT *, {KEY} AS key FROM l),
common AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (common.key IS NOT NULL) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (common.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN common ON k.key = common.key GROUP BY doc_id
"""


@query("op11_line_dedup", SQL)
def op11(t: Source) -> DataFrame:
    found = drop_common_lines(t("documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
