"""Query op10 and its oracle."""

from pyspark.sql import DataFrame, functions as F

from textsignal.llm.decontaminate import decontaminate
from textsignal.llm.registry import Source, query

WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

SQL = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
i AS (SELECT item_id, {WORDS} AS w FROM benchmark),
iw AS (
  SELECT DISTINCT cast(item_id AS VARCHAR) AS item, least(10, len(w)) AS n,
         array_to_string(w[s : s + least(10, len(w)) - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, s, n, array_to_string(w[s : s + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM iw))),
hits AS (SELECT doc_id, s, n, item FROM dw JOIN iw USING (n, g)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY 1),
items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY 1)
SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, cast(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       cast(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op10_wu_manber", SQL)
def op10(t: Source) -> DataFrame:
    found = decontaminate(t("documents").select("doc_id", "text"), t("benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
