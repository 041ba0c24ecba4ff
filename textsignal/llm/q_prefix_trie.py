"""Query op13 and its oracle."""

from pyspark.sql import DataFrame

from textsignal.llm.crc_sql import CTES, crc32
from textsignal.llm.prefix_trie import prefix_trie
from textsignal.llm.registry import Source, query

SQL = f"""
WITH RECURSIVE {CTES},
own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p,
         md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS t, length(coalesce(text, '')) AS chars
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
  SELECT conv_id, conv_id - conv_id % 100 AS first_id, cast({crc32("cast(conv_id AS VARCHAR)")} % 6 AS BIGINT) AS h
  FROM (SELECT DISTINCT conv_id FROM own), crc_table),
taken AS (SELECT i.conv_id, f.p, f.t, f.chars FROM ids AS i JOIN own AS f ON f.conv_id = i.first_id AND f.p <= i.h),
given AS (SELECT conv_id, max(p) AS g FROM taken GROUP BY conv_id),
turns AS (
  SELECT * FROM taken
  UNION ALL
  SELECT conv_id, coalesce(g, 0) + p - h, t, chars FROM own JOIN ids USING (conv_id) LEFT JOIN given USING (conv_id) WHERE p > h
  UNION ALL
  SELECT conv_id, 0, '', 0 FROM ids),
r AS (
  SELECT conv_id, p, chars, max(p) OVER (PARTITION BY conv_id) AS last,
         string_agg(t, ',') OVER (PARTITION BY conv_id ORDER BY p ROWS UNBOUNDED PRECEDING) AS path
  FROM turns),
nodes AS (
  SELECT path, any_value(p) AS depth, min(conv_id) AS conv_id, count(*) AS n, any_value(chars) AS chars,
         count(*) = count(*) FILTER (p = last) AS leaf,
         sha256(coalesce(string_agg(cast(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (p = last), '')) AS ends
  FROM r GROUP BY path),
above AS (
  SELECT a.path, n.depth - a.p AS up, n.path AS below, n.leaf, (n.n - 1) * n.chars AS saved
  FROM nodes AS n JOIN r AS a ON a.conv_id = n.conv_id AND a.p <= n.depth),
sums AS (
  SELECT path, count(*) FILTER (up = 1) AS n_children, count(*) FILTER (leaf) AS n_leaves, sum(saved) AS saved FROM above GROUP BY path)
SELECT n.conv_id, cast(n.depth AS BIGINT) AS depth, m.conv_id AS parent_conv_id, n.n AS n_convs, n_children, n_leaves,
       cast(s.saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
FROM nodes AS n JOIN sums AS s USING (path)
LEFT JOIN (SELECT below, path FROM above WHERE up = 1) AS u ON u.below = n.path
LEFT JOIN nodes AS m ON m.path = u.path
"""


@query("op13_prefix_trie", SQL)
def op13(t: Source) -> DataFrame:
    return prefix_trie(t("conversations").select("conv_id", "turn", "role", "text"))
