"""CRC-32 of ASCII strings as DuckDB SQL, for oracles; the table of bytes is computed by its rule."""

CTES = """
crc_steps AS (
  SELECT i, cast(i AS UBIGINT) AS c, 0 AS k FROM range(256) AS r(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, cast(3988292384 AS UBIGINT)) ELSE c >> 1 END, k + 1 FROM crc_steps WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS crc_of FROM crc_steps WHERE k = 8)"""


def crc32(text: str) -> str:
    """Expression over a row that also has ``crc_of`` (cross join with the one row of ``crc_table``)."""
    codes = f"list_transform(string_split({text}, ''), lambda x: cast(ascii(x) AS UBIGINT))"
    start = "cast(4294967295 AS UBIGINT)"
    return f"xor(list_reduce(list_prepend({start}, {codes}), lambda c, b: xor(c >> 8, crc_of[cast((xor(c, b) & 255) + 1 AS INT)])), {start})"
