"""Pieces of DuckDB SQL that several oracles share."""

from __future__ import annotations

#: A CTE ``crc(crc_table)``: the 256 remainders of the reflected polynomial of crc32.
CRC_CTE = """crc AS MATERIALIZED (SELECT list(c ORDER BY i) AS crc_table FROM (
    WITH RECURSIVE r(i, k, c) AS (SELECT i, 0, i FROM range(256) t(i) UNION ALL
      SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM r WHERE k < 8)
    SELECT i, c FROM r WHERE k = 8))"""


def crc32(text: str) -> str:
    """Unsigned crc32 of the UTF-8 bytes of a VARCHAR expression, where ``crc_table`` is in scope."""
    byte = f"('0x' || substr(hex({text}), (2 * k + 1)::BIGINT, 2))::BIGINT"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(strlen({text})), lambda k: {byte})), "
            "lambda c, b: xor(crc_table[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)")


#: Lower-cases A-Z and nothing else.
def lower_ascii(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
