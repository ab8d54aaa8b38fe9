"""Pieces of DuckDB SQL that the operators' oracles share."""

from __future__ import annotations

#: Lower case of A-Z only.
LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def crc32_ctes(strings: str, column: str) -> str:
    """CTEs (for WITH RECURSIVE) that end in ``crc32(s, crc)``: the unsigned
    CRC-32 of the UTF-8 bytes of every distinct ``column`` of ``strings``.

    The CRC is linear, so it is the xor of what each byte gives at its
    distance from the end (``crc_far``) and of what the start value gives
    (``crc_start``), both built from the reflected polynomial."""
    return f"""
crc_round(n, i, v) AS (
    SELECT range, 0, range FROM range(256)
    UNION ALL
    SELECT n, i + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM crc_round WHERE i < 8
),
crc_table AS MATERIALIZED (SELECT n, v FROM crc_round WHERE i = 8),
crc_hex AS MATERIALIZED (
    SELECT s, h, length(h) // 2 AS len, row_number() OVER () AS id
    FROM (SELECT s, hex(encode(s)) AS h FROM (SELECT DISTINCT {column} AS s FROM {strings}))
),
crc_far(d, n, v) AS (
    SELECT 0::BIGINT, n, v FROM crc_table
    UNION ALL
    SELECT f.d + 1, f.n, xor(t.v, f.v >> 8) FROM crc_far f JOIN crc_table t ON t.n = f.v & 255 WHERE f.d + 1 < (SELECT max(len) FROM crc_hex)
),
crc_start(len, v) AS (
    SELECT 0::BIGINT, 4294967295
    UNION ALL
    SELECT c.len + 1, xor(t.v, c.v >> 8) FROM crc_start c JOIN crc_table t ON t.n = c.v & 255 WHERE c.len < (SELECT max(len) FROM crc_hex)
),
crc_bytes AS (
    SELECT id, len - 1 - i AS d, (instr('0123456789ABCDEF', substr(h, 2 * i + 1, 1)) - 1) * 16 + instr('0123456789ABCDEF', substr(h, 2 * i + 2, 1)) - 1 AS n
    FROM crc_hex, unnest(range(len)) AS u(i)
),
crc_parts AS (SELECT id, bit_xor(v) AS v FROM crc_bytes JOIN crc_far USING (d, n) GROUP BY id),
crc32 AS MATERIALIZED (
    SELECT h.s, xor(xor(coalesce(p.v, 0), c.v), 4294967295) AS crc
    FROM crc_hex h LEFT JOIN crc_parts p USING (id) JOIN crc_start c ON c.len = h.len
)"""
