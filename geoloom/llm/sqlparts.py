"""Pieces of DuckDB SQL that several oracles share."""

from __future__ import annotations


def _crc_step(c: int) -> int:
    for _ in range(8):
        c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
    return c


#: The table of CRC-32, from its polynomial.
_TABLE = "([" + ", ".join(str(_crc_step(n)) for n in range(256)) + "]::BIGINT[])"


def crc32(text: str) -> str:
    """CRC-32 of the UTF-8 bytes of ``text``; null for null."""
    byte = f"('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT"
    step = f"lambda c, b: xor(c // 256, {_TABLE}[xor(c, b) % 256 + 1])"
    return f"xor(list_reduce(list_transform(range(octet_length(encode({text}))), lambda i: {byte}), {step}, 4294967295::BIGINT), 4294967295::BIGINT)"


def lower_ascii_sql(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
