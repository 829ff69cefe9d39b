"""Avro zig-zag varints for encoding, as Spark column expressions.

``varint_len_sql`` / ``varint_hex_sql`` are SQL text, so a whole varint is
built as one expression: the 7-bit groups are spread into the bytes of one
long (at most 8 bytes, enough for any string length and any Spark timestamp in
milliseconds), which is written as hex once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zigzag(n: Column) -> Column:
    n = n.cast("long")
    return F.shiftleft(n, 1).bitwiseXOR(F.shiftright(n, 63))


# 0x0F0F0F0F0F0F0F0F and 0x8080808080808080 as signed longs
_NIBBLES = 1085102592571150095
_CONT = -9187201950435737472
MAX_ENCODE_BYTES = 8


def varint_len_sql(z: str, max_bytes: int = MAX_ENCODE_BYTES) -> str:
    """SQL: bytes needed by the varint of long column ``z`` (1..max_bytes);
    ``max_bytes`` must bound the value (5 for any binary length)."""
    whens = " ".join(f"WHEN shiftrightunsigned({z}, {7 * j}) = 0 THEN {j}" for j in range(1, max_bytes))
    return f"CASE {whens} ELSE {max_bytes} END"


def varint_hex_sql(z: str, n: str, max_bytes: int = MAX_ENCODE_BYTES) -> str:
    """SQL: hex text of the ``n``-byte varint of long column ``z``.

    The 7-bit groups are spread into the bytes of one long, continuation
    bits or-ed into the first n-1 bytes and the nibbles of each byte
    swapped; the reversed hex text of that long is then the varint, first
    byte first.  At most 8 bytes: any binary length or Spark timestamp in ms.
    """
    if not 1 <= max_bytes <= MAX_ENCODE_BYTES:
        raise ValueError("varint_hex_sql encodes at most 8 bytes")
    spread = " | ".join(f"shiftleft(shiftrightunsigned({z}, {7 * j}) & 127L, {8 * j})" for j in range(max_bytes))
    y = f"(({spread}) | ((shiftleft(1L, ({n} - 1) * 8) - 1L) & {_CONT}L))"
    swapped = f"(shiftleft({y} & {_NIBBLES}L, 4) | (shiftrightunsigned({y}, 4) & {_NIBBLES}L))"
    return f"substring(reverse(lpad(hex({swapped}), 16, '0')), 1, {n} * 2)"
