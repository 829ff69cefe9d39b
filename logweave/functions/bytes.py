"""Byte-level helpers for Kafka headers and previews (total: never throw)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def utf8(s: Column) -> Column:
    return s.cast("binary")


def int_be(x: Column) -> Column:
    """4-byte big-endian bytes of an int."""
    return F.unhex(F.lpad(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))


def long_be(x: Column) -> Column:
    """8-byte big-endian bytes of a long (hex of a negative long is its
    16-digit two's complement)."""
    return F.unhex(F.lpad(F.hex(x.cast("long")), 16, "0"))


def be_int(v: Column) -> Column:
    """Signed int from 4 big-endian bytes (null unless exactly 4 bytes)."""
    u = F.conv(F.hex(v), 16, 10).cast("long")
    signed = F.when(u >= F.lit(1 << 31), u - F.lit(1 << 32)).otherwise(u)
    return F.when(F.length(v) == 4, signed.cast("int"))


def be_long(v: Column) -> Column:
    """Signed long from 8 big-endian bytes (null unless exactly 8 bytes)."""
    return F.when(F.length(v) == 8, F.conv(F.hex(v), 16, -10).cast("long"))


def last_header(headers: Column, name: str) -> Column:
    """Value bytes of the last header called ``name`` (null if absent)."""
    return F.try_element_at(F.filter(headers, lambda h: h["key"] == F.lit(name)), F.lit(-1))["value"]


def header_text(headers: Column, name: str) -> Column:
    return lossy_text(last_header(headers, name))


def lossy_text(v: Column) -> Column:
    """UTF-8 text of bytes, invalid sequences replaced by U+FFFD."""
    return F.call_function("make_valid_utf8", v.cast("string"))


