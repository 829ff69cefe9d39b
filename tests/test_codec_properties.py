"""Property check: the scanner agrees with a plain reader on any bytes, and
valid encodings round-trip (hypothesis-generated values)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logweave.functions.codec import decode_frames

MAX_MS = 9_000_000_000_000_000


def _zigzag(n: int) -> int:
    return (n << 1) ^ (n >> 63)


def _varint(z: int) -> bytes:
    out = bytearray()
    while True:
        b = z & 0x7F
        z >>= 7
        out.append(b | (0x80 if z else 0))
        if not z:
            return bytes(out)


def _frame(i: str, t: str, ms: int) -> bytes:
    ib, tb = i.encode(), t.encode()
    return (b"\x00\x00\x00\x00\x01" + _varint(_zigzag(len(ib))) + ib + _varint(_zigzag(len(tb))) + tb
            + _varint(_zigzag(ms) & 0xFFFFFFFFFFFFFFFF))


messages = st.tuples(st.text(max_size=80), st.text(max_size=300), st.integers(-MAX_MS, MAX_MS))


@st.composite
def values(draw):
    i, t, ms = draw(messages)
    good = _frame(i, t, ms)
    kind = draw(st.sampled_from(["good", "cut", "flip", "extra", "random"]))
    if kind == "good":
        return good, (i, t, ms)
    if kind == "cut":
        return good[: draw(st.integers(0, len(good) - 1))], None
    if kind == "flip":
        pos = draw(st.integers(0, len(good) - 1))
        return good[:pos] + bytes([good[pos] ^ draw(st.integers(1, 255))]) + good[pos + 1:], "?"
    if kind == "extra":
        return good + draw(st.binary(min_size=1, max_size=8)), (i, t, ms)
    return draw(st.binary(max_size=40)), "?"


def _plain(value: bytes):
    """The message in a value, read field by field; None unless all of it is there."""
    def varint(at):
        z = shift = 0
        for n in range(10):
            if at + n >= len(value):
                return None
            b = value[at + n]
            z |= (b & 0x7F) << shift
            shift += 7
            if b < 0x80:
                z &= (1 << 64) - 1
                return (z >> 1) ^ -(z & 1), at + n + 1
        return None

    if len(value) < 5 or value[0]:
        return None
    at, out = 5, []
    for _ in range(2):
        got = varint(at)
        if got is None or got[0] < 0 or got[1] + got[0] > len(value):
            return None
        out.append(value[got[1]:got[1] + got[0]])
        at = got[1] + got[0]
    got = varint(at)
    if got is None or abs(got[0]) > 9223372036854775:
        return None
    return out[0], out[1], got[0]


@settings(max_examples=1, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(values(), min_size=300, max_size=300))
def test_scanner_agrees_with_plain_reader(spark, cases):
    df = spark.createDataFrame([(k, bytearray(v)) for k, (v, _) in enumerate(cases)], "k int, value binary")
    out = decode_frames(df).select(
        "k", F.col("record.id").cast("binary").alias("id"), F.col("record.text").cast("binary").alias("text"),
        F.unix_millis("record.createdAt").alias("ms")).collect()
    got = {r["k"]: None if r["id"] is None else (bytes(r["id"]), bytes(r["text"]), r["ms"]) for r in out}
    for k, (value, want) in enumerate(cases):
        assert got[k] == _plain(value)
        if isinstance(want, tuple):
            assert got[k] == (want[0].encode(), want[1].encode(), want[2])
        elif want is None:
            assert got[k] is None
