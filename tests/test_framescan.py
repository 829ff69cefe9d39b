"""The vectorised frame scanner on Arrow arrays directly (no Spark)."""

import pyarrow as pa

from logweave.functions.framescan import scan_frames_arrow

GOOD = bytes.fromhex("000000000102610262D285D8A39466")


def _rows(arr):
    return scan_frames_arrow(arr).to_pylist()


def test_empty_and_types():
    assert _rows(pa.array([], pa.binary())) == []
    for t in (pa.binary(), pa.large_binary()):
        got = _rows(pa.array([GOOD, None, b"not avro"], t))
        assert got[0] == {"s1": 7, "l1": 1, "s2": 9, "l2": 1, "ms": 1755068432745}
        assert got[1] is None and got[2] is None


def test_sliced_and_chunked():
    arr = pa.array([b"x", GOOD, b"\x00\x00\x00\x00\x01", GOOD], pa.binary())
    got = _rows(arr.slice(1, 3))
    assert got[0]["ms"] == 1755068432745 and got[1] is None and got[2]["ms"] == 1755068432745
    chunked = pa.chunked_array([arr.slice(0, 2), arr.slice(2, 2)])
    assert [r is None for r in _rows(chunked)] == [True, False, True, False]


def test_long_strings_and_negative_lengths():
    text = ("é" * 100).encode()
    n = len(text)
    # zig-zag of n as a two-byte varint
    z = n * 2
    varint = bytes([(z & 0x7F) | 0x80, z >> 7])
    value = b"\x00\x00\x00\x00\x01" + b"\x02a" + varint + text + b"\x00"
    got = _rows(pa.array([value]))[0]
    assert (got["l1"], got["l2"], got["s2"], got["ms"]) == (1, n, 10, 0)
    assert _rows(pa.array([bytes.fromhex("00000000010161026200")]))[0] is None  # length -1
