"""Byte vectors for the framed-Avro codec (round trips and rejections)."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweave.functions.codec import decode_frames, encode_frames, frame_schema_id
from logweave.schemas import MESSAGE_AVRO_SCHEMA

UTC = dt.timezone.utc

def _df(spark, vectors):
    rows = [(i, None if h is None else bytes.fromhex(h if len(h) % 2 == 0 else h + "0"))
            for i, (h, _) in enumerate(vectors)]
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("value", T.BinaryType())])
    return spark.createDataFrame(rows, schema)


def test_decode_vectors(spark):
    vectors = [
        ("00000000010261026200", ("a", "b", 0)),
        ("0000000001", None),
        ("6e6f74206176726f", None),
        (None, None),
        ("000000000180", None),
        ("00000000010261026280", None),
        ("0000000001026102620099", ("a", "b", 0)),
        ("000000000101610262" + "00", None),
        ("000000000114610262", None),
        ("000000000102610262D285D8A39466", ("a", "b", 1755068432745)),
        ("", None),
        ("00000000", None),
    ]
    out = decode_frames(_df(spark, vectors)).orderBy("i").collect()
    for (h, want), row in zip(vectors, out):
        rec = row["record"]
        if want is None:
            assert rec is None or rec["id"] is None, (h, rec)
        else:
            assert rec is not None, h
            ms = int(rec["createdAt"].replace(tzinfo=UTC).timestamp() * 1000) if rec["createdAt"].tzinfo is None \
                else int(rec["createdAt"].timestamp() * 1000)
            assert (rec["id"], rec["text"], ms) == want, h


def test_roundtrip_multibyte_and_long(spark):
    long_text = "ü" * 40 + "x" * 100 + "日本語"
    when = dt.datetime(2026, 9, 19, 2, 6, 16, 249123)
    rows = [("id-1", "héllo", when), ("x" * 70, long_text, dt.datetime(1969, 12, 31, 23, 59, 59, 999000)),
            ("", "", dt.datetime(1970, 1, 1))]
    df = spark.createDataFrame(rows, "id string, text string, createdAt timestamp")
    enc = encode_frames(df, schema_id=7)
    dec = decode_frames(enc).select("id", "text", "createdAt", "record", frame_schema_id(F.col("value")).alias("sid"))
    for r in dec.collect():
        assert r["record"]["id"] == r["id"]
        assert r["record"]["text"] == r["text"]
        assert r["record"]["createdAt"] == r["createdAt"].replace(microsecond=r["createdAt"].microsecond // 1000 * 1000)
        assert r["sid"] == 7


def test_encode_known_bytes(spark):
    df = spark.createDataFrame([("a", "b", dt.datetime(1970, 1, 1))], "id string, text string, createdAt timestamp")
    v = encode_frames(df, out="v").first()["v"]
    assert bytes(v).hex() == "00000000010261026200"
    df = spark.createDataFrame([("a", "b", 1755068432745)], "id string, text string, ms long")
    v = encode_frames(df.withColumn("createdAt", F.timestamp_millis("ms")), out="v").first()["v"]
    assert bytes(v).hex().upper() == "000000000102610262D285D8A39466"


def test_millisecond_truncation(spark):
    df = spark.createDataFrame([("a", "b", dt.datetime(2026, 9, 19, 2, 6, 16, 249123))],
                               "id string, text string, createdAt timestamp")
    r = decode_frames(encode_frames(df).select("value")).first()
    assert r["record"]["createdAt"] == dt.datetime(2026, 9, 19, 2, 6, 16, 249000)


def test_varint_lengths_at_byte_boundaries(spark):
    # string lengths whose zig-zag needs 1, 2 and 3 varint bytes; ms values
    # needing 1 to 8 bytes, both signs
    rows = [("x" * n, "y" * m, ms) for n, m in [(0, 63), (64, 8191), (8192, 1)]
            for ms in (0, -1, 63, -64, 1 << 20, -(1 << 34), 1 << 48, (1 << 53) - 1)]
    df = spark.createDataFrame(rows, "id string, text string, ms long").withColumn(
        "createdAt", F.timestamp_millis("ms"))
    out = decode_frames(encode_frames(df)).select(
        "id", "text", "ms", F.unix_millis("record.createdAt").alias("ms2"),
        F.col("record.id").alias("id2"), F.col("record.text").alias("text2")).collect()
    for r in out:
        assert (r["id2"], r["text2"], r["ms2"]) == (r["id"], r["text"], r["ms"])


def test_schemas_that_cannot_be_read_are_refused(spark):
    df = spark.createDataFrame([(bytearray(b""),)], "value binary")
    decode_frames(df, schema=MESSAGE_AVRO_SCHEMA.replace('"name":"Message"', '"name":"Other","namespace":"n"'))  # the name doesn't matter
    fields = json.loads(MESSAGE_AVRO_SCHEMA)["fields"]
    for other in ([*fields, {"name": "n", "type": "long"}], fields[::-1], fields[:2], [{"name": "id", "type": ["null", "string"]}, *fields[1:]]):
        with pytest.raises(ValueError, match="Avro package"):
            decode_frames(df, schema=json.dumps({"type": "record", "name": "Message", "fields": other}))
    with pytest.raises(ValueError, match="Avro package"):
        decode_frames(df, schema='"string"')
