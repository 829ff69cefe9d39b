"""Framed Avro: magic byte 0, 4-byte big-endian writer-schema id, Avro body.

``encode_frames`` builds the bytes of the flat message record
``{id: string, text: string, createdAt: long timestamp-millis}``;
``decode_frames`` reverses it with all-or-nothing semantics: a value that is
null, shorter than the 5-byte header, has another magic byte, a truncated or
over-long varint, a negative length, a string running past the end, or a
timestamp out of range decodes to a null ``record``.  Bytes after the last
field are ignored.  The writer-schema id is read but never used to pick a
schema (no schema evolution).  Nothing here throws under ANSI mode.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import MESSAGE_AVRO_SCHEMA
from .varint import varint_hex_sql, varint_len_sql, zigzag

MAGIC = b"\x00"
HEADER_BYTES = 5


def frame_header(schema_id: int) -> Column:
    return F.lit(MAGIC + int(schema_id & 0xFFFFFFFF).to_bytes(4, "big"))


def encode_frames(
    df: DataFrame, id_col: str = "id", text_col: str = "text", created_col: str = "createdAt",
    out: str = "value", schema_id: int = 1,
) -> DataFrame:
    """Add binary column ``out``: the framed message of each row.

    Staged over several projections so each zig-zag value and varint length is
    computed once per row and the optimizer sees small expressions.
    """
    p = "__lw_e"
    cols = df.columns
    s = df.select(
        *cols,
        F.col(id_col).cast("binary").alias(p + "b1"),
        F.col(text_col).cast("binary").alias(p + "b2"),
    ).select(
        "*",
        zigzag(F.length(p + "b1")).alias(p + "z1"),
        zigzag(F.length(p + "b2")).alias(p + "z2"),
        zigzag(F.unix_millis(F.col(created_col))).alias(p + "z3"),
    )
    # Bounded sizes: a binary length (< 2^31) needs at most 5 varint bytes,
    # a Spark timestamp in milliseconds (|ms| < 2^54) at most 8.
    sizes = {1: 5, 2: 5, 3: 8}
    s = s.select("*", *[F.expr(varint_len_sql(f"{p}z{k}", m)).alias(f"{p}n{k}") for k, m in sizes.items()])
    s = s.select("*", *[F.expr(varint_hex_sql(f"{p}z{k}", f"{p}n{k}", m)).alias(f"{p}h{k}")
                        for k, m in sizes.items()])
    value = F.concat(
        frame_header(schema_id),
        F.unhex(F.col(p + "h1")), F.col(p + "b1"),
        F.unhex(F.col(p + "h2")), F.col(p + "b2"),
        F.unhex(F.col(p + "h3")),
    )
    return s.select(*cols, value.alias(out))


def frame_ok(value: Column) -> Column:
    """Could this value have been written by a framed-Avro serializer?"""
    return (
        value.isNotNull()
        & (F.length(value) >= HEADER_BYTES)
        & (value.substr(F.lit(1), F.lit(1)) == F.lit(MAGIC))
    )


def frame_body(value: Column) -> Column:
    return value.substr(F.lit(HEADER_BYTES + 1), F.length(value) - HEADER_BYTES)


def frame_schema_id(value: Column) -> Column:
    return F.when(frame_ok(value), F.conv(F.hex(value.substr(F.lit(2), F.lit(4))), 16, 10).cast("int"))


def written_with(value: Column, ids: Iterable[int]) -> Column:
    """Does the frame name one of these writer schemas?"""
    return frame_ok(value) & value.substr(F.lit(2), F.lit(4)).isin([F.lit(i.to_bytes(4, "big", signed=True)) for i in sorted(ids)])


def is_message_schema(schema: str) -> bool:
    """Is it a record of the string fields id and text and the timestamp-millis field createdAt?"""
    got = json.loads(schema)
    fields = [(f.get("name"), f.get("type")) for f in got.get("fields", [])] if isinstance(got, dict) and got.get("type") == "record" else None
    return fields == [(f["name"], f["type"]) for f in json.loads(MESSAGE_AVRO_SCHEMA)["fields"]]


def check_message_schema(schema: str) -> None:
    """The scanner reads one layout.  Any other schema is refused here; read
    with it, every record would look undecodable and be dropped."""
    if not is_message_schema(schema):
        raise ValueError(f"only records of id, text and createdAt can be read without Spark's Avro package; the schema is {schema}")


def decode_frames(df: DataFrame, value_col: str = "value", out: str = "record",
                  schema: str = MESSAGE_AVRO_SCHEMA, avro_package: bool = False,
                  schemas: dict[int, str] | None = None) -> DataFrame:
    """Add struct column ``out`` decoded from ``value_col`` with the given writer schema.

    With ``schemas`` (id to schema, see ``sources.catalog.schemas_by_id``) each record is
    read with the schema whose id its frame names, and records with any other id are
    undecodable.  Their message fields (id, text, createdAt) become the record; without
    the Avro package, ids whose schema is another layout are undecodable too.

    With ``avro_package`` (Spark's spark-avro is deployed) the body goes through
    ``from_avro`` in PERMISSIVE mode and may have any schema.  Otherwise the
    vectorised scanner in ``framescan`` finds the fields of the message record,
    other schemas are refused, and the strings are cut JVM-side.

    Callers filtering on ``out`` should keep a barrier (``observe``) between
    this and the filter, as ``decode_messages`` does, so the optimizer does
    not inline the staged columns into the predicate.
    """
    v = F.col(value_col)
    cols = df.columns
    if avro_package:
        from pyspark.sql.avro.functions import from_avro

        if schemas is not None:
            return df.select(*cols, _by_id(v, schemas).alias(out))
        body = F.when(frame_ok(v), frame_body(v))
        return df.select(*cols, from_avro(body, schema, {"mode": "PERMISSIVE"}).alias(out))
    from .framescan import scan_frames

    if schemas is None:
        check_message_schema(schema)
        readable = v
    else:
        known = [i for i, text in schemas.items() if is_message_schema(text)]
        if not known:
            raise ValueError(f"none of the schemas {sorted(schemas)} can be read without Spark's Avro package")
        readable = F.when(written_with(v, known), v)
    scan = "__lw_scan"
    s = df.select(*cols, scan_frames(readable).alias(scan))
    record = F.when(
        F.col(scan).isNotNull(),
        F.struct(
            v.substr(F.col(scan + ".s1"), F.col(scan + ".l1")).cast("string").alias("id"),
            v.substr(F.col(scan + ".s2"), F.col(scan + ".l2")).cast("string").alias("text"),
            F.timestamp_millis(F.col(scan + ".ms")).alias("createdAt"),
        ),
    )
    return s.select(*cols, record.alias(out))


def _by_id(value: Column, schemas: dict[int, str]) -> Column:
    """The message fields of a record, read with the schema that its frame names."""
    from pyspark.sql.avro.functions import from_avro

    types = {f["name"]: t for f, t in zip(json.loads(MESSAGE_AVRO_SCHEMA)["fields"], ("string", "string", "timestamp"), strict=True)}
    record = F.lit(None)
    for i, schema in sorted(schemas.items()):
        mine = written_with(value, [i])
        got = from_avro(F.when(mine, frame_body(value)), schema, {"mode": "PERMISSIVE"})
        has = {f["name"] for f in json.loads(schema)["fields"]}
        fields = [(got[n] if n in has else F.lit(None)).cast(t).alias(n) for n, t in types.items()]
        record = F.when(mine, F.struct(*fields)).otherwise(record)
    return record
