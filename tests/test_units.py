"""Options, byte helpers, catalog, staging, command line, session."""

import pytest
from pyspark.sql import functions as F

from logweave.functions import bytes as B
from logweave.sources.catalog import latest_schema, latest_schemas, value_subject
from logweave.sources.log import kafka_options, producer_options


def test_option_pass_through():
    cfg = {"bootstrap.servers": "b:9094", "topic": "t", "kafka.security.protocol": "SASL_SSL",
           "kafka.isolation.level": "read_committed", "kafka.ssl.truststore.location": "x",
           "producer.acks": "all", "producer.enable.idempotence": "true"}
    assert kafka_options(cfg) == {"kafka.security.protocol": "SASL_SSL",
                                  "kafka.isolation.level": "read_committed",
                                  "kafka.ssl.truststore.location": "x"}
    assert producer_options(cfg) == {"kafka.security.protocol": "SASL_SSL",
                                     "kafka.ssl.truststore.location": "x",
                                     "kafka.acks": "all", "kafka.enable.idempotence": "true"}


def test_producer_settings_are_not_lost():
    cfg = {"kafka.partitioner.ignore.keys": "true", "kafka.metric.reporters": "m", "kafka.some.future.setting": "1",
           "kafka.group.id": "g", "kafka.auto.offset.reset": "earliest", "producer.metric.reporters": "p"}
    assert producer_options(cfg) == {"kafka.partitioner.ignore.keys": "true", "kafka.some.future.setting": "1",
                                     "kafka.metric.reporters": "p"}


def test_log_table_streams_are_bounded():
    from logweave.sources.log import admission

    assert admission({}) == {"maxFilesPerTrigger": "1000"}
    assert admission({"maxFilesPerTrigger": 7, "topic": "t"}) == {"maxFilesPerTrigger": "7"}
    assert admission({"maxBytesPerTrigger": "1g"}) == {"maxBytesPerTrigger": "1g"}


def test_shared_folder_is_required_off_local(monkeypatch):
    from logweave import session

    assert session.is_local("local") and session.is_local("local[8]")
    assert not session.is_local("local-cluster[2,1,1024]") and not session.is_local("yarn")

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_root(Session())


def test_zone_is_checked_not_changed(spark):
    from logweave.session import require_utc

    require_utc(spark)
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    with pytest.raises(ValueError, match="UTC"):
        require_utc(other)
    assert other.conf.get("spark.sql.session.timeZone") == "Europe/Berlin"


def test_registered_schema_and_id(spark, tmp_path):
    from logweave.plans.apps import registered_schema
    from logweave.schemas import MESSAGE_AVRO_SCHEMA

    path = str(tmp_path / "catalog")
    spark.createDataFrame([("t-value", 1, 10, "old"), ("t-value", 2, 12, MESSAGE_AVRO_SCHEMA)],
                          "subject string, version int, id int, schema string").write.parquet(path)
    assert registered_schema(spark, {"topic": "t", "schema.catalog.path": path}) == (12, MESSAGE_AVRO_SCHEMA)
    assert registered_schema(spark, {"topic": "t", "schema.id": "5"}) == (5, MESSAGE_AVRO_SCHEMA)
    with pytest.raises(LookupError):
        registered_schema(spark, {"topic": "u", "schema.catalog.path": path})


def test_big_endian_and_headers(spark):
    df = spark.createDataFrame([(-2, -5), (7, 1 << 40)], "i int, l long")
    out = df.select(B.be_int(B.int_be(F.col("i"))).alias("i2"), B.be_long(B.long_be(F.col("l"))).alias("l2"),
                    F.hex(B.int_be(F.col("i"))).alias("h")).collect()
    assert [(r["i2"], r["l2"]) for r in out] == [(-2, -5), (7, 1 << 40)]
    assert out[1]["h"] == "00000007"
    hs = spark.createDataFrame(
        [([("a", bytearray(b"1")), ("b", bytearray(b"2")), ("a", bytearray(b"3"))],)],
        "h array<struct<key string, value binary>>")
    r = hs.select(B.header_text(F.col("h"), "a").alias("a"), B.header_text(F.col("h"), "zz").alias("z")).first()
    assert r["a"] == "3" and r["z"] is None
    r = spark.range(1).select(B.lossy_text(F.unhex(F.lit("61FF"))).alias("t")).first()
    assert r["t"] == "a�"


def test_latest_schema(spark):
    cat = spark.createDataFrame(
        [("t-value", 1, 10, "s1"), ("t-value", 3, 12, "s3"), ("t-value", 2, 11, "s2"), ("u-value", 1, 5, "u")],
        "subject string, version int, id int, schema string")
    assert latest_schema(cat, value_subject("t")) == (12, "s3")
    assert latest_schemas(cat).count() == 2
    with pytest.raises(LookupError):
        latest_schema(cat, "missing-value")


def test_produce_and_write_log(spark, tmp_path):
    import datetime as dt

    from logweave.functions.codec import decode_frames
    from logweave.operators.produce import framed, new_messages, raw_records
    from logweave.sources.log import read_log, write_log

    texts = spark.createDataFrame([("hello",), ("héllo wörld " * 10,)], "text string")
    before = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    msgs = new_messages(texts, seconds_ago=300).cache()
    rows = msgs.collect()
    assert len({r["id"] for r in rows}) == 2
    for r in rows:
        assert r["createdAt"].microsecond % 1000 == 0
        assert dt.timedelta(seconds=290) < before - r["createdAt"] < dt.timedelta(seconds=400)
    path = str(tmp_path / "log")
    write_log(framed(msgs), path=path)
    write_log(raw_records(spark.createDataFrame([(bytearray(b"not avro"),)], "value binary")), path=path)
    back = decode_frames(read_log(spark, path=path, streaming=False)).collect()
    got = sorted((r["record"]["text"] if r["record"] else None) or "" for r in back)
    assert got == sorted(["", "hello", "héllo wörld " * 10])


def test_apps_refuse_shared_checkpoints():
    from logweave.plans.apps import check_checkpoints

    ok = {"checkpoint.location": "/c/a", "parquet.checkpoint.location": "/c/b", "upsert.checkpoint.location": "/c/c"}
    check_checkpoints(ok)
    with pytest.raises(ValueError, match="share checkpoint"):
        check_checkpoints({**ok, "upsert.checkpoint.location": "/c/a/"})
    with pytest.raises(ValueError, match="missing"):
        check_checkpoints({"checkpoint.location": "/c/a"})


def test_staged_batches_cover_all_records(spark):
    from logweave.sources.fixtures import staged_batches

    df = spark.range(0, 1000).select(F.col("id").alias("event_id"), F.col("id").alias("x"))
    parts = staged_batches(df, 4, late_mod=13)
    got = sorted(r["x"] for p in parts for r in p.collect())
    assert got == list(range(1000)) and all("event_id" not in p.columns for p in parts)
    # late records move to the next batch, the last batch keeps its own
    assert 13 in {r["x"] for r in parts[1].collect()} and 0 in {r["x"] for r in parts[1].collect()}
    empty = staged_batches(df.limit(0), 3)
    assert len(empty) == 3 and all(p.count() == 0 for p in empty)


def test_properties_and_late_publish(spark, tmp_path):
    import datetime as dt

    from logweave.__main__ import publish_late, read_properties
    from logweave.operators.decode import decode_messages
    from logweave.sources.log import read_log

    props = tmp_path / "app.properties"
    props.write_text("# comment\nwindow.duration=1 minute\nlog.path = %s\nflag\n" % (tmp_path / "log"))
    cfg = read_properties(str(props))
    assert cfg["window.duration"] == "1 minute" and cfg["log.path"] == str(tmp_path / "log") and cfg["flag"] == ""
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    publish_late(spark, cfg, "dropped_too_old", 300)
    row = decode_messages(read_log(spark, path=cfg["log.path"], streaming=False)).first()
    assert row["text"] == "dropped_too_old"
    assert dt.timedelta(seconds=290) < now - row["createdAt"] < dt.timedelta(seconds=400)


def test_produced_records_carry_topic(spark):
    from logweave.operators.produce import framed, new_messages, raw_records

    texts = spark.createDataFrame([("a",)], "text string")
    rec = framed(new_messages(texts), schema_id=3, topic="messages").first()
    assert rec["topic"] == "messages" and bytes(rec["value"])[:5] == b"\x00\x00\x00\x00\x03"
    raw = raw_records(spark.createDataFrame([(bytearray(b"xyz"),)], "value binary"), topic="t").first()
    assert raw["topic"] == "t" and bytes(raw["value"]) == b"xyz" and raw["key"] is None
