"""Dead-letter behaviour: real failures, exact bytes, own key and headers, replay."""

from pyspark.sql import functions as F

from logweave.functions import bytes as B
from logweave.operators.deadletter import Rule, dead_letter_fields, dead_letters, inspect, processed, route
from logweave.schemas import DLT_ORIGINAL_PARTITION
from logweave.streaming import router as R
from logweave.streaming.sinks import JdbcUpsert
from tests.helpers import at, log_rows

RULES = (Rule("text says bad", lambda r: ~r["text"].startswith("bad")), Rule("too long", lambda r: F.length(r["text"]) < 20))


def _raw(spark, values):
    df = spark.createDataFrame([(bytearray(v) if v is not None else None, i) for i, v in enumerate(values)], "value binary, i int")
    return df.select(
        F.lit(b"k").alias("key"), "value", F.lit("messages").alias("topic"), F.lit(3).alias("partition"),
        (F.col("i") + 17).cast("long").alias("offset"), F.lit("2026-01-01 00:00:00").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"), F.array(F.struct(F.lit("trace").alias("key"), F.lit(b"t1").alias("value"))).alias("headers"))


def test_rules_see_the_whole_record_and_the_first_broken_one_counts(spark):
    log = log_rows(spark, [("ok", at("01:00")), ("bad", at("01:00")), ("bad and much longer than that", at("02:00")), ("x" * 30, at("03:00"))])
    late = (*RULES, Rule("after 02:30", lambda r: F.minute(r["createdAt"]) < 2))
    got = {r["record"]["text"][:3]: r["failure"]["message"] if r["failure"] else None for r in route(log, late).collect()}
    assert got == {"ok": None, "bad": "text says bad", "xxx": "too long"}
    assert processed(route(log, RULES)).count() == 1
    # a rule that gives null isn't met
    unknown = (Rule("nothing known", lambda r: F.lit(None).cast("boolean")),)
    assert processed(route(log, unknown)).count() == 0


def test_dead_letters_keep_bytes_key_headers_and_partition(spark):
    routed = route(log_rows(spark, [("bad y", at("01:00")), ("ok", at("01:00"))]).unionByName(_raw(spark, [b"no frame", None])), RULES)
    dlt = dead_letters(routed).cache()
    fields = {(r["exception_fqcn"].rsplit(".", 1)[-1], r["original_offset"]): r for r in dead_letter_fields(dlt, "trace").collect()}
    raw = fields["UndecodableRecord", 17]
    assert bytes.fromhex(raw["value_hex"]) == b"no frame" and raw["cause_fqcn"] is None
    assert (raw["dlt_partition"], raw["original_partition"], raw["key"], raw["own_header"]) == (3, 3, "k", "t1")
    assert fields["UndecodableRecord", 18]["value_hex"] is None
    invalid = next(r for (kind, _), r in fields.items() if kind == "InvalidRecord")
    assert invalid["value_hex"].startswith("00") and invalid["exception_message"] == "text says bad"
    assert invalid["cause_fqcn"].endswith("BrokenRule") and invalid["key"] is None and invalid["own_header"] is None
    part = dlt.select(B.be_int(B.last_header(F.col("headers"), DLT_ORIGINAL_PARTITION)).alias("p")).collect()
    assert sorted(r["p"] for r in part) == [0, 3, 3]
    first = dlt.where("key IS NOT NULL").select(F.col("headers")[0]["key"].alias("k")).first()
    assert first["k"] == "trace"  # the record's own headers come first


def test_inspect_columns(spark):
    dlt = _raw(spark, [b"caf\xc3\xa9", bytes(range(100)), None, b"a\xffb"]).orderBy("offset")
    got = inspect(dlt).collect()
    assert (got[0]["value_kind"], got[0]["value_bytes"], got[0]["preview_hex"], got[0]["preview_text"]) == ("raw", 5, "636166c3a9", "café")
    assert (got[1]["value_bytes"], got[1]["preview_hex"]) == (100, bytes(range(64)).hex())
    assert (got[2]["value_kind"], got[2]["value_bytes"], got[2]["preview_hex"]) == ("null", None, None)
    assert got[3]["preview_text"] == "a\ufffdb" and got[3]["dlt_offset"] == 20
    good = inspect(log_rows(spark, [("hi", at("01:00"))])).first()
    assert (good["value_kind"], good["message_id"], good["message_text"], good["preview_text"]) == ("message", "id-0", "hi", None)


def test_jdbc_upsert_text():
    key = ["window_start", "window_end", "text"]
    merge = JdbcUpsert("jdbc:x", "counts", key, ["count"], query="q-1")
    assert merge.staging(3) == "counts_staging_q_1_3" != merge.staging(4)
    assert merge.upsert_sql(3).startswith("MERGE INTO counts t USING counts_staging_q_1_3 s ON t.window_start = s.window_start")
    conflict = JdbcUpsert("jdbc:postgresql://h/d", "counts", key, ["count"]).upsert_sql(0)
    assert conflict.endswith("ON CONFLICT (window_start, window_end, text) DO UPDATE SET count = EXCLUDED.count")


def _rows(spark, table):
    return R.processed(spark, table).count(), R.dead_letters(spark, table).count()


def test_router_replay_is_idempotent(spark, tmp_path):
    batch = log_rows(spark, [("bad a", at("01:00")), ("ok", at("01:00")), ("bad b", at("02:00"))])
    table = str(tmp_path / "routed")
    router = R.DeadLetterRouter(table, RULES)
    router(batch, 0)
    assert _rows(spark, table) == (1, 2)
    router(batch, 0)  # replay of the same micro-batch
    assert _rows(spark, table) == (1, 2)


def test_router_keeps_the_rows_of_another_checkpoint(spark):
    from logweave.streaming.runner import StagedLog

    staged = StagedLog(spark, "t-router")
    table = staged.path("routed")
    staged.append(log_rows(spark, [("bad a", at("01:00")), ("ok", at("01:00"))]))
    for k in (1, 2):
        staged.run(lambda s: R.DeadLetterRouter(table, RULES).writer(s, staged.path(f"ckpt{k}"), f"t_router{k}"))  # noqa: B023
    assert _rows(spark, table) == (2, 2)
    staged.append(log_rows(spark, [("ok", at("02:00"))], 10))
    staged.run(lambda s: R.DeadLetterRouter(table, RULES).writer(s, staged.path("ckpt1"), "t_router1"))  # resumes
    assert _rows(spark, table) == (3, 2)


def test_empty_batch_leaves_a_readable_table(spark, tmp_path):
    table = str(tmp_path / "routed")
    R.DeadLetterRouter(table, RULES)(log_rows(spark, [("ok", at("01:00"))]).limit(0), 0)
    assert _rows(spark, table) == (0, 0)
