"""Keyed table, fan-out, metrics table, dedupe, state, offset ranges, clustered results and writer schemas on small inputs."""

import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from logweave.functions.codec import encode_frames
from logweave.operators.deadletter import DEAD_LETTER, PROCESSED, DeadLetterConfig, Rule, dead_letters, inspect, processed, route
from logweave.operators.decode import decode_messages
from logweave.operators.dedupe import dedupe
from logweave.operators.windows import windowed_counts
from logweave.schemas import COUNTS_KEY, MESSAGE_AVRO_SCHEMA
from logweave.session import new_run_dir
from logweave.sources.catalog import schemas_by_id
from logweave.sources.log import offset_range, read_log, write_log
from logweave.streaming import clustered, keyed, metrics, router, sinks
from logweave.streaming.batches import BatchTable, Branch, FanOut, Measured, MetricsTable, fan_out_table, read_batches
from logweave.streaming.router import DeadLetterRouter
from logweave.streaming.runner import StagedLog
from logweave.streaming.state import ROCKSDB, open_windows, state_session
from tests.helpers import at, log_rows


def _files(folder):
    return {os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def _rows(df):
    return sorted(map(tuple, df.collect()))


def _batch(spark, pairs):
    return spark.createDataFrame(pairs, "k string, v long")


def test_compaction_rewrites_only_touched_buckets(spark):
    table = f"{new_run_dir(spark, 't-keyed')}/table"
    sink = keyed.KeyedTable(table, ["k"], F.concat(F.lit("b"), F.substring("k", 1, 1)), compact_every=100)
    sink(_batch(spark, [("a1", 1), ("b1", 1), ("c1", 1)]), 0)
    sink(_batch(spark, [("a1", 2), ("b2", 2)]), 1)
    assert keyed.compact(spark, table, ["k"]) == 3 and keyed.compact(spark, table, ["k"]) == 0
    first = _files(f"{table}/base")
    sink(_batch(spark, [("b1", 3)]), 2)
    want = [("a1", 2), ("b1", 3), ("b2", 2), ("c1", 1)]
    assert _rows(keyed.view(spark, table, ["k"])) == want  # base and open delta
    assert keyed.compact(spark, table, ["k"]) == 1
    new = _files(f"{table}/base") - first
    assert first <= _files(f"{table}/base") and new and all("/generation=2/bucket=bb/" in f for f in new)
    assert _rows(keyed.view(spark, table, ["k"])) == want
    read = keyed.view(spark, table, ["k"]).inputFiles()
    assert {f.split("/base/")[1].rsplit("/", 1)[0] for f in read} == {"generation=1/bucket=ba", "generation=2/bucket=bb", "generation=1/bucket=bc"}
    assert [f.removeprefix(table + "/") for f in keyed.obsolete(spark, table)] == [
        "base/generation=1/bucket=bb", "deltas/after=-1", "deltas/after=1"]
    plan = keyed.view(spark, table, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # nothing open: no merge


def test_keyed_table_compacts_by_itself_and_takes_repeated_batches(spark):
    table = f"{new_run_dir(spark, 't-keyed')}/table"
    sink = keyed.KeyedTable(table, ["k"], keyed.hashed(["k"], 4), compact_every=3)
    for k in range(6):
        batch = _batch(spark, [(f"x{j}", 10 * k + j) for j in range(k, k + 3)])
        sink(batch, k)
        sink(batch, k)  # delivered again
        deltas = {f.split("batch_id=")[1].split("/")[0] for f in keyed.view(spark, table, ["k"]).inputFiles() if "/deltas/" in f}
        assert len(deltas) <= 3  # a read merges a bounded number of batches
    assert _rows(keyed.view(spark, table, ["k"])) == sorted((f"x{j}", 10 * min(j, 5) + j) for j in range(8))
    with pytest.raises(LookupError):
        keyed.view(spark, table + "-none", ["k"])


def test_keyed_table_crash_replay_and_owner(spark):
    staged = StagedLog(spark, "t-keyed-crash")
    table, crashed = staged.path("table"), []

    def crash_once(batch, batch_id):
        if batch_id >= 1 and not crashed:
            crashed.append(batch_id)
            raise RuntimeError("crash after writing")

    def build(stream):
        sink = keyed.KeyedTable(table, COUNTS_KEY, keyed.daily("window_start"), compact_every=1, on_written=crash_once)
        return sink.writer(windowed_counts(decode_messages(stream), "1 minute", "2 minutes"), staged.path("ckpt"), "t_keyed_crash")

    staged.append(log_rows(spark, [("a", at("01:00")), ("a", at("01:10"))]))
    staged.run(build)
    staged.append(log_rows(spark, [("a", at("01:20")), ("b", at("02:00"))], 2))
    with pytest.raises(Exception, match="crash after writing"):
        staged.run(build)
    spark.streams.resetTerminated()
    staged.run(build)
    assert crashed and [(r[2], r[3]) for r in _rows(keyed.view(spark, table, COUNTS_KEY))] == [("a", 3), ("b", 1)]
    other = keyed.KeyedTable(table, COUNTS_KEY)
    with pytest.raises(Exception, match="belongs to query"):
        staged.run(lambda s: other.writer(windowed_counts(decode_messages(s), "1 minute", "2 minutes"), staged.path("ckpt2"), "t_keyed_other"))
    spark.streams.resetTerminated()


def test_fan_out_crash_between_two_targets(spark):
    staged = StagedLog(spark, "t-fan-out")
    root, crashed, written = staged.path("targets"), [], []

    def crash_once(name, batch_id):
        written.append((name, batch_id))
        if name == "counts" and batch_id == 1 and not crashed:
            crashed.append(batch_id)
            raise RuntimeError("crash before the commit record")

    outside = []
    branches = [Branch("messages", lambda df: df), Branch("counts", lambda df: windowed_counts(df, "1 minute")),
                Branch("outside", lambda df: df.select("id"), lambda df, k: outside.append((k, df.count())))]

    def build(stream):
        return FanOut(root, decode_messages, branches, crash_once).writer(stream, staged.path("ckpt"), "t_fan_out")

    staged.append(log_rows(spark, [("a", at("01:00")), ("a", at("01:10"))]))
    staged.run(build)
    staged.append(log_rows(spark, [("a", at("01:20")), ("b", at("02:00"))], 2))
    with pytest.raises(Exception, match="crash before the commit record"):
        staged.run(build)
    spark.streams.resetTerminated()
    assert fan_out_table(spark, root, "messages").count() == 4
    assert fan_out_table(spark, root, "counts").agg(F.sum("count")).first()[0] == 2  # written, not committed: not shown
    staged.run(build)
    assert written.count(("messages", 1)) == 1 and written.count(("counts", 1)) == 2 and outside == [(0, 2), (1, 2)]
    assert fan_out_table(spark, root, "messages").count() == 4
    assert fan_out_table(spark, root, "counts").agg(F.sum("count")).first()[0] == 4
    other = FanOut(root, decode_messages, branches[:1])  # a new checkpoint writes beside the old one's batches
    staged.run(lambda s: other.writer(s, staged.path("ckpt2"), "t_fan_out2"))
    assert fan_out_table(spark, root, "messages").count() == 8


def test_metrics_table_outlives_the_driver_and_takes_repeated_batches(spark):
    staged = StagedLog(spark, "t-metrics")
    table = MetricsTable(staged.path("metrics"))
    good = log_rows(spark, [("a", at("01:00")), ("b", at("01:10"))])
    poison = good.withColumn("value", F.lit(b"no frame"))
    for part in (good, poison, good.unionByName(poison)):
        staged.append(part)
        staged.run(lambda s: Measured(BatchTable(staged.path("messages")), table).writer(s, staged.path("ckpt"), "t_metrics"))
    got = [(r["batch_id"], r["received"], r["skipped"]) for r in table.rows(spark).orderBy("batch_id").collect()]
    assert got == [(0, 2, 0), (1, 2, 2), (2, 4, 2)]
    again = Measured(BatchTable(staged.path("m2")), MetricsTable(staged.path("x2")))
    for _ in range(2):
        again(good.unionByName(poison), 5)
    assert again.metrics.rows(spark).count() == 1 and read_batches(spark, staged.path("m2")).count() == 2


def test_dedupe_within_and_beyond_the_delay(spark):
    session = state_session(spark)
    assert session.conf.get("spark.sql.streaming.stateStore.providerClass") == ROCKSDB["spark.sql.streaming.stateStore.providerClass"]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != ROCKSDB["spark.sql.streaming.stateStore.providerClass"]
    assert session.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")
    staged = StagedLog(session, "t-dedupe")

    def sent(rows):  # (id number, sent at)
        out = None
        for n, when in rows:
            one = log_rows(spark, [("m", at("00:00"))], n).withColumn("timestamp", F.lit(at(when)))
            out = one if out is None else out.unionByName(one)
        return out

    for batch in ([(1, "10:00"), (1, "10:30"), (2, "10:00")], [(1, "11:00"), (3, "11:00")], [(4, "20:00")], [(1, "21:00"), (2, "16:00")]):
        staged.append(sent(batch))
        staged.run(lambda s: sinks.append_parquet(dedupe(decode_messages(s), "2 minutes").select("id", "timestamp"),
                                                  staged.path("out"), staged.path("ckpt"), "t_dedupe"))
    # the resend of 1 at 11:00 is within the delay, that at 21:00 beyond it; that of 2 at 16:00 is older than the watermark
    assert sorted(r["id"] for r in spark.read.parquet(staged.path("out")).collect()) == ["id-1", "id-1", "id-2", "id-3", "id-4"]
    with pytest.raises(ValueError):
        dedupe(decode_messages(staged_table := read_log(spark, path=staged.log_path, streaming=False)), "2 minutes")
    assert staged_table.count() == 8


def test_open_windows_and_event_times(spark):
    seen = metrics.event_times(spark)
    staged = StagedLog(spark, "t-open")
    runs = []
    for k, batch in enumerate((["10:00", "01:00"], ["07:50", "10:10"])):
        staged.append(log_rows(spark, [("m", at(x)) for x in batch], 2 * k))
        counts = lambda s: windowed_counts(decode_messages(s), "1 minute", "2 minutes")
        runs.append(staged.run(lambda s: sinks.append_parquet(counts(s), staged.path("out"), staged.path("ckpt"), "t_open")).runId)
    assert [(r["window_start"], r["count"]) for r in open_windows(spark, staged.path("ckpt")).collect()] == [(at("10:00"), 2)]
    assert spark.read.parquet(staged.path("out")).count() == 1
    rows = [r for run in runs for r in seen.of(run)]
    stamp = lambda t: None if t is None else t.strftime("%M:%S")
    assert [(stamp(r[2]), stamp(r[3]), r[4]) for r in rows if r[1]] == [("10:00", None, 0), ("10:10", "08:00", 1)]
    assert spark.createDataFrame(rows, metrics.EVENT_TIMES_SCHEMA).where("input_rows = 0").count() >= 1


def _offsets(spark, config, path):
    return sorted((r["partition"], r["offset"]) for r in read_log(spark, config, path=path, streaming=False).collect())


def test_offset_ranges(spark):
    path = f"{new_run_dir(spark, 't-offsets')}/log"
    log = log_rows(spark, [("m", at("00:01"))] * 40).withColumn("partition", (F.col("offset") % 4).cast("int"))
    write_log(log.withColumn("topic", F.when(F.col("partition") == 3, "other").otherwise("messages")), path=path, by_offset=True)
    every = [(k % 4, k) for k in range(40)]
    start = json.dumps({"messages": {"0": 8, "1": -2, "2": -1}})
    end = json.dumps({"messages": {"0": 20, "1": 9}})
    assert _offsets(spark, {"startingOffsets": start}, path) == sorted(x for x in every if x[0] in (1, 3) or x[0] == 0 and x[1] >= 8)
    assert _offsets(spark, {"startingOffsets": start, "endingOffsets": end}, path) == sorted(
        x for x in every if x[0] == 3 or x[0] == 0 and 8 <= x[1] < 20 or x[0] == 1 and x[1] < 9)
    assert _offsets(spark, {}, path) == sorted(every)
    assert _offsets(spark, {"startingOffsets": "latest"}, path) == _offsets(spark, {"endingOffsets": "earliest"}, path) == []
    assert offset_range({"startingOffsets": "earliest", "endingOffsets": "latest"}) is None
    for bad in ({"startingOffsets": "soon"}, {"startingOffsets": "[1]"}, {"endingOffsets": '{"messages": 3}'}):
        with pytest.raises(ValueError):
            offset_range(bad)
    for bad in ({"startingOffsets": "latest"}, {"endingOffsets": end}, {"startingOffsets": start}):
        with pytest.raises(ValueError):
            offset_range(bad, streaming=True)
    staged = StagedLog(spark, "t-offset-stream", {"startingOffsets": json.dumps({"messages": {"0": 30}})})
    staged.append(log)
    staged.run(lambda s: BatchTable(staged.path("out")).writer(s, staged.path("ckpt"), "t_offset_stream"))
    assert sorted((r["partition"], r["offset"]) for r in read_batches(spark, staged.path("out")).collect()) == sorted(
        x for x in every if x[0] or x[1] >= 30)


def test_clustered_results_are_read_from_their_first_files(spark):
    root = new_run_dir(spark, "t-clustered")
    rows = spark.range(1000).selectExpr("(id * 7919) % 1000 AS a", "CAST(id AS STRING) AS b")
    rows.write.parquet(f"{root}/rows")
    rows = spark.read.parquet(f"{root}/rows")
    clustered.write_clustered(rows, ("a", "b"), f"{root}/c", rows_per_file=100)
    first = clustered.first_rows(spark, f"{root}/c", ("a", "b"), 120)
    assert [r["a"] for r in first.collect()] == list(range(120))
    assert len(first.inputFiles()) <= 3 < len(spark.read.parquet(f"{root}/c/data").inputFiles())
    assert [r["a"] for part in clustered.in_order(spark, f"{root}/c") for r in part.collect()] == list(range(1000))
    clustered.write_clustered(rows.limit(0), ("a", "b"), f"{root}/none")
    assert clustered.first_rows(spark, f"{root}/none", ("a", "b"), 5).count() == 0


def test_records_are_read_with_the_schema_that_their_frame_names(spark):
    other = json.dumps({"type": "record", "name": "Message", "fields": [{"name": "id", "type": "long"}]})
    catalog = spark.createDataFrame([("messages-value", 1, 4, MESSAGE_AVRO_SCHEMA), ("messages-value", 2, 9, other), ("x-value", 1, 5, other)],
                                    "subject string, version int, id int, schema string")
    schemas = schemas_by_id(catalog, "messages-value")
    assert schemas == {4: MESSAGE_AVRO_SCHEMA, 9: other}
    log = log_rows(spark, [("a", at("00:01")), ("b", at("00:02"))])
    fields = spark.createDataFrame([(f"id-{k}", t, at("00:03")) for k, t in enumerate("xyz")], "id string, text string, createdAt timestamp")
    for schema_id in (4, 9, 77):
        framed = encode_frames(fields, schema_id=schema_id).select("value")
        log = log.unionByName(framed, allowMissingColumns=True)
    seen = Observation()
    rows = decode_messages(log, seen, schemas=schemas).select("id", "text").collect()
    assert sorted(map(tuple, rows)) == [("id-0", "x"), ("id-1", "y"), ("id-2", "z")]
    assert seen.get == {"received": 11, "skipped": 8}  # ids 1 and 77 aren't registered, 9 has another layout
    with pytest.raises(ValueError):
        decode_messages(log, schemas={9: other})
    with pytest.raises(LookupError):
        schemas_by_id(catalog, "none-value")
    letters = dead_letters(route(log, config=DeadLetterConfig(schemas=schemas)))
    assert letters.count() == 8


RULES = (Rule("text is b", lambda r: r["text"] != "b"),)


def test_processed_records_stay_as_they_came(spark):
    staged = StagedLog(spark, "t-router")
    log = log_rows(spark, [("a", at("00:01")), ("b", at("00:02"))])
    trailing = F.concat("value", F.lit(b"\x99"))  # a decoder ignores what follows the record
    log = log.withColumn("value", trailing)
    log = log.unionByName(log.limit(1).withColumn("value", F.lit(b"no frame")))
    staged.append(log)
    staged.run(lambda s: DeadLetterRouter(staged.path("routed"), RULES).writer(s, staged.path("ckpt"), "t_router"))
    rows = {(r["outcome"], r["text"]): r for r in spark.read.schema(router.TABLE_SCHEMA).parquet(staged.path("routed")).collect()}
    kept, broken, raw = rows[PROCESSED, "a"], rows[DEAD_LETTER, "b"], rows[DEAD_LETTER, None]
    assert kept["headers"] is None and kept["topic"] == "messages" and bytes(kept["value"]).endswith(b"\x99")
    assert broken["topic"] == "messages-dlt" and len(broken["headers"]) == 8 and not bytes(broken["value"]).endswith(b"\x99")
    assert bytes(raw["value"]) == b"no frame"
    assert router.processed(spark, staged.path("routed")).count() == processed(route(log, RULES)).count() == 1


def test_wrapped_messages_are_unwrapped(spark):
    config = DeadLetterConfig(listener="Some.method(String, int)")
    letters = dead_letters(route(log_rows(spark, [("b", at("00:02"))]), RULES, config), config)
    raw = letters.select(F.col("headers")[7]["value"].cast("string")).first()[0]
    assert raw == "Listener method 'Some.method(String, int)' threw exception; text is b"
    assert inspect(letters).first()["message"] == "text is b"
    assert inspect(letters, wrapper="^Listener ").first()["message"].startswith("method '")
    plain = dead_letters(route(log_rows(spark, [("b", at("00:02"))]), RULES))
    assert inspect(plain).first()["message"] == "text is b"


def test_a_table_that_is_no_table_is_an_error(spark):
    with pytest.raises(AnalysisException):
        fan_out_table(spark, new_run_dir(spark, "t-none"), "x")
