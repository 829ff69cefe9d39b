"""Streaming semantics on small staged inputs: late rows, replay, listener,
several queries in one session."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from logweave.operators.decode import decode_messages
from logweave.operators.windows import windowed_counts
from logweave.schemas import COUNTS_KEY
from logweave.streaming import metrics, sinks
from logweave.streaming.runner import StagedLog
from tests.helpers import at, log_rows


def _counts(stream):
    return windowed_counts(decode_messages(stream), "1 minute", "2 minutes")


def _run_staged(spark, batches):
    staged = StagedLog(spark, "t-late")
    sink = sinks.ChangelogUpsert(staged.path("table"))
    build = lambda s: sink.writer(_counts(s), staged.path("ckpt"), "t_late_" + staged.root[-12:])
    off, dropped = 0, []
    for b in batches:
        staged.append(log_rows(spark, [("m", at(x)) for x in b], off))
        off += len(b)
        progress = staged.run(build).recentProgress  # a few micro-batches
        dropped.append(sum(sum(o.numRowsDroppedByWatermark for o in p.stateOperators) for p in progress))
    view = sinks.latest_view(spark, staged.path("table"), COUNTS_KEY)
    counts = {r["window_start"].strftime("%M:%S"): r["count"] for r in view.collect()}
    return counts, dropped


def test_late_rows_staged(spark):
    # Each staged batch runs as its own availableNow run, so its lateness
    # watermark is max(event time of earlier batches) - 2 min.
    counts, dropped = _run_staged(spark, [["10:00", "01:00"], ["07:50", "08:10"], ["10:30"], ["08:10", "05:00"]])
    assert counts == {"01:00": 1, "08:00": 2, "10:00": 2}
    assert dropped == [0, 1, 0, 1]


def test_late_rows_window_end_equal_to_watermark_is_dropped(spark):
    counts, dropped = _run_staged(spark, [["10:00"], ["10:01"], ["07:30", "08:00"]])
    assert counts == {"10:00": 2, "08:00": 1}
    assert dropped == [0, 0, 1]


def test_append_requires_watermark(spark):
    staged = StagedLog(spark, "t-nowm")
    staged.append(log_rows(spark, [("m", at("00:01"))]))
    counts = windowed_counts(decode_messages(staged.stream()), "1 minute")
    with pytest.raises(AnalysisException):
        sinks.append_parquet(counts, staged.path("out"), staged.path("ckpt"), "t_nowm").start()


def test_replayed_batch_leaves_table_unchanged(spark):
    staged = StagedLog(spark, "t-replay")
    rows = log_rows(spark, [("a", at("01:00")), ("a", at("02:00")), ("b", at("02:00"))])
    batch = windowed_counts(decode_messages(rows), "1 minute")
    sink = sinks.ChangelogUpsert(staged.path("table"))
    sink(batch, 0)
    before = sorted(map(tuple, sinks.latest_view(spark, staged.path("table"), COUNTS_KEY).collect()))
    sink(batch, 0)
    after = sorted(map(tuple, sinks.latest_view(spark, staged.path("table"), COUNTS_KEY).collect()))
    assert before == after and len(after) == 3


def test_skip_listener_and_three_queries_one_session(spark):
    rep = metrics.report_skips(spark)
    assert metrics.report_skips(spark) is None  # registered once per session
    staged = StagedLog(spark, "t-multi")
    good = log_rows(spark, [("a", at("00:01")), ("a", at("09:00"))])
    poison = spark.createDataFrame([(bytearray(b"not avro"),)], "value binary").select(
        *[F.lit(None).cast(f.dataType).alias(f.name) if f.name != "value" else F.col("value")
          for f in good.schema.fields])
    staged.append(good.unionByName(poison))
    decoded = decode_messages(staged.stream())
    counts = windowed_counts(decoded, "1 minute", "2 minutes")
    table = sinks.ChangelogUpsert(staged.path("table"))
    qs = [
        sinks.console(decoded, staged.path("c1"), "t_console").trigger(availableNow=True).start(),
        sinks.append_parquet(counts, staged.path("out"), staged.path("c2"), "t_parquet")
        .trigger(availableNow=True).start(),
        table.writer(counts, staged.path("c3"), "t_upsert").trigger(availableNow=True).start(),
    ]
    for q in qs:
        q.awaitTermination()
    spark.streams.resetTerminated()
    assert spark.read.parquet(staged.path("out")).count() == 1  # 00:01 window final
    assert sinks.latest_view(spark, staged.path("table"), COUNTS_KEY).count() == 2
    if rep is not None:
        import time
        time.sleep(1)
        assert rep.batches >= 1 and rep.skipped >= 1


def test_processing_time_trigger(spark):
    staged = StagedLog(spark, "t-trigger")
    staged.append(log_rows(spark, [("a", at("01:00")), ("b", at("09:00"))]))
    sink = sinks.ChangelogUpsert(staged.path("table"))
    q = sink.writer(_counts(staged.stream()), staged.path("ckpt"), "t_trigger").trigger(
        processingTime="1 second").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert sinks.latest_view(spark, staged.path("table"), COUNTS_KEY).count() == 2


def test_changelog_refuses_a_second_query(spark):
    staged = StagedLog(spark, "t-owner")
    staged.append(log_rows(spark, [("a", at("01:00"))]))
    table = staged.path("table")
    first = sinks.ChangelogUpsert(table)
    staged.run(lambda s: first.writer(_counts(s), staged.path("ckpt1"), "t_owner1"))
    staged.run(lambda s: first.writer(_counts(s), staged.path("ckpt1"), "t_owner1"))  # resume: same owner
    other = sinks.ChangelogUpsert(table)
    with pytest.raises(Exception, match="belongs to query"):
        staged.run(lambda s: other.writer(_counts(s), staged.path("ckpt2"), "t_owner2"))
    spark.streams.resetTerminated()


def _view(spark, table):
    return sorted(map(tuple, sinks.latest_view(spark, table, COUNTS_KEY).collect()))


def test_compact_keeps_latest_view_and_reads_nothing_older(spark):
    staged = StagedLog(spark, "t-compact")
    rows = log_rows(spark, [("a", at("01:00")), ("b", at("02:00"))])
    batch = windowed_counts(decode_messages(rows), "1 minute")
    table, base = staged.path("table"), staged.path("compacted")
    sink = sinks.ChangelogUpsert(table)
    sink(batch, 0)
    sink(batch.withColumn("count", F.col("count") + 1), 1)
    sinks.compact(spark, table, COUNTS_KEY, base)
    assert _view(spark, table) == _view(spark, base) and all(r[3] == 2 for r in _view(spark, base))
    sinks.ChangelogUpsert(base)(batch.withColumn("count", F.col("count") + 5).where("text = 'a'"), 2)  # the query goes on
    assert sorted(r[3] for r in _view(spark, base)) == [2, 6]
    folders = {f.split("batch_id=")[1].split("/")[0] for f in sinks.latest_view(spark, base, COUNTS_KEY).inputFiles()}
    assert folders == {str(sinks.BASE_BATCH), "2"}


def test_new_query_on_a_compacted_table_keeps_earlier_rows(spark):
    staged = StagedLog(spark, "t-adopt")
    staged.append(log_rows(spark, [("a", at("01:00")), ("b", at("02:00")), ("c", at("03:00"))]))
    table, base = staged.path("table"), staged.path("compacted")
    staged.run(lambda s: sinks.ChangelogUpsert(table).writer(_counts(s), staged.path("ckpt1"), "t_adopt1"))
    sinks.compact(spark, table, COUNTS_KEY, base)
    other = StagedLog(spark, "t-adopt2")
    other.append(log_rows(spark, [("d", at("04:00"))]))
    with pytest.raises(Exception, match="belongs to query"):
        other.run(lambda s: sinks.ChangelogUpsert(base).writer(_counts(s), other.path("ckpt0"), "t_adopt0"))
    spark.streams.resetTerminated()
    other.run(lambda s: sinks.ChangelogUpsert(base, adopt=True).writer(_counts(s), other.path("ckpt2"), "t_adopt2"))
    assert [r[2] for r in _view(spark, base)] == ["a", "b", "c", "d"]
    other.append(log_rows(spark, [("d", at("04:10"))], 5))
    other.run(lambda s: sinks.ChangelogUpsert(base).writer(_counts(s), other.path("ckpt2"), "t_adopt2"))  # now its own
    assert [r[3] for r in _view(spark, base)] == [1, 1, 1, 2]
    # a table with batches of another query is never adopted
    with pytest.raises(Exception, match="belongs to query"):
        other.run(lambda s: sinks.ChangelogUpsert(table, adopt=True).writer(_counts(s), other.path("ckpt3"), "t_adopt3"))
    spark.streams.resetTerminated()


def test_crash_after_write_replays_to_the_same_table(spark):
    staged = StagedLog(spark, "t-crash")
    crashed = []

    def crash_once(batch, batch_id):
        if batch_id >= 1 and not crashed:
            crashed.append(batch_id)
            raise RuntimeError("crash after writing, before the checkpoint commits")

    sink = sinks.ChangelogUpsert(staged.path("table"), on_written=crash_once)
    build = lambda s: sink.writer(_counts(s), staged.path("ckpt"), "t_crash")
    staged.append(log_rows(spark, [("a", at("01:00")), ("a", at("01:10"))]))
    staged.run(build)
    staged.append(log_rows(spark, [("a", at("01:20")), ("b", at("02:00"))], 2))
    with pytest.raises(Exception, match="crash after writing"):
        staged.run(build)
    spark.streams.resetTerminated()
    staged.run(build)
    assert crashed and [(r[2], r[3]) for r in _view(spark, staged.path("table"))] == [("a", 3), ("b", 1)]


def test_metrics_of_more_than_a_hundred_micro_batches(spark):
    staged = StagedLog(spark, "t-many", {"maxFilesPerTrigger": "1"})
    good = log_rows(spark, [("m", at("00:01"))] * 2)
    poison = good.withColumn("value", F.lit(b"no frame"))
    staged.append(good.unionByName(poison).crossJoin(spark.range(110)).repartitionByRange(110, "id").drop("id"))
    totals = metrics.run_totals(spark)
    query = staged.run(lambda s: decode_messages(s).writeStream.format("noop").option(
        "checkpointLocation", staged.path("ckpt")).queryName("t_many"))
    sums, batches = totals.of(query.runId)
    assert batches > 100 and sums == {"received": 440, "skipped": 220}


def test_dead_letter_apps(spark):
    from logweave.plans import apps
    from logweave.sources.log import write_log
    from logweave.streaming import router

    staged = StagedLog(spark, "t-dlt-app")
    good = log_rows(spark, [("ok", at("01:00")), ("", at("01:00"))])
    staged.append(good.unionByName(good.limit(1).withColumn("value", F.lit(b"no frame"))))
    cfg = {"log.path": staged.log_path, "trigger.interval": "availableNow", "router.table.path": staged.path("routed"),
           "router.checkpoint.location": staged.path("c-router"), "dead.letter.path": staged.path("dlt"),
           "dead.letter.checkpoint.location": staged.path("c-inspect")}
    apps.start_dead_letter_route(spark, cfg).awaitTermination()
    assert router.processed(spark, cfg["router.table.path"]).count() == 1
    letters = router.dead_letters(spark, cfg["router.table.path"])
    assert letters.count() == 2
    write_log(letters, path=cfg["dead.letter.path"])
    query = apps.start_dead_letter_inspect(spark, cfg)  # prints on the JVM's own output
    query.awaitTermination()
    spark.streams.resetTerminated()
    assert query.exception() is None and sum(p.numInputRows for p in query.recentProgress) == 2


def test_aggregation_app(spark):
    from logweave.plans import apps

    staged = StagedLog(spark, "t-app")
    staged.append(log_rows(spark, [("a", at("01:00")), ("a", at("01:30")), ("b", at("09:00"))]))
    cfg = {
        "log.path": staged.log_path,
        "trigger.interval": "availableNow",
        "checkpoint.location": staged.path("c-console"),
        "parquet.output.path": staged.path("parquet"),
        "parquet.checkpoint.location": staged.path("c-parquet"),
        "upsert.table.path": staged.path("table"),
        "upsert.checkpoint.location": staged.path("c-upsert"),
    }
    qs = apps.start_aggregation(spark, cfg)
    for q in qs[1:]:
        q.awaitTermination()
    qs[0].processAllAvailable()
    qs[0].stop()
    spark.streams.resetTerminated()
    top = apps.inspect_parquet(spark, cfg["parquet.output.path"]).collect()
    assert [(r["text"], r["count"]) for r in top] == [("a", 2)]
    table = apps.read_counts_table(spark, cfg["upsert.table.path"]).collect()
    assert [(r["text"], r["count"]) for r in table] == [("a", 2), ("b", 1)]


def test_late_rows_continuous_run(spark):
    # All four batches present up front (one file each) and consumed in one
    # availableNow run, one file per micro-batch: no idle trigger between
    # data batches, so lateness uses the previous micro-batch's watermark
    # (one batch more lag than staged runs): 07:50 is counted here.
    staged = StagedLog(spark, "t-continuous", {"maxFilesPerTrigger": "1"})
    off = 0
    for b in [["10:00", "01:00"], ["07:50", "08:10"], ["10:30"], ["08:10", "05:00"]]:
        staged.append(log_rows(spark, [("m", at(x)) for x in b], off).coalesce(1))
        off += len(b)
    sink = sinks.ChangelogUpsert(staged.path("table"))
    q = sink.writer(_counts(staged.stream()), staged.path("ckpt"), "t_continuous").trigger(availableNow=True).start()
    q.awaitTermination()
    view = sinks.latest_view(spark, staged.path("table"), COUNTS_KEY)
    counts = {r["window_start"].strftime("%M:%S"): r["count"] for r in view.collect()}
    assert counts == {"01:00": 1, "07:00": 1, "08:00": 2, "10:00": 2}
