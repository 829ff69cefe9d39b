"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame
computed over the whole given tables (streaming ones run over staged
batches of the whole log and return a batch read of their output)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codec import decode_frames, encode_frames
from ..operators.deadletter import DeadLetterConfig, Rule, dead_letter_fields, dead_letters, inspect, processed, route
from ..operators.decode import decode_messages
from ..operators.dedupe import dedupe
from ..operators.windows import windowed_counts
from ..schemas import COUNTS_KEY
from ..session import new_run_dir, require_utc
from ..sources import fixtures
from ..sources.log import read_log, write_log
from ..streaming import clustered, keyed, metrics, router, sinks, state
from ..streaming.batches import BatchTable, Branch, FanOut, Measured, MetricsTable, fan_out_table
from ..streaming.router import DeadLetterRouter
from ..streaming.runner import StagedLog
from ..streaming.state import state_session

# Queries run on the events data: ~4.3 min between events at sf0.01, so the
# 1 min / 2 min defaults would make near-empty windows; use 1 h / 2 h.
WINDOW = "1 hour"
WATERMARK = "2 hours"
STAGES = 4          # ranges of the in-order streaming queries, a run each
INSPECT_ROWS = 1000  # rows of a file of the clustered counts
METRIC_STAGES = 3   # event_id ranges of the decode metrics
LATE_STAGES = 4     # staged batches for the late-data query
LATE_MOD = 13       # event_id % 13 = 0 arrives one batch late
#: What a decoded event must meet to be processed.
EVENT_TYPES = ("click", "purchase", "signup", "view")
RULES = (Rule("unknown event type", lambda r: r["text"].isin(*EVENT_TYPES)),
         Rule("created before noon", lambda r: F.hour(r["createdAt"]) >= 12))


def window_counts_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages per text per hour over the decoded log (poison dropped)."""
    return windowed_counts(decode_messages(fixtures.log_records(spark, sf_dir), observe=None), WINDOW)


def decode_permissive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded messages with their log positions; undecodable records dropped."""
    return decode_messages(fixtures.log_records(spark, sf_dir), observe=None)


def encode_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event encoded as a framed message and decoded again."""
    msgs = fixtures.messages(spark, sf_dir)
    enc = encode_frames(msgs, out="value", schema_id=fixtures.SCHEMA_ID)
    dec = decode_frames(enc.select("value"))
    return dec.select("record.id", "record.text", "record.createdAt")


def encode_roundtrip_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole document texts (long, multi-byte) through the codec."""
    require_utc(spark)
    docs = fixtures.read_table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("text"),
        F.timestamp_millis(F.col("doc_id") * 1000).alias("createdAt"),
    )
    dec = decode_frames(encode_frames(docs, out="value").select("value"))
    return dec.select(
        F.col("record.id").alias("id"),
        F.length("record.text").alias("n_chars"),
        F.octet_length("record.text").alias("n_bytes"),
        F.sha2(F.col("record.text"), 256).alias("text_sha256"),
        F.col("record.createdAt").alias("createdAt"),
    )


def _counts_stream(stream: DataFrame) -> DataFrame:
    return windowed_counts(decode_messages(stream), WINDOW, WATERMARK)


def decode_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per range of event ids: records received and skipped, from the table that the query's
    batches wrote. Each range is one batch of a run of its own on the same checkpoint."""
    staged = StagedLog(spark, "decode-metrics")
    table = MetricsTable(staged.path("metrics"))

    def build(stream):  # a new object for each run, as after a restart
        return Measured(BatchTable(staged.path("messages")), table).writer(stream, staged.path("ckpt"), "decode_metrics_" + staged.root[-12:])

    staged.feed(fixtures.staged_batches(fixtures.log_records(spark, sf_dir, keep_event_id=True), METRIC_STAGES), build)
    return table.rows(spark).select(F.col("batch_id").cast("int").alias("batch"), "received", "skipped")


def _in_order(spark: SparkSession, sf_dir: str, name: str) -> tuple[StagedLog, list[DataFrame]]:
    """A log that is fed range by range in event-time order. A range is written by as many
    tasks as its scan has, and consumed before the next is written."""
    return StagedLog(spark, name), fixtures.staged_batches(fixtures.log_records(spark, sf_dir, keep_event_id=True), STAGES)


def window_counts_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Watermarked hourly counts through the append-mode Parquet sink."""
    staged, batches = _in_order(spark, sf_dir, "append")
    path, ckpt = staged.path("out"), staged.path("ckpt")
    staged.feed(batches, lambda stream: sinks.append_parquet(_counts_stream(stream), path, ckpt, "append_" + staged.root[-12:]))
    return spark.read.parquet(path)


def _upserted(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A keyed table with the counts of the whole log, in buckets by day."""
    staged, batches = _in_order(spark, sf_dir, name)
    sink = keyed.KeyedTable(staged.path("table"), COUNTS_KEY, keyed.daily("window_start"), compact_every=STAGES)
    staged.feed(batches, lambda stream: sink.writer(_counts_stream(stream), staged.path("ckpt"), f"{name}_{staged.root[-12:]}"))
    return staged.path("table")


def window_counts_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update-mode counts into the replay-safe keyed table, read with its open deltas."""
    return keyed.view(spark, _upserted(spark, sf_dir, "upsert"), COUNTS_KEY)


def upsert_table_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyed result table as a reader sees it after a compaction, ordered by window, text."""
    table = _upserted(spark, sf_dir, "table-read")
    keyed.compact(spark, table, COUNTS_KEY)
    return keyed.view(spark, table, COUNTS_KEY).orderBy("window_start", "text")


def late_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts when some records arrive one staged batch late: a late record
    is dropped iff its window ended at or before the previous watermark."""
    staged = StagedLog(spark, "late")
    sink = sinks.ChangelogUpsert(staged.path("table"))
    records = fixtures.log_records(spark, sf_dir, keep_event_id=True)
    staged.feed(fixtures.staged_batches(records, LATE_STAGES, LATE_MOD),
                lambda stream: sink.writer(_counts_stream(stream), staged.path("ckpt"), "late_" + staged.root[-12:]))
    return sinks.latest_view(spark, staged.path("table"), COUNTS_KEY)


def resume_from_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append-mode counts from runs of the same query: each run but the first
    resumes from the checkpoint of the one before at the next offset."""
    staged, batches = _in_order(spark, sf_dir, "resume")
    path, ckpt = staged.path("out"), staged.path("ckpt")

    def build(stream):
        return sinks.append_parquet(_counts_stream(stream), path, ckpt, "resume_" + staged.root[-12:])

    staged.feed(batches, build)
    if any(later <= earlier for earlier, later in zip(staged.batches, staged.batches[1:], strict=False)):
        raise RuntimeError("resume_from_checkpoint: a run did not continue the batch ids")
    return spark.read.parquet(path)


def parquet_inspect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First 100 rows of the append-mode output by window_start, text, clustered by these: read from its first files."""
    path = f"{new_run_dir(spark, 'inspect')}/counts"
    clustered.write_clustered(window_counts_append(spark, sf_dir), ("window_start", "text"), path, INSPECT_ROWS)
    return clustered.first_rows(spark, path, ("window_start", "text"), 100)


def watermark_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event time by batch, from the query's own progress: the greatest so far unseen, and the watermark that held."""
    seen = metrics.event_times(spark)
    staged = StagedLog(spark, "progress")
    sink = sinks.ChangelogUpsert(staged.path("table"))
    rows = []
    records = fixtures.log_records(spark, sf_dir, keep_event_id=True)
    for batch in fixtures.staged_batches(records, LATE_STAGES, LATE_MOD):
        staged.append(batch)
        run = staged.run(lambda stream: sink.writer(_counts_stream(stream), staged.path("ckpt"), "progress_" + staged.root[-12:]))
        rows += [r for r in seen.of(run.runId) if r[1]]  # without the batches that only move the watermark
    frame = spark.createDataFrame([(k, *r[2:4]) for k, r in enumerate(rows)], "batch int, max_event_time timestamp, watermark timestamp")
    return frame


def processed_ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that decode and meet all rules."""
    return processed(route(fixtures.log_records(spark, sf_dir), RULES))


def dead_letter_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead-letter rows with their headers decoded to typed columns."""
    routed = route(fixtures.log_records(spark, sf_dir), RULES)
    return dead_letter_fields(dead_letters(routed), fixtures.HEADER)


def dead_letter_inspect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters published to a dead-letter log table, read back as raw
    records with headers (no decode on read), and inspected one by one."""
    dlt_path = f"{new_run_dir(spark, 'dlt')}/log"
    config = DeadLetterConfig(listener="messages.on_message")  # its messages come wrapped; inspect unwraps them
    write_log(dead_letters(route(fixtures.log_records(spark, sf_dir), RULES, config), config), path=dlt_path)
    return inspect(read_log(spark, path=dlt_path, streaming=False))


def dead_letter_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The consumer side as a stream: the log routed micro-batch by
    micro-batch; the dead letters of the table it wrote, decoded."""
    staged, batches = _in_order(spark, sf_dir, "router")
    table = staged.path("routed")
    staged.feed(batches, lambda stream: DeadLetterRouter(table, RULES).writer(stream, staged.path("ckpt"), "router_" + staged.root[-12:]))
    return dead_letter_fields(router.dead_letters(spark, table), fixtures.HEADER)


def dedupe_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of a log with resends, each id once within the delay; state in RocksDB."""
    staged = StagedLog(state_session(spark), "dedupe")
    path, ckpt = staged.path("out"), staged.path("ckpt")

    def build(stream):
        first = dedupe(decode_messages(stream), WATERMARK).select("id", "text", "createdAt")
        return sinks.append_parquet(first, path, ckpt, "dedupe_" + staged.root[-12:])

    staged.feed(fixtures.batches_with_resends(fixtures.log_records(spark, sf_dir, keep_event_id=True), STAGES), build)
    return spark.read.parquet(path)


def open_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the append-mode sink doesn't show yet: the windows in the query's state after the last batch."""
    session = state_session(spark)
    staged = StagedLog(session, "open-windows")
    path, ckpt = staged.path("out"), staged.path("ckpt")
    staged.feed(fixtures.staged_batches(fixtures.log_records(spark, sf_dir, keep_event_id=True), STAGES),
                lambda stream: sinks.append_parquet(_counts_stream(stream), path, ckpt, "open_" + staged.root[-12:]))
    return state.open_windows(session, ckpt)


def log_offset_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole log read in three consecutive offset ranges, whose bounds differ by partition."""
    path = f"{new_run_dir(spark, 'offsets')}/log"
    write_log(fixtures.log_records(spark, sf_dir), path=path, by_offset=True)
    bounds = fixtures.offset_bounds(spark, sf_dir)
    out = None
    for k, (start, end) in enumerate(zip(["earliest", *bounds], [*bounds, "latest"], strict=True)):
        log = read_log(spark, {"startingOffsets": start, "endingOffsets": end}, path=path, streaming=False)
        part = decode_messages(log, observe=None).select(F.lit(k).alias("slice"), "id", "text", "createdAt", "partition", "offset")
        out = part if out is None else out.unionByName(part)
    return out


def fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log read once for three targets (processed messages, hourly counts of each batch,
    dead letters); what each of them holds, by hour."""
    staged, batches = _in_order(spark, sf_dir, "fan-out")
    root = staged.path("targets")
    branches = [Branch("messages", processed), Branch("counts", lambda routed: windowed_counts(processed(routed), WINDOW)),
                Branch("dead_letters", dead_letters)]
    staged.feed(batches, lambda stream: FanOut(root, lambda log: route(log, RULES), branches).writer(
        stream, staged.path("ckpt"), "fan_out_" + staged.root[-12:]))
    messages, counts, letters = (fan_out_table(spark, root, b.name) for b in branches)
    hour = F.date_trunc("hour", "createdAt")
    held = [("messages", messages.groupBy(hour.alias("hour"), F.col("text").alias("what")).agg(F.count("*").alias("n"))),
            ("counts", counts.groupBy(F.col("window_start").alias("hour"), F.col("text").alias("what")).agg(F.sum("count").alias("n"))),
            ("dead_letters", dead_letter_fields(letters).groupBy(F.date_trunc("hour", "original_timestamp").alias("hour"),
                                                                 F.col("exception_message").alias("what")).agg(F.count("*").alias("n")))]
    return reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("target"), "hour", "what", "n") for name, df in held])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "window_counts_batch": window_counts_batch,
    "decode_permissive": decode_permissive,
    "encode_roundtrip": encode_roundtrip,
    "encode_roundtrip_documents": encode_roundtrip_documents,
    "decode_metrics": decode_metrics,
    "window_counts_append": window_counts_append,
    "window_counts_upsert": window_counts_upsert,
    "upsert_table_read": upsert_table_read,
    "late_data": late_data,
    "resume_from_checkpoint": resume_from_checkpoint,
    "parquet_inspect": parquet_inspect,
    "processed_ok": processed_ok,
    "dead_letter_table": dead_letter_table,
    "dead_letter_inspect": dead_letter_inspect,
    "dead_letter_stream": dead_letter_stream,
    "dedupe_by_id": dedupe_by_id,
    "open_windows": open_windows,
    "log_offset_range": log_offset_range,
    "fan_out": fan_out,
    "watermark_progress": watermark_progress,
}
