"""Ready-made streaming applications configured by a plain dict.

Keys follow the usual property names: ``bootstrap.servers``, ``topic`` and
``kafka.*`` for Kafka (or ``log.path`` for a Parquet log table),
``window.duration``, ``watermark.delay``, ``trigger.interval``,
``checkpoint.location``, ``parquet.output.path``,
``parquet.checkpoint.location``, ``upsert.table.path``,
``upsert.checkpoint.location`` and, for a database sink, ``jdbc.url``,
``jdbc.table``, ``jdbc.user``, ``jdbc.password``, ``jdbc.driver``.
``maxFilesPerTrigger``, ``maxBytesPerTrigger`` (log table) and
``maxOffsetsPerTrigger`` (Kafka) bound a micro-batch.  ``schema.catalog.path``
names a catalog table from which the topic's latest schema is taken, and
``avro.package`` = true says that Spark's Avro package is deployed.  Dead letters:
``router.table.path``, ``router.checkpoint.location``, ``dead.letter.topic`` (also
publish to this topic), ``dead.letter.path`` (a log table to inspect),
``dead.letter.checkpoint.location``.  Every query is named and has its own
checkpoint.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..operators.deadletter import REQUIRED, DeadLetterConfig, Rule, inspect
from ..operators.decode import DECODE_METRICS, decode_messages
from ..operators.windows import windowed_counts
from ..schemas import COUNTS_KEY, MESSAGE_AVRO_SCHEMA
from ..session import require_utc
from ..sources.catalog import latest_schema, schemas_by_id, value_subject
from ..sources.log import read_log
from ..streaming import keyed, metrics, sinks
from ..streaming.router import DeadLetterRouter

# Default window, lateness and trigger.
DEFAULTS = {
    "window.duration": "1 minute",
    "watermark.delay": "2 minutes",
    "trigger.interval": "10 seconds",
}


def _get(config: dict[str, str], key: str) -> str:
    return config.get(key, DEFAULTS.get(key))


def registered_schema(spark: SparkSession, config: dict[str, str], topic: str | None = None) -> tuple[int, str]:
    """(id, text) of the topic's latest schema in the catalog; the message schema and
    the configured ``schema.id`` when no catalog is configured."""
    if "schema.catalog.path" in config:
        return latest_schema(spark.read.parquet(config["schema.catalog.path"]), value_subject(topic or config["topic"]))
    return int(config.get("schema.id", "1")), MESSAGE_AVRO_SCHEMA


def writer_schemas(spark: SparkSession, config: dict[str, str]) -> dict[int, str] | None:
    """The topic's schemas by id when a catalog is configured: each record is read with its own."""
    if "schema.catalog.path" not in config:
        return None
    return schemas_by_id(spark.read.parquet(config["schema.catalog.path"]), value_subject(config["topic"]))


def avro_package(config: dict[str, str]) -> bool:
    return config.get("avro.package", "false").lower() == "true"


def decoded_stream(spark: SparkSession, config: dict[str, str]) -> DataFrame:
    """Decoded messages from the configured log; undecodable records are
    dropped, counted per batch and reported by the skip listener."""
    require_utc(spark)
    metrics.report_skips(spark)
    return decode_messages(read_log(spark, config, path=config.get("log.path")), observe=DECODE_METRICS,
                           schema=registered_schema(spark, config)[1], avro_package=avro_package(config),
                           schemas=writer_schemas(spark, config))


def windowed(decoded: DataFrame, config: dict[str, str]) -> DataFrame:
    return windowed_counts(decoded, _get(config, "window.duration"), _get(config, "watermark.delay"))


def _trigger(writer: DataStreamWriter, config: dict[str, str]) -> DataStreamWriter:
    interval = _get(config, "trigger.interval")
    if interval == "availableNow":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval)


def start_console(spark: SparkSession, config: dict[str, str], name: str = "log_console") -> StreamingQuery:
    """Decoded messages printed as they arrive (append, default trigger)."""
    return sinks.console(decoded_stream(spark, config), config["checkpoint.location"], name).start()


CHECKPOINT_KEYS = ("checkpoint.location", "parquet.checkpoint.location", "upsert.checkpoint.location")


def check_checkpoints(config: dict[str, str], keys=CHECKPOINT_KEYS) -> None:
    """One checkpoint per query: a second query started on a checkpoint in
    use stops the first, and offsets or state would be mixed up."""
    seen: dict[str, str] = {}
    for k in keys:
        loc = config.get(k)
        if loc is None:
            raise ValueError(f"missing {k}")
        norm = loc.rstrip("/")
        if norm in seen:
            raise ValueError(f"{k} and {seen[norm]} share checkpoint {loc}; give each query its own")
        seen[norm] = k


def start_aggregation(spark: SparkSession, config: dict[str, str]) -> list[StreamingQuery]:
    """Console pass-through plus windowed counts to append-only Parquet and to
    a keyed table (deltas and buckets, or a database through MERGE when jdbc.url is
    set).  Each query reads the log on its own, with its own checkpoint."""
    check_checkpoints(config)
    queries = [start_console(spark, config)]
    counts = windowed(decoded_stream(spark, config), config)
    queries.append(_trigger(sinks.append_parquet(
        counts, config["parquet.output.path"], config["parquet.checkpoint.location"], "log_counts_parquet"),
        config).start())
    if config.get("jdbc.url"):
        props = {k: config[f"jdbc.{k}"] for k in ("user", "password", "driver") if f"jdbc.{k}" in config}
        target = sinks.JdbcUpsert(config["jdbc.url"], config["jdbc.table"], COUNTS_KEY, ["count"], props, query="log_counts_jdbc")
        writer = (counts.writeStream.outputMode("update")
                  .option("checkpointLocation", config["upsert.checkpoint.location"])
                  .queryName("log_counts_jdbc").foreachBatch(target))
    else:
        target = keyed.KeyedTable(config["upsert.table.path"], COUNTS_KEY, keyed.daily("window_start"))
        writer = target.writer(counts, config["upsert.checkpoint.location"], "log_counts_upsert")
    queries.append(_trigger(writer, config).start())
    return queries


def start_dead_letter_route(spark: SparkSession, config: dict[str, str], rules: Sequence[Rule] = REQUIRED) -> StreamingQuery:
    """The consumer: every record checked and written to the router table, dead
    letters also to ``dead.letter.topic`` when that is set."""
    require_utc(spark)
    topic = config.get("dead.letter.topic")
    schema_id, schema = registered_schema(spark, config)
    cfg = DeadLetterConfig(topic=topic or f"{config.get('topic', 'messages')}-dlt", schema_id=schema_id,
                           schema=schema, avro_package=avro_package(config), schemas=writer_schemas(spark, config))
    router = DeadLetterRouter(config["router.table.path"], rules, cfg, publish=config if topic else None)
    log = read_log(spark, config, path=config.get("log.path"))
    return _trigger(router.writer(log, config["router.checkpoint.location"], "log_dead_letters"), config).start()


def dead_letter_log(config: dict[str, str]) -> dict[str, str]:
    """The config with the dead-letter topic as its topic."""
    return config | ({"topic": config["dead.letter.topic"]} if "dead.letter.topic" in config else {})


def start_dead_letter_inspect(spark: SparkSession, config: dict[str, str]) -> StreamingQuery:
    """Dead letters, from their topic or log table, printed in typed columns as they arrive."""
    require_utc(spark)
    dlt = read_log(spark, dead_letter_log(config), path=config.get("dead.letter.path"))
    rows = inspect(dlt, registered_schema(spark, config)[1], avro_package(config), writer_schemas(spark, config))
    return _trigger(sinks.console(rows, config["dead.letter.checkpoint.location"], "dead_letter_inspect"), config).start()


def inspect_parquet(spark: SparkSession, path: str, n: int = 100) -> DataFrame:
    """First ``n`` window counts of the Parquet output, by window and text (a top-n over the whole
    output; ``clustered.first_rows`` reads only the first files of a clustered copy)."""
    return spark.read.parquet(path).orderBy("window_start", "text").limit(n)


def read_counts_table(spark: SparkSession, path: str) -> DataFrame:
    """The keyed counts table as a reader sees it, by window and text."""
    return keyed.view(spark, path, COUNTS_KEY).orderBy(F.col("window_start"), F.col("text"))
