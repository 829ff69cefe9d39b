"""Command line: ``python -m logweave COMMAND CONFIG [ARGS]``.

Commands:
  console                      print decoded messages as they arrive
  aggregation                  console + windowed counts to Parquet and a keyed table
  parquet-inspect              first 100 window counts of the Parquet output
  dead-letter-route            check records, write the router table, publish dead letters
  dead-letter-inspect          print dead letters in typed columns as they arrive
  late-data TEXT SECONDS_AGO   publish one message whose createdAt is back-dated

CONFIG is a properties file (``key=value`` lines, ``#`` comments) with the
keys described in ``logweave.plans.apps``; ``log.path`` selects a Parquet
log table instead of Kafka; streaming state is kept in RocksDB unless
``state.store`` is ``memory``.  The Spark session comes from the environment
(spark-submit or a cluster's defaults).
"""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession


def read_properties(path: str) -> dict[str, str]:
    config: dict[str, str] = {}
    with open(path, encoding="utf-8") as f:
        for raw in f:
            line = raw.strip()
            if not line or line.startswith(("#", "!")):
                continue
            sep = min((i for i in (line.find("="), line.find(":")) if i >= 0), default=-1)
            if sep < 0:
                config[line] = ""
            else:
                config[line[:sep].strip()] = line[sep + 1:].strip()
    return config


def publish_late(spark: SparkSession, config: dict[str, str], text: str, seconds_ago: int) -> None:
    from .operators.produce import framed, new_messages
    from .plans.apps import registered_schema
    from .sources.log import write_log

    texts = spark.createDataFrame([(text,)], "text string")
    records = framed(new_messages(texts, seconds_ago=seconds_ago), schema_id=registered_schema(spark, config)[0])
    write_log(records, config, path=config.get("log.path"))


def main(argv: list[str]) -> int:
    if len(argv) < 2:
        print(__doc__)
        return 2
    command, config = argv[0], read_properties(argv[1])
    from .plans import apps
    from .streaming.state import ROCKSDB

    builder = SparkSession.builder.appName(f"logweave-{command}")
    if config.get("state.store", "rocksdb") == "rocksdb":
        builder = builder.config(map=ROCKSDB)
    spark = builder.getOrCreate()

    if command == "console":
        apps.start_console(spark, config)
        spark.streams.awaitAnyTermination()
    elif command == "aggregation":
        apps.start_aggregation(spark, config)
        spark.streams.awaitAnyTermination()
    elif command == "parquet-inspect":
        apps.inspect_parquet(spark, config["parquet.output.path"]).show(100, truncate=False)
    elif command == "dead-letter-route":
        apps.start_dead_letter_route(spark, config).awaitTermination()
    elif command == "dead-letter-inspect":
        apps.start_dead_letter_inspect(spark, config).awaitTermination()
    elif command == "late-data" and len(argv) == 4:
        publish_late(spark, config, argv[2], int(argv[3]))
    else:
        print(__doc__)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
