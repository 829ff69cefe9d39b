"""Schemas shared by sources, operators and sinks."""

from pyspark.sql import types as T

# Kafka source row shape (Spark's public Kafka source schema, headers included).
HEADER_TYPE = T.StructType([
    T.StructField("key", T.StringType(), True),
    T.StructField("value", T.BinaryType(), True),
])

LOG_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType(), True),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("topic", T.StringType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("timestampType", T.IntegerType(), True),
    T.StructField("headers", T.ArrayType(HEADER_TYPE, True), True),
])

# Avro schema text of the message record, as a registry would hold it.
MESSAGE_AVRO_SCHEMA = (
    '{"type":"record","name":"Message","fields":['
    '{"name":"id","type":"string"},'
    '{"name":"text","type":"string"},'
    '{"name":"createdAt","type":{"type":"long","logicalType":"timestamp-millis"}}]}'
)

COUNTS_KEY = ["window_start", "window_end", "text"]

# Dead-letter header names (must equal what consumers of a
# dead-letter topic expect).
DLT_ORIGINAL_TOPIC = "kafka_dlt-original-topic"
DLT_ORIGINAL_PARTITION = "kafka_dlt-original-partition"
DLT_ORIGINAL_OFFSET = "kafka_dlt-original-offset"
DLT_ORIGINAL_TIMESTAMP = "kafka_dlt-original-timestamp"
DLT_ORIGINAL_GROUP = "kafka_dlt-original-consumer-group"
DLT_EXCEPTION_FQCN = "kafka_dlt-exception-fqcn"
DLT_EXCEPTION_CAUSE_FQCN = "kafka_dlt-exception-cause-fqcn"
DLT_EXCEPTION_MESSAGE = "kafka_dlt-exception-message"
