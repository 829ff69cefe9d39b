"""Sources: Kafka-shaped log readers, the events fixture mapping, the schema catalog."""
