"""Structured Streaming jobs: enrichment (arrival or event-time batches) and
live rolling extremes.  Each job reads Kafka-shaped records (Kafka or the
record-folder twin), keeps its progress in a checkpoint under the shared
folder and writes with idempotent sinks."""
