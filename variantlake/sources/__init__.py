"""Sources and sinks: lake paths and Parquet I/O, Kafka envelopes, fixtures."""
