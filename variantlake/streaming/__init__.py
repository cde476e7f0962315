"""Structured Streaming ingest of the Kafka topics into Bronze."""
