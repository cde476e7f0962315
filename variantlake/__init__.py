"""variantlake: A/B-experiment analytics as Spark DataFrame operators.

Layers: ``sources`` (lake paths, Kafka envelope decode, JSON parse, fixtures),
``functions`` (domains and column expressions), ``operators`` (Silver, quality,
Gold), ``plans`` (job runners and the registered queries) and ``streaming``
(Bronze ingest with Structured Streaming).
"""

__all__ = ["functions", "operators", "plans", "sources", "streaming"]
