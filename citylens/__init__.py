"""citylens: Spark-native analytics for city telemetry streams.

Typed JSON decoding, declarative data-quality rules with a dead-letter
output, broadcast enrichment against static dimensions, event-time window
aggregates with watermarks, keyed incident detection, health advisories and
the reports built on them -- the same operators on batch tables and
Structured Streaming flows.
"""

__version__ = "0.1.0"
