"""Spark-native analytics for repeated daily observations of trending items.

Layout:
  functions/  column expressions (parsing, lookup, rates, buckets)
  operators/  generic DataFrame -> DataFrame building blocks (top-k, deltas, tags, joins)
  plans/      the preparation job and the batch questions built from the operators
  sources/    readers and writers (CSV, Parquet, result tables, Kafka options, replay)
  streaming/  message parsing, windowed processors and replay-safe sinks
"""

from trendlens.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
