"""dispatchkit: last-mile order-fulfilment analytics on Spark DataFrames.

Sub-packages:
  sources    typed ingestion, dataset registry, CSV/Parquet sinks, publication gate
  functions  Column -> Column scalar helpers (timestamps, geography, staffing arithmetic)
  operators  joins, aggregates, windows, sets and lifecycle composites over DataFrames
  quality    data-quality rules as data, compiled to a few DataFrame plans
  streaming  the same event logic on Structured Streaming
  plans      bindings of the operators to the supplied test tables (queries + oracle SQL)
"""

__all__ = ["session"]
