"""tierflow: change-driven marketplace analytics on Spark.

Layers:
  sources/    CSV ingest with audit columns, load ledger, versioned tables
  functions/  column expressions: conform, keys, privacy, quality
  operators/  upsert, change feeds, SCD type 2
  plans/      KPI marts, dashboard reports, per-entity batch pipeline
  streaming/  Structured Streaming runner around the same pipeline
"""

__version__ = "0.1.0"
