"""ledgerline: a payments lakehouse written as Spark DataFrame / SQL jobs.

Layers
------
``sources``    raw CSV landing, batch stamping, idempotent bronze append,
               systematic sampling, the driver-table fixtures.
``functions``  column expressions (safe casts, keys, event clock, contract,
               masking, Z-order interleave).  Pure ``pyspark.sql.functions``.
``operators``  reusable distributed operators Spark lacks as one call:
               latest-wins dedup, global ntile, upsert, quality checks,
               file-layout maintenance, size-checked broadcast.
``plans``      the medallion models (silver, gold, measures, rollup,
               governance, lineage) and the dependency-ordered runner.
``streaming``  file-source ``availableNow`` ingest and micro-batch upsert.
"""

__all__ = ["session"]
