"""benchlake: a Spark-first engine for question-answering benchmark analytics.

Layers (medallion):

* ``sources``   – readers/writers for bronze payloads, CSV, JSON(L), Parquet and named sources.
* ``functions`` – Column-expression building blocks (text cleaning, ids, grading, prompt templates).
* ``operators`` – reusable DataFrame operators (keep-first dedup, exact order statistics,
  stratified sampling, work lists, batch inference, marts, dashboard views, quality checks).
* ``plans``     – end-to-end flows (bronze -> silver -> responses -> gold) and the adapters that
  express every operator over the driver's parquet tables.
* ``streaming`` – incremental, idempotent response merge with Structured Streaming.
"""

__version__ = "0.1.0"
