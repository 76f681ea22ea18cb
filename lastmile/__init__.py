"""PySpark pipeline for last-mile parcel delivery analytics.

Entry points:

* ``lastmile.plans.pipeline``: ``run_all`` / ``run_layers`` (landing -> bronze ->
  silver -> gold -> export on paths, with observed step counts; optional
  incremental bronze and catalog registration); also ``python -m lastmile``.
* ``lastmile.operators``: DataFrame -> DataFrame building blocks
  (``clean``, ``integrity``, ``enrich``, ``kpi``, ``ranking``, ``quality``, ``merge``).
* ``lastmile.functions``: column expressions (parsing, cleaning, rounding, ratios).
* ``lastmile.sources``: raw file readers/writers, layer tables, exports, the test feed.
* ``lastmile.streaming``: append ingestion of a landing folder with Structured Streaming.
* ``lastmile.plans.catalog``: the named queries used by ``__spark_entry__``.
"""
