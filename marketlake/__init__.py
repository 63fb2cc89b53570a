"""marketlake: marketplace trust and payment-risk analytics as plain Spark DataFrame functions.

Layout
------
sources/    table loading, landing readers, sinks, fixture projections of the driver tables
functions/  column-expression builders (clip01, smoothing, minor units, ids, safe maths)
operators/  DataFrame -> DataFrame operators: Silver, Gold, quality, features, graph, labels,
            trust, policy, evaluation, evidence, models
plans/      composed jobs (gated medallion build, export document) and the query catalogue
streaming/  Structured Streaming ingest, dedupe and windowed velocity
"""

__version__ = "0.1.0"
