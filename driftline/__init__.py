"""driftline: drift monitoring and tabular classification pipelines on Spark.

Subpackages:
    sources    scans and sinks (Parquet, CSV with NA tokens, JSON, models)
    functions  column expressions (statuses, hashes, tolerant casts, p-value)
    operators  ranking, drift, prep, features, training, evaluation, runs
    plans      composed jobs and the registered queries (+ oracle SQL)
    streaming  stream scoring, model hot swap, windowed drift
"""

__version__ = "0.1.0"
