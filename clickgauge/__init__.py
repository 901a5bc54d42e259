"""clickgauge: daily KPIs and anomaly scoring for hit-level event tables, on Spark.

Python builds expressions and DataFrame plans; rows are handled by Spark's built-in operators. Only the
training-data operators of ``llm/`` run code of their own over Arrow batches, where their docstrings say so.
"""
