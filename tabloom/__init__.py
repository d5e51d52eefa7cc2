"""tabloom: DataFrame-in / DataFrame-out feature engineering on Spark.

Sub-packages
------------
functions  column-expression helpers (semantics, text expressions, arrays)
operators  DataFrame operators (projection, joins, aggregation, windows,
           time-series, basket, encoding, text, vocabulary, vectorising,
           embeddings, screening, models, metrics)
sources    readers / writers and adapters from the test tables
plans      registered queries with their SQL oracles
streaming  micro-batch runner for the operators
"""
__version__ = "0.1.0"
