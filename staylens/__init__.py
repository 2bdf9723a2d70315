"""staylens: a Spark-native layered pipeline for monthly short-stay listing
snapshots (raw -> staging -> star schema -> data marts -> CSV export).

Sub-packages:
  functions  - column expressions (exact six-digit ratios, month bucket, code parsing)
  sources    - CSV discovery and tolerant load, test-table adapter
  operators  - reusable DataFrame operators (fan-out join pre-aggregation,
               month series with LAG, argmax with ties, surrogate keys)
  plans      - star schema, marts, ad-hoc queries, layers, the full pipeline
  llm        - operators of a training-data pipeline (optional, see README)
"""

__version__ = "0.1.0"
