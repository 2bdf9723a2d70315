"""Training-data operators: search, mixing, dedup, scoring, extraction, packing.

One module per operator; ``catalog`` registers one query per operator plus the
corpus pipeline. Nothing outside this package imports it (except the guarded
import in ``__spark_entry__``).
"""
