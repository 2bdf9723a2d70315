"""Corpus pipeline: five stages from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's documents. All but the last return the
columns of ``documents``; each works on all rows that its predecessor kept.

1. quality      documents that the quality classifier rejects (score under 0.3) go
2. line_dedup   lines on five sites or more stay in one document only; a document
                that loses all its text this way goes
3. ngram_join   of the documents that link at Jaccard 0.8 of their 5-word shingles, the
                smallest doc_id stays
4. mixing       documents are put in the order of the source mix (all stay)
5. packing      documents become ids, packed in sequences of 2048 run by run of the
                mix, which is worked out again (files do not promise their order):
                every stretch of sequences holds the sources by their weights

Rows without doc_id cannot link and stay; an empty table passes as one.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm import jaccard_join, line_dedup, mixing, packing, quality
from staylens.llm.common import stored, table, visible

KEEP_SCORE = 0.3
NEAR_WIDTH, NEAR_PERCENT = 5, 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    visible(spark)
    model = quality.fitted_model(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality.score_column(spark, model)(F.col("text")) >= KEEP_SCORE)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    count = "lines_removed" + "_" * len(docs.columns)  # no column of the table
    emptied = (F.col(count) > 0) & (F.trim("text") == "")
    return (line_dedup.dedup_lines(docs, count_column=count)
            .where(~F.coalesce(emptied, F.lit(False))).select(*docs.columns))


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    visible(spark)
    others = jaccard_join.link_components(docs, NEAR_WIDTH, NEAR_PERCENT).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(others, "doc_id", "left_anti").select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.in_order(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    visible(spark)
    placed = mixing.place(docs.select("doc_id", "source", "text"))
    return packing.pack_documents(placed.select("row.doc_id", "row.text", "slot", "offset"),
                                  order=("slot", "offset"))


STAGES = [("quality", quality_stage), ("line_dedup", line_dedup_stage), ("ngram_join", ngram_join_stage),
          ("mixing", mixing_stage), ("packing", packing_stage)]

#: Classifier and subword ids cannot be said in SQL; tests hold the stages
#: against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored in the shared scratch folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
