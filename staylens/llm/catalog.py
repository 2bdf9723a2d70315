"""One registered query per operator, over its whole table."""
from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from staylens.llm import (fill_middle, filter_audit, fingerprints, html_text, jaccard_join, line_dedup, lm_score,
                          mixing, packing, pieces, quality, topk_search, toxicity)
from staylens.llm.common import table, visible
from staylens.session import ensure_checkpoint_dir

Query = Callable[[SparkSession, str], DataFrame]


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best inner products of every 20th vector against all others."""
    return topk_search.top_k(table(spark, sf_dir, "embeddings"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot of every document in the mix of sources to square-root weights."""
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "source", "block", "slot", "offset")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that spread over five sites or more."""
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document by the attention model and by word counts."""
    return lm_score.score_documents(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and link component of every document at Jaccard 0.85."""
    return jaccard_join.link_components(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of 2048 ids."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op11_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document and the text decoded from them."""
    return pieces.digest(table(spark, sf_dir, "documents"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-middle form of every document."""
    return fill_middle.digest(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in each of their orders."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of corpus_pipeline over all documents."""
    return corpus_pipeline.run(spark, sf_dir)


def _query(f: Query) -> Query:
    @functools.wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        visible(spark)
        ensure_checkpoint_dir(spark)
        return f(spark, sf_dir)
    return run


def queries() -> dict[str, Query]:
    own = (op1_topk_search, op2_mixing, op3_line_dedup, op4_toxicity, op5_html_text,
           op6_lm_score, op7_quality, op8_ngram_join, op9_packing,
           op10_fingerprints, op11_pieces, op12_fill_middle, op13_filter_audit, pipeline)
    return {f.__name__: _query(f) for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op1_topk_search": topk_search.ORACLE, "op2_mixing": mixing.ORACLE, "op3_line_dedup": line_dedup.ORACLE,
            "op8_ngram_join": jaccard_join.ORACLE, "op12_fill_middle": fill_middle.ORACLE,
            "op13_filter_audit": filter_audit.ORACLE}
