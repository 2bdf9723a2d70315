"""Operator 3, line dedup by distinct-site spread (DataFrame functions only).

A line (text between line feeds, outer spaces trimmed) that stands on at least
``min_sites`` distinct sites (column ``source``) is cross-site boilerplate: the
document with the smallest ``doc_id`` keeps it, all others lose it.

One HyperLogLog sketch of the sites per line hash merges by aggregation; only
lines whose estimate lies near the threshold get an exact distinct count.

Edge cases: null text stays null and has no lines; blank lines never spread; a
null source is no site; a null doc_id sorts first; rows with the same doc_id
share their decisions; the keeping document keeps every occurrence; a document
that loses all its lines stays with empty text. Other columns pass through
(``n_chars`` follows the new text) and may have any names. An empty table gives
an empty result.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.common import stored

MIN_SITES = 5
#: 2**12 registers: 1.6 % standard error. Estimates within 10 % (at least 1.5)
#: of the threshold, over six standard errors, are counted exactly.
LG_REGISTERS = 12
MARGIN = 0.1


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, source, line_hash), each line of a document once."""
    hashes = F.transform(F.split("text", "\n"), lambda x: F.when(
        F.trim(x) != "", F.xxhash64(F.trim(x))))
    return docs.where("text is not null").select(
        "doc_id", "source", F.explode(F.array_distinct(F.array_compact(hashes))).alias("line_hash"))


def line_spread(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """One row per line hash on >= min_sites sites: (line_hash, keeper), keeper
    being a struct of the smallest doc_id that has the line."""
    lines = _lines(docs)
    sketched = (lines.groupBy("line_hash")
                .agg(F.hll_sketch_agg("source", F.lit(LG_REGISTERS)).alias("sketch"),
                     F.min(F.struct("doc_id")).alias("keeper"))
                .select("line_hash", "keeper", F.hll_sketch_estimate("sketch").alias("sites")))
    slack = max(1.5, MARGIN * min_sites)
    # stored, so that the joins below stand apart from the aggregation: Spark can
    # then split a very common line's rows or broadcast the few candidates
    candidates = stored(sketched.where(F.col("sites") >= min_sites - slack), "lines")
    near = candidates.where(F.col("sites") <= min_sites + slack).select("line_hash")
    short = (lines.join(near, "line_hash", "left_semi")
             .select("line_hash", "source").distinct()
             .groupBy("line_hash").agg(F.count("source").alias("n"))
             .where(F.col("n") < min_sites).select("line_hash"))
    return stored(candidates.select("line_hash", "keeper").join(short, "line_hash", "left_anti"), "spread")


def dedup_lines(docs: DataFrame, min_sites: int = MIN_SITES,
                count_column: str = "lines_removed") -> DataFrame:
    """``docs`` with boilerplate lines removed, plus how many (in ``count_column``,
    which takes the place of a column with its name)."""
    lost = (_lines(docs).join(line_spread(docs, min_sites), "line_hash")
            .where(~F.col("doc_id").eqNullSafe(F.col("keeper.doc_id")))
            .groupBy("doc_id").agg(F.collect_set("line_hash").alias("lost"))
            .select(F.col("doc_id").alias("lost_id"), "lost"))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    joined = whole.join(lost, F.col("row.doc_id").eqNullSafe(F.col("lost_id")), "left")
    split = F.split("row.text", "\n")
    kept = F.filter(split, lambda x: ~F.array_contains(F.col("lost"), F.xxhash64(F.trim(x)))
                    | (F.trim(x) == ""))
    hit = F.col("lost").isNotNull() & F.col("row.text").isNotNull()
    joined = (joined.withColumn("kept", F.when(hit, kept))
              .withColumn("text", F.when(hit, F.array_join("kept", "\n")).otherwise(F.col("row.text"))))
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("bigint")}
    cols = [new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns if c != count_column]
    removed = F.when(hit, F.size(split) - F.size("kept")).otherwise(F.lit(0)).cast("bigint")
    return joined.select(*cols, removed.alias(count_column))


#: The same rows by exact counting.
ORACLE = f"""
WITH parts AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents WHERE text IS NOT NULL),
spread AS (
  SELECT trim(line) AS line, min(doc_id) AS keeper FROM parts WHERE trim(line) <> ''
  GROUP BY 1 HAVING count(DISTINCT source) >= {MIN_SITES}),
kept AS (
  SELECT p.doc_id, string_agg(p.line, chr(10) ORDER BY p.pos) FILTER (s.line IS NULL OR s.keeper = p.doc_id) AS text,
         count(*) FILTER (s.line IS NOT NULL AND s.keeper <> p.doc_id) AS lines_removed
  FROM parts p LEFT JOIN spread s ON s.line = trim(p.line) GROUP BY 1)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       d.lang, d.source,
       CASE WHEN d.text IS NULL THEN NULL ELSE length(coalesce(k.text, '')) END AS n_chars,
       coalesce(k.lines_removed, 0) AS lines_removed
FROM documents d LEFT JOIN kept k USING (doc_id)
"""
