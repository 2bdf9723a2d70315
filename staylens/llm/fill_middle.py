"""Operator 12, fill-in-middle transformation of whole texts.

A text is cut into units (runs of letters A-Z and a-z; any other code point
alone). Two cut ranks per document, drawn from a hash of its id, part it into
prefix, middle and suffix, which are put together with sentinels:

    plain  the text itself
    psm    <P>prefix<S>suffix<M>middle
    spm    <S>suffix<P>prefix<M>middle

The cuts are ranks of units, the slices need code points. An indexable skip
list over the units gives one for the other: every link, on the bottom lane
and on each express lane above it, carries how many units and how many code
points it spans. ``place`` goes along a lane while the accumulated unit width
stays within the rank and then one lane down, so it ends at the rank exactly
and the code-point widths it has passed are the place of the cut. Heights come
from a hash of the unit's rank, so a task that is run again builds the same
list.

Scale: one pass over the texts in Arrow batches, no shuffle; a task holds a
batch and the lanes of one text.

Edge cases: null text is the empty text, which is plain; a null doc_id is hashed
as an empty string; repeated rows are transformed alike; texts that hold a
sentinel stay plain, so that every output can be taken apart again; other
columns are ignored; an empty table gives no rows.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.llm.words import mix64

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 documents about so many are transformed, and so many of those as spm.
TRANSFORM_PERCENT, SPM_PERCENT = 90, 20
#: One unit in 2 ** LANE_BITS of a lane also stands on the lane above.
LANE_BITS = 4
MADE = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


class SkipList:
    """Indexable skip list over units of the given code-point widths."""

    def __init__(self, widths: np.ndarray):
        self.n = len(widths)
        units = np.ones(self.n, np.int64)
        chars = np.asarray(widths, np.int64)
        #: bottom lane first: units and code points each link spans, and the
        #: place of each node on the lane below
        self.lanes = [(units, chars, None)]
        height = mix64(np.arange(self.n, dtype=np.uint64))
        level = np.uint64((1 << LANE_BITS) - 1)
        while len(units) > 2 << LANE_BITS:
            up = (height & level) == 0
            up[0] = True  # the head stands on every lane
            down = np.flatnonzero(up)
            if len(down) == len(units):
                break
            units, chars = np.add.reduceat(units, down), np.add.reduceat(chars, down)
            height = height[down] >> np.uint64(LANE_BITS)
            self.lanes.append((units, chars, down))

    def place(self, rank: int) -> int:
        """Code points before the unit of this rank (of all for rank n)."""
        at = seen = chars = 0
        for units, widths, down in reversed(self.lanes):
            while at < len(units) and seen + units[at] <= rank:
                seen += int(units[at])
                chars += int(widths[at])
                at += 1
            if at == len(units):
                break  # the end of a lane is the end of the text
            if down is not None:
                at = int(down[at])
        return chars


def unit_widths(text: str) -> np.ndarray:
    """Code points of each unit of a text, in order."""
    if not text:
        return np.zeros(0, np.int64)
    codes = (np.frombuffer(text.encode("ascii"), np.uint8) if text.isascii()
             else np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"))
    letter = ((codes >= 65) & (codes <= 90)) | ((codes >= 97) & (codes <= 122))
    begins = ~letter
    begins[0] = True
    begins[1:] |= ~letter[:-1]
    return np.diff(np.append(np.flatnonzero(begins), len(codes)))


def draws(doc_id) -> list[int]:
    """The first four 32-bit numbers of the hash of an id."""
    key = "1:" if doc_id is None else f"1:{doc_id}"
    return np.frombuffer(hashlib.sha256(key.encode()).digest()[:16], ">u4").tolist()


def transform_text(doc_id, text: str, transform_percent: int = TRANSFORM_PERCENT,
                   spm_percent: int = SPM_PERCENT) -> tuple:
    """(units, form, prefix code points, middle code points, output)."""
    widths = unit_widths(text)
    n = len(widths)
    h1, h2, h3, h4 = draws(doc_id)
    if not text or h3 % 100 >= transform_percent or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    list_ = SkipList(widths)
    begin, end = (list_.place(r) for r in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = text[:begin], text[begin:end], text[end:]
    if h4 % 100 < spm_percent:
        return n, "spm", begin, end - begin, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", begin, end - begin, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def transform(docs: DataFrame, transform_percent: int = TRANSFORM_PERCENT,
              spm_percent: int = SPM_PERCENT) -> DataFrame:
    """One row per document with its units, form, cuts and output text."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = [None if pd.isna(i) else int(i) for i in batch["doc_id"]]
            rows = [transform_text(i, t or "", transform_percent, spm_percent)
                    for i, t in zip(ids, batch["text"])]
            out = pd.DataFrame(rows, columns=["n", "form", "prefix_chars", "middle_chars", "output"])
            out.insert(0, "doc_id", pd.array(ids, "Int64"))
            yield out.astype({"prefix_chars": "Int64", "middle_chars": "Int64"})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, MADE)


def restored(output: str | Column, form: str | Column) -> Column:
    """The text that an output was made of. A transformed output holds each
    sentinel once: the text has none, and no end of one begins another."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    head = F.substring_index(output, MIDDLE, 1)
    middle = F.substring_index(output, MIDDLE, -1)
    body = F.substr(head, F.lit(len(PREFIX) + 1))
    psm = F.concat(F.substring_index(body, SUFFIX, 1), middle, F.substring_index(head, SUFFIX, -1))
    spm = F.concat(F.substring_index(head, PREFIX, -1), middle, F.substring_index(body, PREFIX, 1))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digest(docs: DataFrame) -> DataFrame:
    """The transformation with hashes in place of the texts."""
    return transform(docs).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored("output", "form").cast("binary"), 256).alias("restored_sha256"))


ORACLE = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || doc_id) AS h FROM documents
), u AS (
  SELECT *, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS units,
         ('0x' || h[1:8])::UBIGINT AS h1, ('0x' || h[9:16])::UBIGINT AS h2,
         ('0x' || h[17:24])::UBIGINT AS h3, ('0x' || h[25:32])::UBIGINT AS h4
  FROM d
), f AS (
  SELECT *, len(units)::BIGINT AS n,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90
              THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM u
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1))::BIGINT AS a, greatest(h1 % (n + 1), h2 % (n + 1))::BIGINT AS b FROM f
), s AS (
  SELECT *, array_to_string(units[1:a], '') AS p, array_to_string(units[a + 1:b], '') AS m,
         array_to_string(units[b + 1:n], '') AS s
  FROM c
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM s
"""
