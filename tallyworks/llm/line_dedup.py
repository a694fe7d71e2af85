"""Line dedup over overlapping windows of three consecutive lines.

Every window is hashed, windows found more than once anywhere are looked up, and all but the first
occurrence (by doc_id, nulls last, then text hash, then line) are removed: the lines that any of
a document's later occurrences covers go, overlapping occurrences merging into one span.

Defined cases: a null text has no lines and stays null; a document under three lines has no window and stays;
a window of blank lines alone never counts; an emptied document becomes an empty text.
Rows that repeat doc_id and text are one document read twice and are treated alike. Lines end at
a line feed; each line is compared whole.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.llm.common import unpacked

WINDOW = 3


def _windows(lines: Column) -> Column:
    """(start, two hashes) for each window that isn't blank."""
    hashes = F.transform(lines, lambda s: F.struct(F.xxhash64(s).alias("h"), (F.trim(s) == "").alias("blank")))
    starts = F.when(F.size(lines) >= WINDOW, F.sequence(F.lit(0), F.size(lines) - WINDOW)).otherwise(
        F.array().cast("array<int>"))

    def window(held: Column, start: Column) -> Column:
        a, b, c = (F.get(held, start + k) for k in range(WINDOW))
        return F.struct(start.alias("start"), F.xxhash64(a["h"], b["h"], c["h"]).alias("w1"),
                        F.xxhash64(c["h"], F.lit(WINDOW), a["h"], b["h"]).alias("w2"),
                        (a["blank"] & b["blank"] & c["blank"]).alias("blank"))

    made = F.transform(F.array(hashes), lambda held: F.transform(starts, lambda s: window(held, s)))
    return F.filter(F.get(made, F.lit(0)), lambda w: ~w["blank"])


def occurrences(docs: DataFrame) -> DataFrame:
    """(w1, w2, at) for each window of each document; ``at`` orders occurrences."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.split("text", "\n").alias("lines"))
    found = lines.select("doc_id", "text_hash", F.explode(_windows(F.col("lines"))).alias("w"))
    return found.select("w.w1", "w.w2", F.struct(
        F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash", F.col("w.start").alias("start")).alias("at"))


CLEANED = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()),
                        T.StructField("n_removed", T.LongType())])


@F.pandas_udf(CLEANED)
def _without(texts: pd.Series, starts: pd.Series) -> pd.DataFrame:
    out = []
    for text, begins in zip(texts, starts, strict=True):
        if text is None:
            out.append((None, 0, 0))
            continue
        lines = text.split("\n")
        gone = bytearray(len(lines))
        for s in () if begins is None else begins:
            gone[s:s + WINDOW] = b"\1" * WINDOW
        removed = sum(gone)
        kept = text if not removed else "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)
        out.append((kept, len(lines), removed))
    return pd.DataFrame(out, columns=["text", "n_lines", "n_removed"])


def dedup(docs: DataFrame) -> DataFrame:
    """The documents with ``text`` cleaned, and n_lines and n_removed beside."""
    seen = occurrences(docs)
    repeated = seen.groupBy("w1", "w2").agg(F.min("at").alias("first"), F.max("at").alias("last")).filter(
        F.col("first") != F.col("last")).drop("last")
    later = seen.join(repeated, ["w1", "w2"]).filter(F.col("at") != F.col("first"))
    starts = later.groupBy(F.col("at.doc_id").alias("id"), F.col("at.text_hash").alias("text_hash")).agg(
        F.collect_set("at.start").alias("starts"))
    held = docs.alias("d").join(
        starts.alias("s"), F.col("d.doc_id").eqNullSafe(F.col("s.id"))
        & (F.xxhash64("d.text") == F.col("s.text_hash")), "left")
    cleaned = held.select(F.struct(*[F.col(f"d.{c}") for c in docs.columns]).alias("_row"),
                          _without(F.col("d.text"), F.col("s.starts")).alias("made"))
    return cleaned.select(*unpacked(docs, "text", "n_lines", "n_removed"), "made.text", "made.n_lines", "made.n_removed")
