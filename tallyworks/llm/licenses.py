"""License scans through a positional index of rare words.

A template is a run of words with a mandatory key phrase inside. The index lists for each word of a key phrase the
templates and offsets where it stands. The words of all key phrases are ranked by how few documents of the corpus hold
them (inverse document frequency). A file ranks the license words it holds; a template whose key words it holds all is
looked up by the two of them that rank highest in the file. Position minus offset is where a template
would start; the starts that both words give are intersected, and there the key phrase is verified whole and the
template's other words are compared at their relative positions. As a key phrase can't occur without all of its
words, ranks decide the work and never the result.

Words are runs of digits, lower-cased A-Z and anything beyond ASCII. Defined cases: a null text has
no words; ``first_word`` and ``last_word`` are null without a base phrase; the score is the best
share of a template's words standing at their places around a verified key phrase, else 0.
Only built-in functions are used.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import packed, unpacked, whole_text

MADE = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    words: str
    key: str
    base: bool = False

    @property
    def all_words(self) -> list[str]:
        return self.words.split()

    @property
    def key_words(self) -> list[str]:
        return self.key.split()

    @property
    def key_at(self) -> int:
        words, key = self.all_words, self.key_words
        return next(i for i in range(len(words)) if words[i:i + len(key)] == key)


def base(label: str, phrase: str) -> Template:
    return Template(label, phrase, phrase, base=True)


TEMPLATES = (
    base("mit", "under the mit license"),
    base("apache-2", "apache license version 2"),
    base("cc-by-nc", "cc by nc"),
    Template("apache-2", "licensed under the apache license version 2 0", "the apache license version 2 0"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification",
             "redistribution and use in source and binary forms"),
    Template("cc-by", "licensed under a creative commons attribution 4 0 international license",
             "creative commons attribution 4 0"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "under cc by nc 4 0"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("cc0", "dedicated to the public domain under cc0 1 0", "under cc0"),
    Template("gpl", "under the terms of the gnu general public license", "gnu general public license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy",
             "permission is hereby granted free of charge"),
    Template("mpl-2", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    Template("agpl", "under the terms of the gnu affero general public license", "gnu affero general public license"),
    Template("boost", "distributed under the boost software license version 1 0", "boost software license"),
    Template("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license",
             "creative commons attribution noncommercial"),
    Template("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    Template("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license",
             "creative commons attribution sharealike"),
    Template("epl", "made available under the terms of the eclipse public license", "eclipse public license"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
             "permission to use copy modify and or distribute this software"),
    Template("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    Template("proprietary", "all rights reserved no part may be reproduced", "all rights reserved"),
)


def words_of(text: Column) -> Column:
    lowered = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lowered, NOT_WORD), "")


def document_counts(words: DataFrame, templates: Sequence[Template]) -> dict[str, int]:
    """In how many documents each key-phrase word stands: one number for each word of the templates."""
    known = sorted({w for t in templates for w in t.key_words})
    held = words.select(F.explode(F.array_intersect(F.array(*map(F.lit, known)), "_words")).alias("word"))
    counts = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return {w: counts.get(w, 0) for w in known}


def ranked_words(counts: dict[str, int]) -> list[str]:
    """The license words from the highest inverse document frequency down."""
    return sorted(counts, key=lambda w: (counts[w], w))


def _strings(values: Sequence[str]) -> Column:
    return F.array(*map(F.lit, values))


def scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """The frame's columns and n_words, n_base, first_word, last_word, base_labels, labels, score."""
    rows = docs.select(packed(docs), words_of(whole_text(docs)).alias("_words"))
    by_rank = _strings(ranked_words(document_counts(rows.select("_words"), templates)))
    keys = F.array(*[_strings(t.key_words) for t in templates])
    wholes = F.array(*[_strings(t.all_words) for t in templates])
    key_at = F.array(*[F.lit(t.key_at) for t in templates])
    labels = _strings([t.label for t in templates])
    firm = F.array(*[F.lit(t.base) for t in templates])
    none = F.array().cast("array<int>")

    def upto(n: Column) -> Column:
        return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(none)

    # which templates the file can hold, each with its license words as the file ranks them
    rows = rows.withColumn("_held", F.array_intersect(by_rank, F.col("_words")))
    possible = F.filter(F.lit(list(range(len(templates)))), lambda t: F.size(F.array_except(F.get(keys, t), F.col("_held"))) == 0)
    looked = F.transform(possible, lambda t: F.struct(
        t.alias("t"), F.slice(F.array_intersect(F.col("_held"), F.get(keys, t)), 1, 2).alias("rare")))
    rows = rows.withColumn("_looked", F.when(F.size("_held") > 0, looked))
    rare = F.array_distinct(F.flatten(F.col("_looked.rare")))
    hits = F.filter(upto(F.size("_words")), lambda i: F.array_contains(rare, F.get("_words", i)))
    rows = rows.withColumn("_hits", F.when(F.size("_looked") > 0, hits).otherwise(none))

    def starts(t: Column, word: Column) -> Column:
        """Where template ``t`` would start, by each place of one of its key words."""
        offsets = F.filter(upto(F.size(F.get(keys, t))), lambda k: F.get(F.get(keys, t), k) == word)
        places = F.filter("_hits", lambda i: F.get("_words", i) == word)
        return F.array_distinct(F.flatten(F.transform(
            offsets, lambda k: F.transform(places, lambda i: i - k - F.get(key_at, t)))))

    def verified(t: Column, start: Column) -> Column:
        at = start + F.get(key_at, t)
        return F.when(at >= 0, F.slice("_words", at + 1, F.size(F.get(keys, t))) == F.get(keys, t)).otherwise(F.lit(False))

    def agreeing(t: Column, start: Column) -> Column:
        whole = F.get(wholes, t)
        same = F.filter(upto(F.size(whole)), lambda k: F.get("_words", start + k) == F.get(whole, k))
        return F.size(same) / F.size(whole)

    def found(look: Column) -> Column:
        t, rare = look["t"], look["rare"]
        both = F.when(F.size(rare) > 1, F.array_intersect(starts(t, F.get(rare, 0)), starts(t, F.get(rare, 1)))).otherwise(
            starts(t, F.get(rare, 0)))
        sure = F.filter(both, lambda start: verified(t, start))
        return F.transform(sure, lambda start: F.struct(t.alias("t"), start.alias("at"), agreeing(t, start).alias("share")))

    empty = F.array().cast("array<struct<t:int,at:int,share:double>>")
    rows = rows.withColumn("_found", F.coalesce(F.flatten(F.transform("_looked", found)), empty))
    rows = rows.withColumn("_base", F.filter("_found", lambda x: F.get(firm, x["t"])))

    def names(column: str) -> Column:
        return F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(column, lambda x: F.get(labels, x["t"])))))

    return rows.select(
        *unpacked(docs, *MADE), F.size("_words").cast("long").alias("n_words"), F.size("_base").cast("long").alias("n_base"),
        F.array_min("_base.at").cast("long").alias("first_word"), F.array_max("_base.at").cast("long").alias("last_word"),
        names("_base").alias("base_labels"), names("_found").alias("labels"),
        F.coalesce(F.array_max("_found.share"), F.lit(0.0)).alias("score"))
