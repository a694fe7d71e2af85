"""Spelling variants: words one edit apart, found through permuterm rotations.

A word is closed by a terminator and turned through all its rotations. Two words that differ by one
replaced code point have rotations that agree in all but the last one; a word with one code point more
has a rotation whose prefix is a whole rotation of the shorter word. So every rotation stands in the order twice,
as a whole and as the prefix that skips its last code point (the edited one). Equal strings lie next to
each other there: such a group is one prefix range, and it is scanned for neighbours. The rows carry
only rotation, skipped code point and count; a word is read back from its rotation.

A group holds at most one whole rotation and one word for each letter of the alphabet, whatever the corpus
holds, and no pairs are written: each member takes the group's best word, or the second best where it is that
one itself. In a run of equal letters only the first counts as deleted, so two words meet in exactly
one group and counts add up. Forms are followed by pointer doubling: an occurrence count at least
doubles along each step, so chains are short.

Words are counted over whole texts, partly before any shuffle, so a frequent word is one row of each task.

Defined cases: a null or empty text has no runs; a null doc_id reads as an empty string before the
colon; rows that repeat count again; an empty table gives no words; other columns are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import whole_text
from tallyworks.workspace import Workspace

RUN = r"[a-zÀ-ÿ]+"
END = "$"
#: A run whose hash this number divides loses a code point; words have this length and count at least.
EVERY, LEAST_LENGTH, LEAST_COUNT = 97, 5, 3
#: A form is at least so many times as frequent as its variant.
RATIO = 2


def edited_runs(docs: DataFrame) -> DataFrame:
    """Every run of letters, lower-cased in A-Z, some of them short of a code point."""
    lowered = F.translate(whole_text(docs), string.ascii_uppercase, string.ascii_lowercase)
    runs = docs.select(
        F.coalesce(docs["doc_id"].cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(lowered, F.lit(RUN), F.lit(0))).alias("run"))
    hashed = runs.select("run", F.crc32(F.concat(F.col("id"), F.lit(":"), F.col("run"))).alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    return hashed.select(F.when(F.col("h") % EVERY == 0, shorter).otherwise(F.col("run")).alias("word"))


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n: words of the least length with the least count."""
    words = edited_runs(docs).filter(F.char_length("word") >= LEAST_LENGTH)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST_COUNT)


def rotations(words: DataFrame) -> DataFrame:
    """rotation, skipped, n: each rotation whole (skipped null) and without its last code point.

    The rotation that ends in the terminator is not cut: the terminator is no letter to edit.
    """
    size = F.char_length("word")
    turned = words.select("n", "word", F.posexplode(F.sequence(F.lit(0), size)).alias("at", "_"))
    left, right = F.substring("word", F.lit(1), F.col("at")), F.substring("word", F.col("at") + 1, size)
    whole = turned.select(F.concat(right, F.lit(END), left).alias("rotation"), "n")
    both = F.array(
        F.struct(F.col("rotation").alias("rotation"), F.lit(None).cast("string").alias("skipped")),
        F.struct(F.substring("rotation", F.lit(1), F.char_length("rotation") - 1).alias("rotation"),
                 F.right("rotation", F.lit(1)).alias("skipped")))
    return whole.select("n", F.inline(both)).filter(F.col("skipped").isNull() | (F.col("skipped") != END))


def _member() -> Column:
    """A rotation's word with its rank (most frequent first, then code-point order), and whether the skipped
    letter is the first of its run."""
    left, right = F.substring_index("rotation", END, -1), F.substring_index("rotation", END, 1)
    skipped = F.coalesce("skipped", F.lit(""))
    return F.struct(
        (-F.col("n")).alias("rank"), F.concat(left, skipped, right).alias("word"),
        F.col("skipped").isNull().alias("is_whole"),
        (F.right(left, F.lit(1)) != skipped).alias("first_of_run"))


def neighbours(words: DataFrame) -> DataFrame:
    """word, n_near and best (rank, word of the most frequent neighbour), for words that have neighbours."""
    groups = rotations(words).groupBy("rotation").agg(F.collect_list(_member()).alias("all")).filter(F.size("all") > 1)
    ordered = groups.select(
        F.array_sort(F.filter("all", lambda m: ~m["is_whole"])).alias("cut"),
        F.filter("all", lambda m: m["is_whole"]).alias("whole"))
    ordered = ordered.withColumn("shorter", F.filter("cut", lambda m: m["first_of_run"]))

    def name(member: Column) -> Column:
        return F.when(member.isNotNull(), F.struct(member["rank"].alias("rank"), member["word"].alias("word")))

    def of_cut(m: Column) -> Column:
        first, whole = F.get("cut", F.lit(0)), F.get("whole", F.lit(0))
        other = F.when(m["word"] == first["word"], name(F.get("cut", F.lit(1)))).otherwise(name(first))
        source = F.when(m["first_of_run"], name(whole))
        return F.struct(
            m["word"].alias("word"), (F.size("cut") - 1 + F.when(source.isNotNull(), 1).otherwise(0)).alias("near"),
            F.least(other, source).alias("best"))

    def of_whole(m: Column) -> Column:
        return F.struct(m["word"].alias("word"), F.size("shorter").alias("near"),
                        name(F.get("shorter", F.lit(0))).alias("best"))

    found = ordered.select(F.inline(F.concat(F.transform("cut", of_cut), F.transform("whole", of_whole))))
    return found.filter(F.col("near") > 0).groupBy("word").agg(
        F.sum("near").alias("n_near"), F.min("best").alias("best"))


def variants(docs: DataFrame, space: Workspace) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the documents."""
    words = space.settle(word_counts(docs), "words")
    near = words.join(neighbours(words), "word", "left")
    form_n = -F.col("best.rank")
    frequent = form_n >= RATIO * F.col("n")
    formed = space.settle(near.select(
        "word", F.when(frequent, F.col("best.word")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(frequent, form_n).alias("form_n")), "forms")
    roots = followed(formed, space)
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def followed(formed: DataFrame, space: Workspace) -> DataFrame:
    """word, root of the words that have a form. Each round doubles how far the open pointers reach; one that
    ends where no form follows is done, stays for look-ups and is not joined again, so a root that
    many words share is no hot key."""
    has_form = formed.filter(F.col("form").isNotNull())
    opened, done = has_form.select("word", F.col("form").alias("next")), None
    while True:
        known = opened.withColumn("ends", F.lit(False))
        if done is not None:
            known = known.unionByName(done.withColumn("ends", F.lit(True)))
        ahead = known.select(F.col("word").alias("next"), F.col("next").alias("after"), "ends")
        stepped = opened.join(ahead, "next", "left").select(
            "word", F.coalesce("after", "next").alias("next"), F.coalesce("ends", F.lit(True)).alias("ends"))
        stepped = space.settle(stepped, "links")
        ended = stepped.filter("ends").select("word", "next")
        done = ended if done is None else done.unionByName(ended)
        opened = stepped.filter("not ends").select("word", "next")
        if opened.isEmpty():
            return done.select("word", F.col("next").alias("root"))
