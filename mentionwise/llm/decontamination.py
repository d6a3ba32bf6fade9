"""Benchmark decontamination by a positional inverted index over the training text.

A window of consecutive item words is looked up from its two rarest terms in the
corpus. Terms are counted first; then the index is written, for these anchor terms
only: one list of positions for each document and term. The lists of the two terms,
each shifted by its offset in the window, are intersected; what is left is compared
with the words of the document, so a match is exact. The same lists give proximity
matches: the two terms within ``span`` words of each other (a window of one term:
the term occurs). Texts are shuffled only for documents with a candidate.

Terms are keyed by a 64-bit hash in the index and compared as words at the end.
Everything is DataFrame expressions. Sides are broadcast after a count only.

Edge cases: a null text has no words and is clean; an item of fewer words than a
window is one window, an item without words none; a null item_id makes hits but is
not named; rows are told apart by a hash of doc_id and text, so repeated rows fare
alike and rows with a null doc_id are judged by their own text; terms that are
equally rare go by their words; empty tables give no rows or clean rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionwise.session import freeze

# fixed value: what a word is made of, after lower-casing A-Z: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
# character by character: Java looks those up in a table, while it tests ranges one after the other
WORD = "[^" + "".join(f"\\x{ord(c):02X}" for c in map(chr, range(128)) if c not in string.digits + string.ascii_lowercase) + "]+"
# a counted side of at most so many rows of a few numbers is broadcast
BROADCAST_ROWS = 1_000_000


def lower_ascii(text: Column) -> Column:
    plain = F.octet_length(text) == F.char_length(text)
    other = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(plain, F.lower(text)).otherwise(other)


def words(text: Column) -> Column:
    """The words of a text; an empty array for null."""
    return F.coalesce(F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(0)), F.array())


def small(df: DataFrame) -> DataFrame:
    """``df``, broadcast if a count puts it under the bound."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def windows(items: DataFrame, size: int) -> DataFrame:
    """``phrase_id, phrase, items``: the distinct windows of ``items`` (``item_id, text``)."""
    cut = items.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    cut = cut.select("item_id", "w", F.explode(starts).alias("i"))
    cut = cut.select("item_id", F.slice("w", F.col("i"), F.lit(size)).alias("phrase"))
    found = cut.groupBy("phrase").agg(F.collect_set("item_id").alias("items"))
    return found.withColumn("phrase_id", F.sha2(F.array_join("phrase", " "), 256))


def terms(phrases: DataFrame) -> DataFrame:
    """``phrase_id, offset, word, term``: the words of the windows, and their hashes."""
    each = phrases.select("phrase_id", F.posexplode("phrase").alias("offset", "word"))
    return each.withColumn("term", F.xxhash64("word"))


def row_key() -> Column:
    """What tells rows apart: equal in doc_id and text, equal in everything found here."""
    return F.xxhash64("doc_id", "text")


def occurrences(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``key, pos, term``: where the terms of ``vocabulary`` stand in ``docs``. No shuffle."""
    each = docs.select(row_key().alias("key"), F.posexplode(words(F.col("text"))).alias("pos", "word"))
    return each.select("key", "pos", F.xxhash64("word").alias("term")).join(small(vocabulary), "term")


def anchors(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """The two rarest different terms of each window that can occur at all; ``counts``: ``term, n``.

    ``term, offset`` and ``term2, offset2`` (null where a window has one term only).
    """
    counted = terms(phrases).join(small(counts), "term", "left")
    by_rarity = F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "offset", "term")))
    ranked = counted.groupBy("phrase_id").agg(by_rarity.alias("t"))
    first = F.col("t")[0]
    others = F.filter("t", lambda t: t["word"] != F.col("t")[0]["word"])
    ranked = ranked.where(first["n"] > 0).withColumn("other", F.get(others, F.lit(0)))
    return ranked.select(
        "phrase_id", first["term"].alias("term"), first["offset"].alias("offset"),
        F.col("other.term").alias("term2"), F.col("other.offset").alias("offset2"),
    )


def positional_index(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``key, term, at``: the positions of each term of ``vocabulary`` in each document."""
    return occurrences(docs, vocabulary).groupBy("key", "term").agg(F.collect_set("pos").alias("at"))


def intersect(index: DataFrame, rare: DataFrame, span: int) -> DataFrame:
    """``key, phrase_id, starts, near``: windows by the lists of their two rarest terms.

    ``starts``: where both stand at the distance that the window has them, so that it may
    begin there. ``near``: they stand within ``span`` words of each other.
    """
    seen = index.join(small(rare), "term")
    begin = F.transform("at", lambda p: p - F.col("offset"))
    alone = seen.where("term2 is null").select("key", "phrase_id", begin.alias("starts"), F.lit(True).alias("near"))
    second = index.select(F.col("key").alias("key2"), F.col("term").alias("other"), F.col("at").alias("at2"))
    second = second.join(small(rare.select(F.col("term2").alias("other")).distinct()), "other", "left_semi")
    met = seen.where("term2 is not null").join(second, (F.col("key") == F.col("key2")) & (F.col("term2") == F.col("other")))
    around = F.flatten(F.transform("at", lambda p: F.sequence(p - span, p + span)))
    met = met.select(
        "key", "phrase_id",
        F.array_intersect(begin, F.transform("at2", lambda p: p - F.col("offset2"))).alias("starts"),
        F.arrays_overlap(around, F.col("at2")).alias("near"),
    )
    return alone.unionByName(met.where("near"))


def matches(docs: DataFrame, items: DataFrame, size: int = 10, span: int = 10) -> tuple[DataFrame, DataFrame]:
    """Rows of ``docs`` with ``key`` and ``found``, and ``key, near`` of documents in proximity of items.

    ``found``: array of (start, width, items), every exact occurrence of a window.
    ``near``: the items of windows in proximity, exact ones included.
    """
    if span < size:
        raise ValueError("span must not be below size: exact matches are found within it")
    phrases = freeze(windows(items, size), "windows")
    vocabulary = terms(phrases).select("term").distinct()
    counts = freeze(occurrences(docs, vocabulary).groupBy("term").agg(F.count(F.lit(1)).alias("n")), "term-counts")
    rare = freeze(anchors(phrases, counts), "anchors")
    needed = rare.select("term").union(rare.where("term2 is not null").select("term2")).distinct()
    index = freeze(positional_index(docs, needed), "postings")
    met = freeze(intersect(index, rare, span).join(small(phrases), "phrase_id").drop("phrase_id"), "met")
    near = met.groupBy("key").agg(F.array_distinct(F.flatten(F.collect_set("items"))).alias("near"))
    exact = met.where(F.size("starts") > 0).groupBy("key").agg(
        F.collect_list(F.struct("starts", "phrase", "items")).alias("maybe")
    )
    exact = freeze(exact, "candidates")
    keyed = docs.withColumn("key", row_key())
    some = small(exact.select("key"))
    asked = keyed.join(some, "key", "left_semi").withColumn("w", words(F.col("text"))).join(exact, "key")
    each = F.flatten(F.transform("maybe", lambda m: F.transform(
        m["starts"], lambda at: F.struct(at.alias("start"), m["phrase"].alias("phrase"), m["items"].alias("items"))
    )))
    fits = F.filter(
        each,
        lambda m: (m["start"] >= 0) & (F.slice("w", F.greatest(m["start"], F.lit(0)) + 1, F.size(m["phrase"])) == m["phrase"]),
    )
    found = F.transform(fits, lambda m: F.struct(m["start"], F.size(m["phrase"]).alias("width"), m["items"]))
    asked = asked.select(*keyed.columns, found.alias("found"))
    none = F.array().cast(asked.schema["found"].dataType)
    return asked.unionByName(keyed.join(some, "key", "left_anti").withColumn("found", none)), near


def _names(items: Column) -> Column:
    """Item ids as sorted text, without null."""
    return F.array_sort(F.array_distinct(F.array_compact(F.transform(items, lambda i: i.cast("string")))))


def contamination(docs: DataFrame, items: DataFrame, size: int = 10, span: int = 10) -> DataFrame:
    """``doc_id, n_words, n_hit, item_ids, near_ids`` for every row of ``docs``."""
    found, near = matches(docs.select("doc_id", "text"), items, size, span)
    covered = F.flatten(F.transform("found", lambda m: F.sequence(m["start"], m["start"] + m["width"] - 1)))
    judged = found.select(
        "key", "doc_id", F.size(words(F.col("text"))).cast("long").alias("n_words"),
        F.size(F.array_distinct(covered)).cast("long").alias("n_hit"),
        _names(F.flatten(F.transform("found", lambda m: m["items"]))).alias("item_ids"),
    )
    judged = judged.join(near, "key", "left")
    return judged.withColumn("near_ids", _names(F.coalesce("near", F.array()))).drop("key", "near")


def keep_clean(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """``docs`` without those that hold a window of an item."""
    # whole rows travel as one column, so that no column of theirs clashes
    wrapped = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    found, _ = matches(wrapped, items, size)
    return found.where(F.size("found") == 0).select("row.*")
