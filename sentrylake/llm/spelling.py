"""Spelling variants: words one letter apart, found by partition-and-enumerate signatures of their letter multisets.

A word is a binary vector with one place for each occurrence of each letter. One inserted, deleted or replaced letter
changes at most two places. The letters are parted; of ``parts`` parts all but two are then the same in both words, so the
words share one of the signatures that name a choice of ``parts - 2`` parts with the letters in them. They also share the
first or the last half of their letters. Signature and half make an equi-join, which tests the distance of what meets.

All joins ask for a merge: a side holds as many rows as there are words, or 24 times as many, and Spark, which takes it for
about as large as the word file, would collect it on the driver and broadcast it.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentrylake.llm.common import cut

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = r"[A-Za-z\u00C0-\u00FF]+"  # fixed value


def word_counts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shortest: int = 6,
                change: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """(``word``, ``n``) over all texts: runs of letters with A-Z lower-cased, of at least ``shortest`` code points.

    ``change`` makes another word of (id, word) before it is counted. Null and empty texts hold no word; repeated rows
    count each; an empty table gives an empty result. Other columns are not read.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    found = rows.select("id", F.explode(F.regexp_extract_all("text", F.lit(LETTERS), F.lit(0))).alias("run"))
    long = found.where(F.length("run") >= shortest).select("id", F.translate("run", _UPPER, _LOWER).alias("word"))
    if change:
        long = long.select(change(F.col("id"), F.col("word")).alias("word")).where(F.length("word") >= shortest)
    return long.groupBy("word").agg(F.count("*").alias("n"))


def with_dropped_letters(doc_id: Column, word: Column) -> Column:
    """The word, without its letter number h % length where 199 divides h, the crc32 of ``<id>:<word>`` (a null id: empty)."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
    at = (h % F.length(word)).cast("int")
    dropped = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
    return F.when(h % 199 == 0, dropped).otherwise(word)


def signatures(word: Column, letters: Column, parts: int) -> list[Column]:
    """For each choice of ``parts - 2`` parts the letters in them, as a hash; ``letters`` are the word's, sorted."""
    if parts < 3:
        raise ValueError("signatures of no part at all")

    def inside(part: int) -> Column:
        return F.array_join(F.filter(letters, lambda c: F.pmod(F.xxhash64(c), F.lit(parts)) == part), "")

    held = [inside(part) for part in range(parts)]
    return [F.xxhash64(F.lit(i), *[held[p] for p in choice])
            for i, choice in enumerate(itertools.combinations(range(parts), parts - 2))]


def _keys(parts: int) -> Column:
    """Where a word (``word``, ``size``, ``prints``) meets others: by signature, shorter length, and half.

    With m the length of the shorter word, the first m // 2 letters are the same in both or the last m // 2 are.
    """
    def halves(m: Column) -> list[Column]:
        h = F.floor(m / 2).cast("int")
        return [F.xxhash64(m, F.lit(True), F.substring("word", F.lit(1), h)),
                F.xxhash64(m, F.lit(False), F.substring(F.col("word"), F.col("size") - h + 1, h))]

    sides = F.array(*halves(F.col("size")), *halves(F.col("size") - 1))
    return F.flatten(F.transform("prints", lambda s: F.transform(sides, lambda x: F.xxhash64(s, x))))


def near_words(words: DataFrame, parts: int = 4) -> DataFrame:
    """Pairs (``a``, ``b``, ``n_a``, ``n_b``), a < b, of the distinct words (``word``, ``n``) that differ by exactly one
    inserted, deleted or replaced code point. Null and empty words have no pair."""
    sorted_letters = words.where("word <> ''").select(
        "word", "n", F.length("word").alias("size"), F.array_sort(F.split("word", "")).alias("letters"))
    prints = sorted_letters.select(
        "word", "n", "size", F.array(*signatures(F.col("word"), F.col("letters"), parts)).alias("prints"))
    keyed = prints.select("word", "n", F.explode(_keys(parts)).alias("key"))
    other = keyed.withColumnsRenamed({"word": "b", "n": "n_b"})
    met = keyed.withColumnsRenamed({"word": "a", "n": "n_a"}).join(
        other.hint("merge"), "key").where((F.col("a") < F.col("b")) & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "b", "n_a", "n_b").distinct()


def spelling_variants(words: DataFrame, ratio: int = 5, parts: int = 4) -> DataFrame:
    """One row (``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``) for each distinct word of (``word``, ``n``).

    Words are near if they differ by exactly one inserted, deleted or replaced code point; ``n_near`` counts them (0 if
    there are none). A word's ``form`` is its near word of greatest n (of equals the first in code-point order) if that
    is at least ``ratio`` (2 or more) times its own n, else null; ``form_n`` is its n. ``root`` follows the forms to the
    last, the word itself if it has none. Counts of a repeated word are summed; null words are left out; an empty table
    gives an empty result. Other columns are not read.
    """
    if ratio < 2:
        raise ValueError("forms could lead in a circle")
    words = cut(words.where("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n")), "words")
    pairs = near_words(words, parts)
    sides = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n")))).alias("s"))
    best = sides.select("s.*").groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    joined = words.join(best.hint("merge"), "word", "left").withColumn("form_n", -F.col("best.less"))
    kept = F.col("form_n") >= ratio * F.col("n")
    known = cut(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(kept, F.col("best.near")).alias("form"), F.when(kept, F.col("form_n")).alias("form_n")), "forms")
    roots = _roots(known, ratio)
    return known.join(roots.hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(known: DataFrame, ratio: int) -> DataFrame:
    """(``word``, ``root``) of each word that has a form. A step up multiplies n, so few doublings of the way reach the top."""
    ends = known.agg(F.min("n").alias("lo"), F.max("n").alias("hi")).first()
    steps = int(math.log(max(ends.hi, 1) / max(ends.lo, 1), ratio)) + 1 if ends.hi else 1
    roots = known.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(max(0, math.ceil(math.log2(steps)))):
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ways = roots.join(further.hint("merge"), "root", "left")
        roots = cut(ways.select("word", F.coalesce("next", "root").alias("root")), "roots")
    return roots
