"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document draws the exponential key ``-ln(u) / quality``; the smallest keys of a source come first. Documents are
summed per (source, key bucket) before anything is ordered, so that only the one bucket of a source in which its budget
ends is sorted. Everything runs in DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sentrylake.llm.common import WORD, cut

WEIGHTS = (5, 2, 1)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def text_quality(text: Column) -> Column:
    """Quality weight of a document, 0.05 to 1: the share of its characters that are no digits, marks or line breaks."""
    plain = F.length(F.translate(text, "0123456789|<>{}[]()=_*#@&%$+/\\~^\"\n\r\t", ""))
    share = plain / F.greatest(F.length(text), F.lit(1))
    return F.greatest(F.coalesce(share, F.lit(0.0)), F.lit(0.05))


def _drawn(docs: DataFrame, id_column: str, text_column: str, source_column: str, quality: Column | None, seed: int,
           buckets: int) -> DataFrame:
    """Each row as a struct ``row`` with its source, size, key and key bucket."""
    text = F.col(text_column).cast("string")
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_column), text), 11)
    key = -F.log((bits + 0.5) / F.lit(2.0**53)) / (text_quality(text) if quality is None else quality)
    rows = docs.select(
        F.struct("*").alias("row"), F.coalesce(F.col(source_column).cast("string"), F.lit("")).alias("source"),
        F.col(source_column).isNull().alias("no_source"), word_count(text).alias("size"), key.alias("key"))
    return rows.withColumn("bucket", F.floor((1 - F.exp(-F.col("key"))) * buckets).cast("int"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """Adds ``target`` to one row per source (``source``, ``no_source``, ``source_size``).

    Sources by code point, null last, take the weights in turn and share the sum of all sizes. The shares are
    ``level * weight`` cut at ``most`` times the source's size, with the one level at which they add up to the sum.
    """
    order = W.orderBy("no_source", "source")
    weight = F.get(F.array(*[F.lit(w) for w in weights]), (F.row_number().over(order) - 1) % len(weights))
    rows = sizes.withColumn("weight", weight).withColumn("full", F.col("source_size") * most)
    first = W.orderBy(F.col("full") / F.col("weight"), "no_source", "source")
    upto = first.rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumns({
        "cut": F.coalesce(F.sum("full").over(upto), F.lit(0)),
        "rest": F.sum("weight").over(first.rowsBetween(0, W.unboundedFollowing)), "all": F.sum("source_size").over(W.partitionBy())})
    rows = rows.withColumn("level", (F.col("all") - F.col("cut")) / F.col("rest"))
    fits = F.when(F.col("level") <= F.col("full") / F.col("weight"), F.col("level"))
    rows = rows.withColumn("level", F.first(fits, ignorenulls=True).over(
        first.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    target = F.least(F.col("full").cast("double"), F.coalesce(F.col("level") * F.col("weight"), F.lit(0.0)))
    return rows.select("source", "no_source", "source_size", target.alias("target"))


def plan(drawn: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """One row per source: target, whole epochs, and the last bucket and place that the fractional epoch takes.

    At the last place may stand rows that repeat id and text: ``last.copies`` of them, of which ``last.fit`` are taken.
    """
    source = ["source", "no_source"]
    sums = cut(drawn.groupBy(*source, "bucket").agg(F.sum("size").alias("size")), "mix-buckets")
    sizes = cut(targets(sums.groupBy(*source).agg(F.sum("size").alias("source_size")), weights, most), "mix-targets")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    sizes = sizes.withColumn("epochs", epochs.cast("bigint"))
    sizes = sizes.withColumn("left", F.col("target") - F.col("epochs") * F.col("source_size"))
    # The bucket in which what is left of the target ends, and what remains of it there.
    upto = W.partitionBy(*source).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    before = sums.withColumn("before", F.coalesce(F.sum("size").over(upto), F.lit(0)))
    edge = before.join(sizes.select(*source, "left"), source).where(
        (F.col("left") > 0) & (F.col("before") < F.col("left")))
    edge = edge.groupBy(*source).agg(
        F.max("bucket").alias("edge"), F.max_by(F.col("left") - F.col("before"), "bucket").alias("room"))
    edge = cut(edge, "mix-edges")
    inside = drawn.select(*source, "bucket", "key", "size").join(
        edge.withColumnRenamed("edge", "bucket"), [*source, "bucket"])
    inside = inside.groupBy(*source, "room", "key", "size").agg(F.count("*").alias("copies"))
    ordered = W.partitionBy(*source).orderBy("key", "size").rowsBetween(W.unboundedPreceding, -1)
    inside = inside.withColumn("before", F.coalesce(F.sum(F.col("size") * F.col("copies")).over(ordered), F.lit(0)))
    fit = F.when(F.col("size") > 0, F.least(F.col("copies"), F.floor((F.col("room") - F.col("before")) / F.col("size") + 0.5)))
    last = inside.where(F.col("before") + F.col("size") / 2 <= F.col("room")).groupBy(*source).agg(
        F.max(F.struct("key", "size", "copies", F.coalesce(fit, "copies").alias("fit"))).alias("last"))
    return cut(sizes.drop("left").join(edge.drop("room"), source, "left").join(last, source, "left"), "mix-plan")


def _numbered(rows: DataFrame) -> DataFrame:
    """Adds ``number``, from 1, to the rows of each source, counted by the parts they are written in and then within a part."""
    source, part = ["source", "no_source"], F.shiftright("place", 33)
    written = cut(rows.withColumn("place", F.monotonically_increasing_id()), "mix-ties").withColumn("part", part)
    upto = W.partitionBy(*source).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    first = written.groupBy(*source, "part").count().withColumn("first", F.coalesce(F.sum("count").over(upto), F.lit(0)))
    own = F.row_number().over(W.partitionBy(*source, "part").orderBy("place"))
    return written.withColumn("own", own).join(first.drop("count"), [*source, "part"]).withColumn(
        "number", F.col("first") + F.col("own")).drop("place", "part", "own", "first")


def mix(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
        weights: tuple[int, ...] = WEIGHTS, most: int = 3, quality: Column | None = None, seed: int = 17,
        buckets: int = 4096) -> DataFrame:
    """Adds the struct column ``mix`` (replaced if it exists): size, source_size, target, epochs, taken.

    A source first takes whole epochs of all its documents, then documents by key while at least half of the next one
    fits what is left. ``epochs`` says how often a document is taken, ``taken`` how many words that makes. The draw
    depends on the seed, the id and the text alone, so reruns agree; of rows that repeat both at the end of the budget, as
    many are taken as fit, and which of them is not determined. A null text has size 0; null sources form one source; sources without words have target 0 and take nothing. An empty
    table gives an empty result. All other columns pass through.
    """
    drawn = _drawn(docs, id_column, text_column, source_column, quality, seed, buckets)
    small = cut(drawn.drop("row"), "mix-keys")
    planned = plan(small, weights, most)
    pair, last = F.struct("key", "size"), F.struct("last.key", "last.size")
    chosen = drawn.join(planned, ["source", "no_source"])
    partly = F.when(F.col("bucket") < F.col("edge"), 1).when((F.col("bucket") == F.col("edge")) & (pair <= last), 1).otherwise(0)
    if not planned.where("last.fit < last.copies").isEmpty():
        at_end = F.coalesce((pair == last) & (F.col("last.fit") < F.col("last.copies")), F.lit(False))
        chosen = chosen.where(~at_end).withColumn("number", F.lit(0).cast("long")).unionByName(_numbered(chosen.where(at_end)))
        partly = F.when(F.col("number") > F.col("last.fit"), 0).otherwise(partly)
    epochs = F.col("epochs") + partly
    result = F.struct("size", "source_size", "target", epochs.alias("epochs"), (F.col("size") * epochs).alias("taken"))
    kept = [c for c in docs.columns if c != "mix"]
    return chosen.withColumn("found", result).select(
        *[F.col("row")[c].alias(c) for c in kept], F.col("found").alias("mix"))
