"""URL rules by a sort-merge range join: a sorted sweep over urls and rules with a stack of the rules that are open.

A host written from its last label to its first and ended by a dot makes a rule for a host and all its subdomains an
interval of keys; so does, within one host, a rule for all paths that start alike. Intervals of prefixes never overlap
without one lying in the other. In the sorted order of openings, closings and urls the running sum of +1 and -1 is the
height of the stack, and the rule last opened at that height is the stack's top: the innermost rule of the url.

Two sweeps answer a url. The first finds the innermost host that has rules; it and the hosts around it, at most as many as
it has labels, are the hosts whose rules can fit. The second finds in each of them the longest path that fits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sentrylake.llm.common import cut

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The rules of the registered query.
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))
_RULE_COLUMNS = "host string, path string, verdict string"


def rule_table(spark: SparkSession, rules: tuple[tuple[str, str, str], ...]) -> DataFrame:
    return spark.createDataFrame(list(rules), _RULE_COLUMNS)


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_key(host: Column) -> Column:
    """The labels from last to first, each ended by a dot: a subdomain's key starts with that of its domain."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")).cast("binary")


def _around(host: Column) -> Column:
    """The host and all domains it lies in."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def innermost(points: DataFrame, intervals: DataFrame, label: str) -> DataFrame:
    """The points (``key``, other columns) with ``top``: the ``top`` of the longest key of ``intervals`` (``key``, ``top``;
    keys distinct) that the point's key starts with, null if there is none.

    Keys are UTF-8 bytes. Openings, closings and points are dealt out by range, points with equal keys too, and written
    down with the number of their range. A range begins with the stack that the ranges before it left open: of each
    height, the rule opened last. Only rule events and one row for each range and height are needed for that.
    """
    spark = points.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = intervals.schema["top"].dataType
    row = F.struct(*[c for c in points.columns if c != "key"])
    nothing = F.lit(None).cast(kind)
    opened = intervals.select(
        "key", F.lit(1).alias("kind"), F.lit(1).alias("step"), F.col("top").alias("opened"),
        F.lit(None).cast(points.select(row.alias("row")).schema["row"].dataType).alias("row"))
    ended = F.concat("key", F.expr("X'FF'"))  # after every text that starts with the key: no UTF-8 text holds this byte
    closed = opened.select(ended.alias("key"), F.lit(0).alias("kind"), F.lit(-1).alias("step"), nothing.alias("opened"), "row")
    asked = points.select("key", F.lit(2).alias("kind"), F.lit(0).alias("step"), nothing.alias("opened"), row.alias("row"))
    events = opened.unionByName(closed).unionByName(asked).withColumn("salt", F.xxhash64("row"))
    dealt = cut(events.repartitionByRange(parts, "key", "kind", "salt").withColumn("part", F.spark_partition_id()),
                f"{label}-events")

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    sums = dealt.groupBy("part").agg(F.sum("step").alias("total"))
    heights = sums.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("height"))
    rules = dealt.where("kind < 2").join(heights, "part")
    inside = Window.partitionBy("part").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    levels = rules.withColumn("level", F.col("height") + F.sum("step").over(inside)).where("kind = 1")
    newest = levels.groupBy("part", "level").agg(F.max_by("opened", "key").alias("opened"))
    open_at_start = heights.where("height > 0").select("part", F.explode(F.expr("sequence(1L, height)")).alias("level"))
    both = newest.select("part", "level", "opened", F.lit(False).alias("asks")).unionByName(
        open_at_start.select("part", "level", nothing.alias("opened"), F.lit(True).alias("asks")))
    earlier = Window.partitionBy("level").orderBy("part", F.desc("asks")).rowsBetween(Window.unboundedPreceding, -1)
    stacks = both.withColumn("opened", F.last("opened", True).over(earlier)).where("asks")

    carried = stacks.select(
        F.lit(b"").alias("key"), F.lit(-1).alias("kind"), F.lit(1).alias("step"), "opened",
        F.lit(None).cast(dealt.schema["row"].dataType).alias("row"), F.col("level").alias("salt"), "part")
    swept = dealt.unionByName(carried).repartitionByRange(parts, "part")
    order = [(F.col("kind") >= 0), F.col("key"), F.col("kind"), F.col("salt")]
    running = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at_height = Window.partitionBy("part", "height").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    topped = swept.withColumn("height", F.sum("step").over(running)).withColumn("top", F.last("opened", True).over(at_height))
    return topped.where("kind = 2").select("key", "row.*", "top")


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", id_column: str = "page_id",
          url_column: str = "url") -> DataFrame:
    """One row (id, ``host``, ``path``, ``rule``, ``verdict``) for each row of ``pages``.

    A rule (``host``, ``path``, ``verdict``) fits its host and all subdomains where the url's path starts with its path.
    Of those that fit the longest decides, host and path together, of equals that with the longer host; ``rule`` is its
    host and path, null if none fits, when ``default`` is the verdict. Of a rule that is listed with several verdicts the
    last in order holds (``block`` before ``allow``). Rules with a null are left out. A null url, or one without ``://``,
    has an empty host and path; repeated rows and null ids are answered each. An empty table gives an empty result, an
    empty rule table the default. Other columns are not read. Equal (host, path) are judged once.
    """
    rows = pages.select(F.col(id_column).alias("id"), F.coalesce(F.col(url_column).cast("string"), F.lit("")).alias("url"))
    rows = rows.select("id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rules = rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL")
    rules = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    hosts = rules.select("host").distinct().select(host_key(F.col("host")).alias("key"), F.col("host").alias("top"))
    urls = rows.groupBy("host", "path").agg(F.count("*").alias("n")).select(
        host_key(F.col("host")).alias("key"), "host", "path")
    near = innermost(urls, hosts, "hosts").where("top IS NOT NULL")

    def path_key(host: str | Column) -> Column:
        return F.concat(host_key(F.col(host)), F.expr("X'00'"), F.col("path").cast("binary"))

    paths = rules.select(path_key("host").alias("key"), F.struct("host", "path", "verdict").alias("top"))
    asked = near.select("host", "path", F.explode(_around(F.col("top"))).alias("within")).select(
        path_key("within").alias("key"), "host", "path")
    fits = innermost(asked, paths, "paths").where("top IS NOT NULL")
    length = F.struct(F.length("top.host") + F.length("top.path"), F.length("top.host"))
    best = fits.groupBy("host", "path").agg(F.max_by("top", length).alias("top"))
    judged = rows.join(best, ["host", "path"], "left")
    return judged.select(
        F.col("id").alias(id_column), "host", "path", F.concat("top.host", "top.path").alias("rule"),
        F.coalesce("top.verdict", F.lit(default)).alias("verdict"))


def oracle_sql(rules: tuple[tuple[str, str, str], ...], default: str = "allow") -> str:
    """The registered query's rows as SQL: every rule tried on every url."""
    listed = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in rules)
    return f"""
        WITH rules(h, p, v) AS (VALUES {listed}),
        rest AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
                 FROM pages),
        parts AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
                         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
        best AS (SELECT host, path, max_by(h || p, length(h || p) * 10000 + length(h)) AS rule,
                        max_by(v, length(h || p) * 10000 + length(h)) AS verdict
                 FROM (SELECT DISTINCT host, path FROM parts), rules
                 WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY host, path)
        SELECT page_id, host, path, rule, coalesce(verdict, '{default}') AS verdict
        FROM parts LEFT JOIN best USING (host, path)"""
