"""Writing the lake table and run tables."""

from __future__ import annotations

from functools import reduce
from operator import and_
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sentrylake.operators.layout import clustered
from sentrylake.schemas import LAKE_SCHEMA, align, with_event_date
from sentrylake.session import shared_dir

PARTITIONS = ["event_date", "event_dataset"]
BLOOM_COLUMNS = ("source_ip", "destination_ip", "zeek_conn_uid")


def _bloom(columns: list[str] | tuple[str, ...]) -> dict[str, str]:
    return {"compression": "snappy"} | {f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}


FILE_OPTIONS = _bloom(BLOOM_COLUMNS)


def spread(df: DataFrame, keys: list[str], writers: int | None = None) -> DataFrame:
    """Bring the rows of a partition together for few, large files, without one task taking a whole busy partition.

    Spark splits and merges at run time, by the bytes of the batch or of each trigger (rebalance). It does not re-plan
    streams that keep state: give ``writers`` for those, the number of tasks that each partition's rows go to, chosen by row
    content so that a retried task repeats the choice.
    """
    if writers is None:
        return df.hint("rebalance", *keys)
    writer = F.pmod(F.xxhash64("event_timestamp", "event_original", "message"), F.lit(writers))
    return df.repartition(*[F.col(k) for k in keys], writer)


def write_lake(
    df: DataFrame, path: str, checkpoint: str | None = None, trigger: str = "available", table: str | None = None,
    writers: int | None = None, cluster_by: list[str] | None = None,
) -> StreamingQuery | None:
    """Append events to the date- and dataset-partitioned table, Parquet with snappy.

    Files are sorted by time, so that a reader skips row groups by time range, and carry Bloom filters of the addresses
    and connection ids, so that it skips them by equality.

    A stream commits at every trigger and continues from ``checkpoint``; its files are as many as a trigger's bytes need,
    see :func:`spread` for streams that keep state. ``table`` names a catalog table to append to
    instead of the folder. ``cluster_by`` (batches only) orders each partition along a space-filling curve of these columns
    instead of time, for tables that are searched by any of them; see :mod:`sentrylake.operators.layout`.
    """
    if cluster_by:
        if df.isStreaming:
            raise ValueError("a stream cannot be clustered as a whole: cluster the finished partitions")
        rows = clustered(align(with_event_date(df), LAKE_SCHEMA), PARTITIONS, cluster_by)
        if table:
            rows.writeTo(table).append()
        else:
            rows.write.mode("append").partitionBy(*PARTITIONS).options(**FILE_OPTIONS).parquet(path)
        return None
    rows = spread(align(with_event_date(df), LAKE_SCHEMA), PARTITIONS, writers)
    if not df.isStreaming:
        if table:
            rows.writeTo(table).append()
        else:
            rows = rows.sortWithinPartitions(*PARTITIONS, "event_timestamp")
            rows.write.mode("append").partitionBy(*PARTITIONS).options(**FILE_OPTIONS).parquet(path)
        return None
    timing = {"availableNow": True} if trigger == "available" else {"processingTime": trigger}
    stream = rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(**timing)
    if table:
        return stream.toTable(table)
    return stream.partitionBy(*PARTITIONS).format("parquet").options(**FILE_OPTIONS).option("path", path).start()


def overwrite_run(
    df: DataFrame, path: str, run_col: str = "benchmark_id", sort_by: str | None = "event_timestamp",
    cluster_by: list[str] | None = None,
) -> None:
    """Replace the rows of the runs in ``df``; other runs stay. A file holds one stretch of time of a run, in order, or of
    the space-filling order of the columns in ``cluster_by``."""
    if cluster_by:
        rows = clustered(df, [run_col], cluster_by)
    elif sort_by:
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rows = df.repartitionByRange(parts, run_col, sort_by).sortWithinPartitions(run_col, sort_by)
    else:
        rows = df.hint("rebalance", run_col)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(run_col)
    writer.options(**_bloom([c for c in BLOOM_COLUMNS if c in df.columns])).parquet(path)


def _rank(columns: list[str], order: str, prefix: str = "") -> Column:
    """What decides between two deliveries of an id: the greater ``order``, no order last, then the greater content hash."""
    return F.struct(F.col(prefix + order).alias("_order"), F.xxhash64(*[F.col(prefix + c) for c in columns]).alias("_content"))


def newest_by_key(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per key: the one with the greatest ``order``; rows without one come last, ties are broken by content.

    One aggregate: of many deliveries of an id, a task hands on the best it has seen.
    """
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rows.columns), _rank(rows.columns, order)).alias("_row"))
    return best.select("_row.*")


def upsert(
    df: DataFrame, keys: list[str], order: str, path: str | None = None, table: str | None = None,
    partition_by: list[str] | None = None, checkpoint: str | None = None, trigger: str = "available",
) -> StreamingQuery | None:
    """Load rows by id: of all deliveries of an id, stored or new, the one with the greatest ``order`` stays.

    The rule is the same for batches and streams (which load each micro-batch) and for every sink:

    * ``table``: a catalog table that supports it takes a ``MERGE``.
    * ``path``: a Parquet folder; only those partitions (``partition_by``) that get new rows, or that an id of theirs may
      lie in so far, are read and rewritten. Which partitions an id was ever loaded into is kept in the folder's own
      ``_ids`` table, by hash of the id; it grows by the ids that are new to a partition. A rewrite is staged in the shared
      folder first, and the ids are written before it: a load that failed can be repeated as it is.

    Equal orders are decided by a hash of the content, so it does not matter which delivery came first.
    """
    if (path is None) == (table is None):
        raise ValueError("give either a path or a table")

    def load(batch: DataFrame, _: int = 0) -> None:
        if table:
            _merge(newest_by_key(batch, keys, order), keys, order, table)
        else:
            _rewrite(batch, keys, order, path, partition_by or [])

    if not df.isStreaming:
        load(df)
        return None
    timing = {"availableNow": True} if trigger == "available" else {"processingTime": trigger}
    return df.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(**timing).start()


def _merge(rows: DataFrame, keys: list[str], order: str, table: str) -> None:
    old = table.split(".")[-1]
    same = reduce(and_, [F.col(f"new.{k}").eqNullSafe(F.col(f"{old}.{k}")) for k in keys])
    newer = _rank(rows.columns, order, "new.") > _rank(rows.columns, order, f"{old}.")
    rows.alias("new").mergeInto(table, same).whenMatched(newer).updateAll().whenNotMatched().insertAll().merge()


_BUCKETS = 64


def _id_places(rows: DataFrame, keys: list[str], partition_by: list[str]) -> DataFrame:
    """The ids and partitions of rows, with the id's bucket."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(_BUCKETS)).cast("int").alias("_bucket")
    return rows.select(*dict.fromkeys([*keys, *partition_by]), bucket)


def _null_safe(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    return reduce(and_, [left[c].eqNullSafe(right[c]) for c in columns])


def _locate(batch: DataFrame, keys: list[str], path: str, partition_by: list[str]) -> DataFrame:
    """The partitions that a load touches: those of the batch, and those that its ids were loaded into before.

    Writes down the places of the batch's ids that are not known yet.
    """
    spark, ids = batch.sparkSession, f"{path.rstrip('/')}/_ids"
    new = _id_places(batch, keys, partition_by)
    if not _exists(spark, ids):  # a folder without the table: all its ids are read once
        stored = _id_places(spark.read.schema(batch.schema).parquet(path), keys, partition_by).distinct() if _exists(spark, path) else new.limit(0)
        # Without a row, too, so that the next load finds the table.
        stored.repartition("_bucket").write.partitionBy("_bucket").parquet(ids)
    known = spark.read.schema(new.schema).parquet(ids)
    buckets = [r[0] for r in new.select("_bucket").distinct().collect()]  # at most _BUCKETS numbers
    known = known.where(F.col("_bucket").isin(buckets)).select(*new.columns)
    # The batch's own partitions are touched anyway: only what is known elsewhere has to be looked for among its ids.
    own = new.select(*partition_by).distinct()
    elsewhere = known.join(own, _null_safe(known, own, partition_by), "left_anti")
    held = elsewhere.join(new, _null_safe(elsewhere, new, list(dict.fromkeys(keys))), "left_semi")
    places = held.select(*partition_by).unionByName(own).distinct()
    staged = shared_dir(spark, "places")
    places.write.parquet(staged)
    both = known.withColumn("_known", F.lit(True)).unionByName(new.withColumn("_known", F.lit(False)))
    fresh = both.groupBy(*new.columns).agg(F.max("_known").alias("_known")).where("NOT _known").drop("_known")
    fresh.repartition("_bucket").write.mode("append").partitionBy("_bucket").parquet(ids)
    return spark.read.schema(places.schema).parquet(staged)


def _rewrite(batch: DataFrame, keys: list[str], order: str, path: str, partition_by: list[str]) -> None:
    spark = batch.sparkSession
    staged = shared_dir(spark, "upsert")
    touched = _locate(batch, keys, path, partition_by) if partition_by else None
    rows, stored = batch, None
    if _exists(spark, path):
        stored = spark.read.schema(batch.schema).parquet(path).withColumn("_file", F.col("_metadata.file_path"))
        old = stored if touched is None else stored.join(touched, _null_safe(stored, touched, partition_by), "left_semi")
        rows = old.select(*batch.columns).unionByName(batch)
    newest_by_key(rows, keys, order).write.parquet(staged)
    ready = spark.read.schema(batch.schema).parquet(staged)
    left = []
    if touched is not None and stored is not None:
        kept = ready.select(*partition_by).distinct()
        gone = touched.join(kept, _null_safe(touched, kept, partition_by), "left_anti")
        if not gone.isEmpty():  # most loads empty no partition, and look for no folder
            files = stored.join(gone, _null_safe(stored, gone, partition_by), "left_semi").select("_file").distinct()
            left = files.select(F.regexp_replace("_file", "/[^/]*$", "").alias("_folder")).distinct().collect()  # a row for each partition
    writer = spread(ready, partition_by).write.mode("overwrite") if partition_by else ready.write.mode("overwrite")
    writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic") if partition_by else writer
    writer.options(**_bloom([c for c in BLOOM_COLUMNS if c in batch.columns])).parquet(path)
    for r in left:  # Spark leaves a partition alone that gets no row: where all ids have moved away, the folder is emptied.
        empty = spark.createDataFrame([], ready.drop(*partition_by).schema)
        empty.write.mode("overwrite").parquet(unquote(r["_folder"]))  # Spark names files as URIs


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
        return bool(files.load(path).select("path").limit(1).count())
    except AnalysisException:
        return False
