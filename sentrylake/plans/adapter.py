"""The generic ``events`` table seen as connection events, intrusion alerts and a benchmark corpus.

As after any ingest, the normalised rows are written once per session, sorted by time, and the queries read that table.
``CTES`` states the same views for the SQL check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentrylake.functions.net import conn_message, related_ips
from sentrylake.session import shared_dir
from sentrylake.sinks.lake import FILE_OPTIONS
from sentrylake.streaming.eventtime import with_event_time

PORTS = (22, 53, 80, 443, 8080, 8443, 3306, 5353)
PROTOCOLS = {"view": "http", "click": "ssl", "purchase": "dns", "signup": "ssh"}
RUN_ID = "run-1"
#: Rows of a file of the feed, and the files that are written at once and make a trigger.
FEED_ROWS, FEED_FILES = 125_000, 8
_RULE_COLUMNS = """event_timestamp kind k source_ip destination_ip destination_port network_transport network_protocol
    source_bytes destination_bytes network_bytes zeek_conn_uid related_ip""".split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_WRITTEN: dict[tuple[str, str, str], str] = {}


def derived(spark: SparkSession, sf_dir: str, label: str, write: Callable[[str], None]) -> str:
    """Folder of an input that Spark derives from the given tables; written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _WRITTEN:
        path = shared_dir(spark, label)
        write(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def _normalised(events: DataFrame) -> DataFrame:
    k, user = F.col("k"), F.col("user_id")
    low = (user % 250).cast("string")
    protocol: Column = F.lit(None).cast("string")
    for kind, name in PROTOCOLS.items():
        protocol = F.when(F.col("event_type") == kind, name).otherwise(protocol)
    sent = F.round(F.col("value") * 1000).cast("bigint")
    parsed = events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return parsed.select(
        "event_id", F.col("ts").cast("timestamp").alias("event_timestamp"), F.col("event_type").alias("kind"), "user_id",
        "value", "k",
        F.when(user % 3 == 0, F.concat(F.lit("203.0.113."), low))
        .otherwise(F.concat(F.lit("192.168."), F.floor(user / 250).cast("string"), F.lit("."), low)).alias("source_ip"),
        (F.lit(1024) + F.col("event_id") % 60000).cast("int").alias("source_port"),
        F.when(k % 4 == 0, F.concat(F.lit("10.0.0."), k.cast("string")))
        .otherwise(F.concat(F.lit("198.51.100."), k.cast("string"))).alias("destination_ip"),
        F.array(*[F.lit(p) for p in PORTS])[k % 8].alias("destination_port"),
        F.when(k % 5 == 0, "udp").otherwise("tcp").alias("network_transport"), protocol.alias("network_protocol"),
        sent.alias("source_bytes"), (k * 100).cast("bigint").alias("destination_bytes"),
        (sent + k * 100).alias("network_bytes"),
        F.concat(F.lit("C"), F.col("event_id").cast("string")).alias("zeek_conn_uid"),
        F.concat(F.lit("user "), user.cast("string"), F.lit(" "), F.col("event_type"), F.lit(" value "),
                 F.round("value", 2).cast("decimal(18,2)").cast("string")).alias("event_original"),
    ).withColumns({"related_ip": related_ips("source_ip", "destination_ip"), "message": conn_message()})


def _in_order(events: DataFrame) -> DataFrame:
    """The normalised events in as many contiguous, sorted ranges of time as the cluster runs shuffle tasks."""
    files = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Shuffled and sorted as they come: normalised rows are wider, and the sample for the ranges would normalise all of them.
    rows = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return _normalised(rows.repartitionByRange(files, "ts").sortWithinPartitions("ts"))


def _write_events(spark: SparkSession, sf_dir: str, path: str) -> None:
    _in_order(table(spark, sf_dir, "events")).write.options(**FILE_OPTIONS).parquet(path)


def normalise_again(spark: SparkSession, sf_dir: str) -> None:
    """Write the normalised events once more, to be timed."""
    _write_events(spark, sf_dir, shared_dir(spark, "events-again"))


def _events_folder(spark: SparkSession, sf_dir: str) -> str:
    return derived(spark, sf_dir, "events", lambda path: _write_events(spark, sf_dir, path))


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_events_folder(spark, sf_dir))


def _feed_edges(events: DataFrame, files: int) -> list[int]:
    """The first time of each of about ``files`` files with as many events each."""
    ranks = F.array(*[F.lit(i / files) for i in range(files)])
    edges = events.agg(F.percentile_approx(F.unix_micros("event_timestamp"), ranks, 20 * files)).first()[0]
    return sorted(set(edges or [0]))


def write_feed(events: DataFrame, path: str, files: int) -> None:
    """The events as they would arrive: one write after another, each of the next ``FEED_FILES`` files.

    A file holds the times from an edge up to the next, and no file is empty, as an edge is the time of an event. Streams
    read files in the order in which they were written and, with ``FEED_FILES`` files a trigger, those of one write at
    once: no event is older than one of an earlier trigger. Events without a time come first.
    """
    edges, time = _feed_edges(events, files), F.col("event_timestamp")
    for first in range(0, len(edges), FEED_FILES):
        own, after = edges[first:first + FEED_FILES], edges[first + FEED_FILES:first + FEED_FILES + 1]
        rows = events
        if first:
            rows = rows.where(time >= F.timestamp_micros(F.lit(own[0])))
        if after:
            earlier = time < F.timestamp_micros(F.lit(after[0]))
            rows = rows.where(earlier if first else earlier | time.isNull())
        part = F.lit(first)
        for edge in own[1:]:
            part += F.when(time >= F.timestamp_micros(F.lit(edge)), 1).otherwise(0)
        rows = rows.withColumn("part", F.lpad(part.cast("string"), 9, "0"))
        rows.repartition(len(own), "part").write.mode("append").partitionBy("part").option("maxRecordsPerFile", 0).parquet(path)


def _paced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the rules look at, as a stream: few events in one trigger, many in several by time, so that its state need not
    hold all of them."""
    events = _base(spark, sf_dir).select(*_RULE_COLUMNS)
    reader, files = spark.readStream.schema(events.schema), -(-events.count() // FEED_ROWS)
    if files <= FEED_FILES:
        return reader.parquet(_events_folder(spark, sf_dir))
    return reader.option("maxFilesPerTrigger", FEED_FILES).parquet(
        derived(spark, sf_dir, "feed", lambda path: write_feed(events, path, files)))


def _base_stream(spark: SparkSession, sf_dir: str, paced: bool = False) -> DataFrame:
    if paced:
        return _paced(spark, sf_dir)
    path = _events_folder(spark, sf_dir)
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


_SEVERITY, _RULE = "CAST(1 + k % 3 AS INT)", "concat('1:', k, ':1')"


def _timed(df: DataFrame, delay: str | None) -> DataFrame:
    if delay:
        return with_event_time(df, "event_timestamp", delay)
    return df.withColumn("event_time", F.col("event_timestamp"))


def _connections(rows: DataFrame) -> DataFrame:
    return rows.selectExpr("*", "'event' AS event_kind", "'zeek' AS event_module", "'zeek.conn' AS event_dataset")


def _errors(rows: DataFrame) -> DataFrame:
    return rows.where("kind = 'error'").selectExpr(
        "*", f"{_SEVERITY} AS event_severity", f"{_RULE} AS rule_id", "'alert' AS event_kind", "'snort' AS event_module",
        "'snort.alert' AS event_dataset")


def conns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a connection."""
    return _timed(_connections(_base(spark, sf_dir)), None)


def ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The error events as intrusion alerts."""
    return _timed(_errors(_base(spark, sf_dir)), None)


def conn_stream(spark: SparkSession, sf_dir: str, delay: str | None = "30 seconds", paced: bool = False) -> DataFrame:
    """``paced``, for the rules: a large table is read in several triggers, in order of time."""
    return _timed(_connections(_base_stream(spark, sf_dir, paced)), delay)


def ids_stream(spark: SparkSession, sf_dir: str, delay: str | None = "30 seconds", paced: bool = False) -> DataFrame:
    return _timed(_errors(_base_stream(spark, sf_dir, paced)), delay)


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event once: error events as intrusion alerts, the others as connections, tagged as one run."""
    return _base(spark, sf_dir).selectExpr(
        "*",
        "if(kind = 'error', 'alert', 'event') AS event_kind", "if(kind = 'error', 'snort', 'zeek') AS event_module",
        "if(kind = 'error', 'snort.alert', 'zeek.conn') AS event_dataset",
        f"if(kind = 'error', {_SEVERITY}, NULL) AS event_severity", f"if(kind = 'error', {_RULE}, NULL) AS rule_id",
        "if(kind = 'error', concat('rule ', k), NULL) AS rule_name", "if(kind = 'error', 'misc', NULL) AS rule_category",
        f"'{RUN_ID}' AS benchmark_id", "'small' AS benchmark_size", "0 AS benchmark_cycle",
        "event_id + 1 AS benchmark_seq")


def flat_arrays(df: DataFrame) -> DataFrame:
    """Arrays as comma lists, so that results compare column by column."""
    return df.selectExpr(*[
        f"array_join({f.name}, ',') AS {f.name}" if f.dataType.typeName() == "array" else f.name for f in df.schema])


def iso_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS") for c in columns})


ISO = "'%Y-%m-%dT%H:%M:%S.%g'"
_PORT_LIST = ", ".join(map(str, PORTS))
CTES = f"""
base AS (
  SELECT event_id, ts AS event_time, event_type, user_id, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events),
conn AS (
  SELECT *, source_bytes + destination_bytes AS network_bytes,
    coalesce(network_protocol || ' ', '') || network_transport || ' connection ' || source_ip || ':' || source_port
      || ' -> ' || destination_ip || ':' || destination_port AS message
  FROM (
    SELECT *,
      CASE WHEN user_id % 3 = 0 THEN '203.0.113.' || (user_id % 250)
           ELSE '192.168.' || (user_id // 250) || '.' || (user_id % 250) END AS source_ip,
      1024 + event_id % 60000 AS source_port,
      CASE WHEN k % 4 = 0 THEN '10.0.0.' ELSE '198.51.100.' END || k AS destination_ip,
      [{_PORT_LIST}][k % 8 + 1] AS destination_port,
      CASE WHEN k % 5 = 0 THEN 'udp' ELSE 'tcp' END AS network_transport,
      CASE event_type WHEN 'view' THEN 'http' WHEN 'click' THEN 'ssl' WHEN 'purchase' THEN 'dns'
                      WHEN 'signup' THEN 'ssh' END AS network_protocol,
      CAST(round(value * 1000) AS BIGINT) AS source_bytes, CAST(k * 100 AS BIGINT) AS destination_bytes,
      'C' || event_id AS zeek_conn_uid,
      'user ' || user_id || ' ' || event_type || ' value ' || CAST(round(value, 2) AS DECIMAL(18,2)) AS event_original
    FROM base)),
ids AS (
  SELECT *, 1 + k % 3 AS event_severity, '1:' || k || ':1' AS rule_id FROM conn WHERE event_type = 'error'),
corpus AS (
  SELECT *, event_id + 1 AS benchmark_seq, strftime(event_time, {ISO}) AS event_timestamp,
    CASE WHEN event_type = 'error' THEN 'alert' ELSE 'event' END AS event_kind,
    CASE WHEN event_type = 'error' THEN 'snort' ELSE 'zeek' END AS event_module,
    CASE WHEN event_type = 'error' THEN 'snort.alert' ELSE 'zeek.conn' END AS event_dataset,
    CASE WHEN event_type = 'error' THEN 1 + k % 3 END AS event_severity,
    CASE WHEN event_type = 'error' THEN '1:' || k || ':1' END AS rule_id,
    CASE WHEN event_type = 'error' THEN 'rule ' || k END AS rule_name,
    CASE WHEN event_type = 'error' THEN 'misc' END AS rule_category
  FROM conn)
"""


def sql(select: str, *more: str) -> str:
    """A statement over the views; ``more`` are further CTEs."""
    return "WITH " + ",\n".join([CTES, *more]) + "\n" + select
