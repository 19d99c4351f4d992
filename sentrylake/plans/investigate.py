"""Registered queries: filters, counts, top lists, timelines and text search."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentrylake.operators import aggregates as g
from sentrylake.operators import filters as f
from sentrylake.operators import search as s
from sentrylake.operators.corpus import derive_alerts
from sentrylake.operators.suites import SuiteParams, baseline_suite, showcase_suite
from sentrylake.plans import adapter as a
from sentrylake.sinks.documents import to_serving

START, MID, END = "2024-01-05 00:00:00", "2024-01-15 12:00:00", "2024-01-28 00:00:00"
SOURCE, DESTINATION = "192.168.0.8", "198.51.100.69"
QUERY = "ssl tcp connection"
RAW_QUERY = "click udp ssl"
DOC_QUERY = "The And with"
DOC_PREFIX = "nowhere queau"
DOC_FUZZY = "eringign tehm"
PART_FUZZY = "wigdet blot"
PART_TRIGRAM = "red widgit"

PARAMS = SuiteParams(a.RUN_ID, START, MID, END, "zeek.conn", SOURCE, DESTINATION, QUERY, RAW_QUERY)

Query = Callable[[SparkSession, str], DataFrame]


def _hits(df: DataFrame, n: int = 25) -> DataFrame:
    return a.iso_text(s.latest(df, n).select("event_id", "event_timestamp"), "event_timestamp")


def _on_corpus(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(a.corpus(spark, sf_dir))


def _timed_text(df: DataFrame) -> DataFrame:
    """Times as text and scores rounded, for the comparison with SQL."""
    df = a.iso_text(df, *({"event_timestamp", "bucket"} & set(df.columns)))
    return df.withColumn("similarity", F.round("similarity", 6)) if "similarity" in df.columns else df


def _baseline(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = a.corpus(spark, sf_dir)
        alerts = derive_alerts(events) if name.startswith("alerts_") else events
        return _timed_text(baseline_suite(events, alerts, PARAMS)[name]())
    return run


def _showcase(name: str, dialect: str = "search", serving: bool = False) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = a.corpus(spark, sf_dir)
        return _timed_text(showcase_suite(_serving(events) if serving else events, PARAMS, dialect)[name]())
    return run


def _alerts(df: DataFrame) -> DataFrame:
    return derive_alerts(df)


def _serving(df: DataFrame) -> DataFrame:
    columns = ["event_id", "event_timestamp", "event_dataset", "event_module", "event_kind", "event_severity", "source_ip",
               "destination_ip", "destination_port", "rule_id", "rule_name", "network_bytes", "message", "event_original",
               "benchmark_id"]
    return to_serving(df.select(*columns))


def _timeline(df: DataFrame, **kw) -> DataFrame:
    return a.iso_text(g.timeline(df, **kw), "bucket")


def _documents(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(a.table(spark, sf_dir, "documents")).select("doc_id", "lang", "n_chars")


def _prefix_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return f.prefix_count(a.corpus(spark, sf_dir), "event_original", "user 1")


def _conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.match_all(a.table(spark, sf_dir, "conversations"), ["role", "text"], "user la").select("conv_id", "turn")


def _part(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(a.table(spark, sf_dir, "part"))


def _part_trigram(parts: DataFrame) -> DataFrame:
    found = s.match_trigram(parts, "p_name", PART_TRIGRAM)
    return found.select("p_partkey", "p_name", F.round("similarity", 6).alias("similarity"))


def _severity_counts(df: DataFrame) -> DataFrame:
    return g.count_by(f.severity_at_most(df, 2), "event_severity")


QUERIES: dict[str, Query] = {
    # The two suites
    **{name: _baseline(name) for name in (
        "time_range_search", "filter_by_dataset", "filter_by_source_ip", "filter_by_destination_ip", "alerts_by_severity",
        "alerts_by_rule", "top_source_ip_by_event_count", "top_destination_ip_by_event_count",
        "top_talkers_by_network_bytes", "message_search")},
    **{name: _showcase(name) for name in (
        "multi_field_latest_hits", "autocomplete_latest_hits", "fuzzy_latest_hits", "search_facet_top_source_ips",
        "search_timeline_histogram", "ip_pivot_latest_hits")},
    # The port as the relational side reads it: out of the JSON payload.
    "search_facet_top_destination_ports": _showcase("search_facet_top_destination_ports", serving=True),
    "autocomplete_whole_text": _showcase("autocomplete_latest_hits", "sql"),
    "trigram_latest_hits": _showcase("fuzzy_latest_hits", "sql"),
    "search_timeline_newest": _showcase("search_timeline_histogram", "sql"),
    # Filters and listings
    "filter_eq_rows": _on_corpus(lambda df: f.eq_filter(df, "source_ip", SOURCE).select("event_id", "message")),
    "filter_isin": _on_corpus(lambda df: f.isin_filter(df, "rule_id", ["1:7:1", "1:8:1", "1:9:1"]).select("event_id", "rule_id")),
    "filter_severity": _on_corpus(_severity_counts),
    "ip_pivot": _on_corpus(lambda df: f.ip_pivot(df, SOURCE).select("event_id", "source_ip", "destination_ip")),
    "large_transfers": _on_corpus(lambda df: f.large_transfers(df, 100_000).select("event_id", "network_bytes")),
    "prefix_count": _prefix_count,
    "payload_int": _on_corpus(lambda df: _serving(df).select(
        "event_id", f.payload_int("payload", "destination.port").alias("port"),
        f.payload_int("payload", "event.severity").alias("severity"), f.payload_int("payload", "message").alias("text"))),
    "latest_events": _on_corpus(_hits),
    "recent_events": _on_corpus(lambda df: a.iso_text(s.recent_events(df, 50), "event_timestamp")),
    # Counts, top lists, timelines
    "alerts_by_rule_name": _on_corpus(lambda df: g.top_counts(_alerts(df), "rule_name")),
    "top_talkers_by_count": _on_corpus(
        lambda df: g.top_sum(df, "source_ip", "network_bytes", name="total_bytes", order_by="count")),
    "volume_by_dataset": _on_corpus(lambda df: g.top_counts(df, "event_dataset")),
    "timeline": _on_corpus(lambda df: _timeline(df)),
    "timeline_filled": _on_corpus(lambda df: _timeline(df, fill=True)),
    "timeline_newest": _on_corpus(lambda df: _timeline(df, newest=120)),
    # Text search
    "match_all_documents": _documents(lambda df: s.match_all(df, ["text"], DOC_QUERY)),
    "match_all_conversations": _conversations,
    "prefix_any_documents": _documents(lambda df: s.match_prefix(df, "text", DOC_PREFIX)),
    "prefix_whole_documents": _documents(lambda df: s.match_prefix(df, "text", "the ", mode="whole")),
    "match_fuzzy_documents": _documents(lambda df: s.match_fuzzy(df, "text", DOC_FUZZY)),
    "match_fuzzy_parts": _part(lambda df: s.match_fuzzy(df, "p_name", PART_FUZZY).select("p_partkey", "p_name")),
    "match_trigram_parts": _part(_part_trigram),
}

# ---------------------------------------------------------------------------------------------- SQL for the check
TYPED, MISTYPED = "ssl tcp con", "ssl tcp connectio"  # what a user has typed of QUERY, and QUERY with a typing error
_RANGE = f"event_time BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'"
_TOKEN = r"'[\p{L}\p{N}_]+(?:[.''][\p{L}\p{N}_]+)*'"
_NEWEST = "ORDER BY event_time DESC, event_id LIMIT"


def _tokens(column: str) -> str:
    return f"regexp_extract_all(lower({column}), {_TOKEN})"


def _all(column: str, query: str) -> str:
    terms = ", ".join(f"'{q}'" for q in query.lower().split())
    return f"list_has_all({_tokens(column)}, [{terms}])"


def _prefix(column: str, query: str) -> str:
    *lead, last = query.lower().split()
    tests = [f"x = '{q}'" for q in lead] + [f"starts_with(x, '{last}')"]
    return f"len(list_filter({_tokens(column)}, lambda x: {' OR '.join(tests)})) > 0"


def _fuzzy(column: str, query: str) -> str:
    # Edits allowed by length: none up to two characters, one up to five, else two.
    allowed = "CASE WHEN length('{0}') <= 2 THEN 0 WHEN length('{0}') <= 5 THEN 1 ELSE 2 END"
    tests = [f"(x[1] = '{q[0]}' AND damerau_levenshtein(x, '{q}') <= {allowed.format(q)})" for q in query.lower().split()]
    return f"len(list_filter({_tokens(column)}, lambda x: {' OR '.join(tests)})) > 0"


def _trigram(column: str, query: str) -> str:
    def trigrams(text: str) -> str:
        return (f"list_distinct(flatten(list_transform(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+'), "
                "lambda w: list_transform(range(1, len(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))")

    pieces, wanted = trigrams(column), trigrams(f"'{query}'")
    shared = f"len(list_intersect({pieces}, {wanted}))"
    return f"({shared} / (len({pieces}) + len({wanted}) - {shared}))"


def _latest(where: str, n: int = 25) -> str:
    return a.sql(f"SELECT event_id, event_timestamp FROM corpus WHERE {where} {_NEWEST} {n}")


def _count(where: str, name: str = "event_count") -> str:
    return a.sql(f"SELECT count(*) AS {name} FROM corpus WHERE {where}")


def _top(key: str, source: str = "corpus", *more: str) -> str:
    return a.sql(f"SELECT {key}, count(*) AS event_count FROM {source} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10", *more)


def _minutes(where: str, tail: str = "") -> str:
    return a.sql(f"SELECT strftime(date_trunc('minute', event_time), {a.ISO}) AS bucket, count(*) AS event_count "
                 f"FROM corpus WHERE {where} GROUP BY 1 ORDER BY 1 DESC {tail}")


def _docs(where: str) -> str:
    return f"SELECT doc_id, lang, n_chars FROM documents WHERE {where}"


ALERTS_CTE = """alerts AS (
  SELECT *, CASE WHEN event_type = 'error' THEN event_severity WHEN network_bytes >= 1000000 THEN 2 ELSE 3 END AS severity,
    CASE WHEN event_type = 'error' THEN rule_id
         WHEN network_bytes >= 1000000 THEN 'benchmark.zeek.large_transfer'
         WHEN contains(message, 'http') AND destination_port NOT IN (80, 8080, 8000, 8888)
         THEN 'benchmark.zeek.protocol_anomaly' ELSE 'benchmark.zeek.connection' END AS alert_rule,
    CASE WHEN event_type = 'error' THEN rule_name
         WHEN network_bytes >= 1000000 THEN 'benchmark.large_transfer'
         WHEN contains(message, 'http') AND destination_port NOT IN (80, 8080, 8000, 8888)
         THEN 'benchmark.protocol_anomaly' ELSE 'benchmark.connection' END AS alert_name
  FROM corpus WHERE benchmark_seq % 5 = 0)"""
_FOUND = f"{_RANGE} AND {_all('message || chr(32) || event_original', RAW_QUERY)}"

ORACLES: dict[str, str] = {
    "time_range_search": _latest(f"event_time BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{MID}'", 50),
    "filter_by_dataset": _count("event_dataset = 'zeek.conn'"),
    "filter_by_source_ip": _count(f"source_ip = '{SOURCE}'"),
    "filter_by_destination_ip": _count(f"destination_ip = '{DESTINATION}'"),
    "filter_eq_rows": a.sql(f"SELECT event_id, message FROM corpus WHERE source_ip = '{SOURCE}'"),
    "filter_isin": a.sql("SELECT event_id, rule_id FROM corpus WHERE rule_id IN ('1:7:1', '1:8:1', '1:9:1')"),
    "filter_severity": a.sql("SELECT event_severity, count(*) AS event_count FROM corpus WHERE event_severity <= 2 GROUP BY 1"),
    "ip_pivot": a.sql(f"SELECT event_id, source_ip, destination_ip FROM corpus WHERE '{SOURCE}' IN (source_ip, destination_ip)"),
    "ip_pivot_latest_hits": _latest(f"{_RANGE} AND '{SOURCE}' IN (source_ip, destination_ip)"),
    "large_transfers": a.sql("SELECT event_id, network_bytes FROM corpus WHERE network_bytes >= 100000"),
    "prefix_count": _count("starts_with(event_original, 'user 1')", "row_count"),
    "payload_int": a.sql("SELECT CAST(event_id AS VARCHAR) AS event_id, destination_port AS port, event_severity AS severity, "
                         "CAST(NULL AS INTEGER) AS text FROM corpus"),
    "latest_events": _latest("TRUE"),
    "recent_events": a.sql("SELECT event_timestamp, event_dataset, source_ip, destination_ip, network_bytes, message "
                           "FROM corpus ORDER BY event_time DESC, source_ip, destination_ip, message LIMIT 50"),
    "alerts_by_severity": a.sql("SELECT severity AS event_severity, count(*) AS event_count FROM alerts GROUP BY 1", ALERTS_CTE),
    "alerts_by_rule": a.sql("SELECT alert_rule AS rule_id, count(*) AS event_count FROM alerts GROUP BY 1 "
                            "ORDER BY 2 DESC, 1 LIMIT 10", ALERTS_CTE),
    "alerts_by_rule_name": a.sql("SELECT alert_name AS rule_name, count(*) AS event_count FROM alerts GROUP BY 1 "
                                 "ORDER BY 2 DESC, 1 LIMIT 10", ALERTS_CTE),
    "top_source_ip_by_event_count": _top("source_ip"),
    "top_destination_ip_by_event_count": _top("destination_ip"),
    "top_talkers_by_network_bytes": a.sql(
        "SELECT source_ip, CAST(sum(network_bytes) AS BIGINT) AS total_bytes FROM corpus GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"),
    "top_talkers_by_count": a.sql(
        "SELECT source_ip, CAST(sum(network_bytes) AS BIGINT) AS total_bytes FROM corpus GROUP BY 1 "
        "ORDER BY count(*) DESC, 1 LIMIT 10"),
    "volume_by_dataset": _top("event_dataset"),
    "timeline": _minutes("TRUE"),
    "timeline_filled": a.sql(f"""
      SELECT strftime(m.bucket, {a.ISO}) AS bucket, count(c.event_id) AS event_count
      FROM (SELECT unnest(generate_series(date_trunc('minute', min(event_time)), date_trunc('minute', max(event_time)),
                                          INTERVAL 1 MINUTE)) AS bucket FROM corpus) m
      LEFT JOIN corpus c ON date_trunc('minute', c.event_time) = m.bucket GROUP BY 1"""),
    "timeline_newest": _minutes("TRUE", "LIMIT 120"),
    "message_search": _latest(f"{_RANGE} AND {_all('message', QUERY)}"),
    "multi_field_latest_hits": _latest(_FOUND),
    "autocomplete_latest_hits": _latest(f"{_RANGE} AND {_prefix('message', TYPED)}"),
    "autocomplete_whole_text": _latest(f"{_RANGE} AND starts_with(lower(message), '{TYPED}')"),
    "fuzzy_latest_hits": _latest(f"{_RANGE} AND {_fuzzy('message', MISTYPED)}"),
    "trigram_latest_hits": a.sql(f"""
      SELECT event_id, event_timestamp, round(similarity, 6) AS similarity
      FROM (SELECT *, {_trigram('message', MISTYPED)} AS similarity FROM corpus WHERE {_RANGE})
      WHERE similarity >= 0.3 ORDER BY similarity DESC, event_time DESC, event_id LIMIT 25"""),
    "search_facet_top_destination_ports": _top("destination_port", f"corpus WHERE {_FOUND}"),
    "search_facet_top_source_ips": _top("source_ip", f"corpus WHERE {_FOUND}"),
    "search_timeline_histogram": _minutes(_FOUND),
    "search_timeline_newest": _minutes(_FOUND, "LIMIT 120"),
    "match_all_documents": _docs(_all("text", DOC_QUERY)),
    "match_all_conversations": f"SELECT conv_id, turn FROM conversations WHERE {_all('role || chr(32) || text', 'user la')}",
    "prefix_any_documents": _docs(_prefix("text", DOC_PREFIX)),
    "prefix_whole_documents": _docs("starts_with(lower(text), 'the ')"),
    "match_fuzzy_documents": _docs(_fuzzy("text", DOC_FUZZY)),
    "match_fuzzy_parts": f"SELECT p_partkey, p_name FROM part WHERE {_fuzzy('p_name', PART_FUZZY)}",
    "match_trigram_parts": f"""
      SELECT p_partkey, p_name, round(similarity, 6) AS similarity
      FROM (SELECT *, {_trigram('p_name', PART_TRIGRAM)} AS similarity FROM part) WHERE similarity >= 0.3""",
}
