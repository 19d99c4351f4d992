"""The two investigation suites as named queries over an event table and an alert table.

``events`` and ``alerts`` are flat or serving tables that carry ``benchmark_id``, ``event_id`` and ``event_timestamp``.
A query is built only when its entry is called.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentrylake.functions.text import fuzzy_term, prefix_term
from sentrylake.operators import aggregates as g
from sentrylake.operators import filters as f
from sentrylake.operators import search as s


@dataclass(frozen=True)
class SuiteParams:
    """What a run's summary says about it: see :func:`sentrylake.operators.aggregates.corpus_summary`."""

    run_id: str
    start: str
    mid: str
    end: str
    dataset: str
    source_ip: str
    destination_ip: str
    message_term: str = "ssl tcp connection"
    raw_term: str | None = None  # for the searches over message and raw text; default: the message term


Suite = dict[str, Callable[[], DataFrame]]


def _listed(df: DataFrame, n: int) -> DataFrame:
    return s.latest(df, n).select("event_id", "event_timestamp")


def baseline_suite(events: DataFrame, alerts: DataFrame, p: SuiteParams) -> Suite:
    """Ten everyday queries: listings, filtered counts, alert counts, top lists, message search."""
    def run(df: DataFrame) -> DataFrame:
        return f.eq_filter(df, "benchmark_id", p.run_id)

    def between(end: str) -> DataFrame:
        return f.time_range(events, p.start, end, run=("benchmark_id", p.run_id))

    def counted(column: str, value: str) -> DataFrame:
        return f.count_where(run(events), F.col(column) == value)

    return {
        "time_range_search": lambda: _listed(between(p.mid), 50),
        "filter_by_dataset": lambda: counted("event_dataset", p.dataset),
        "filter_by_source_ip": lambda: counted("source_ip", p.source_ip),
        "filter_by_destination_ip": lambda: counted("destination_ip", p.destination_ip),
        "alerts_by_severity": lambda: g.count_by(run(alerts), "event_severity"),
        "alerts_by_rule": lambda: g.top_counts(run(alerts), "rule_id"),
        "top_source_ip_by_event_count": lambda: g.top_counts(run(events), "source_ip"),
        "top_destination_ip_by_event_count": lambda: g.top_counts(run(events), "destination_ip"),
        "top_talkers_by_network_bytes": lambda: g.top_sum(run(events), "source_ip", "network_bytes", name="total_bytes"),
        "message_search": lambda: _listed(s.match_all(between(p.end), ["message"], p.message_term), 25),
    }


def showcase_suite(events: DataFrame, p: SuiteParams, dialect: str = "search") -> Suite:
    """Seven search-centred queries.

    The two dialects differ where the original ones do: search-as-you-type matches tokens (``search``) or the start of
    the text (``sql``), and typing errors are forgiven by edit distance or by trigram similarity.
    """
    if dialect not in ("search", "sql"):
        raise ValueError(dialect)
    rows = f.time_range(events, p.start, p.end, run=("benchmark_id", p.run_id))
    prefix, fuzzy = prefix_term(p.message_term), fuzzy_term(p.message_term)

    def found() -> DataFrame:
        return s.match_all(rows, ["message", "event_original"], p.raw_term or p.message_term)

    def ports() -> DataFrame:
        hits = found()
        if "destination_port" not in hits.columns:  # a serving table keeps it in the payload
            hits = hits.select(f.payload_int("payload", "destination.port").alias("destination_port"))
        return s.facet(hits, "destination_port")

    def typing_errors() -> DataFrame:
        if dialect == "search":
            return _listed(s.match_fuzzy(rows, "message", fuzzy), 25)
        return s.best_trigram(rows, "message", fuzzy, 25).select("event_id", "event_timestamp", "similarity")

    return {
        "multi_field_latest_hits": lambda: _listed(found(), 25),
        "autocomplete_latest_hits": lambda: _listed(
            s.match_prefix(rows, "message", prefix, "any" if dialect == "search" else "whole"), 25),
        "fuzzy_latest_hits": typing_errors,
        "search_facet_top_destination_ports": ports,
        "search_facet_top_source_ips": lambda: s.facet(found(), "source_ip"),
        # Only the SQL dialect's question asks for the newest 120 buckets.
        "search_timeline_histogram": lambda: g.timeline(found(), newest=None if dialect == "search" else 120),
        "ip_pivot_latest_hits": lambda: _listed(f.ip_pivot(rows, p.source_ip), 25),
    }
