"""Investigation searches, facets and listings. Every ``latest`` ends in TakeOrderedAndProject, not in a full sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentrylake.functions import text
from sentrylake.operators.aggregates import top_counts

# The columns of the saved listings.
ALERT_LISTING = ("event_timestamp", "rule_name", "event_severity", "source_ip", "destination_ip", "pipeline", "message")
EVENT_LISTING = ("event_timestamp", "event_dataset", "source_ip", "destination_ip", "network_bytes", "message")


def latest(df: DataFrame, n: int, time_col: str = "event_timestamp", tie: str = "event_id") -> DataFrame:
    """The newest n rows; equal times are ordered by id."""
    return df.orderBy(F.desc(time_col), tie).limit(n)


def recent_alerts(df: DataFrame, n: int | None = None, rule_id: str | None = None) -> DataFrame:
    listed = (df.where(F.col("rule_id") == rule_id) if rule_id else df).select(*ALERT_LISTING)
    ordered = listed.orderBy(F.desc("event_timestamp"), "rule_name", "source_ip", "destination_ip", "message")
    return ordered.limit(n) if n else ordered


def recent_events(df: DataFrame, n: int | None = None) -> DataFrame:
    ordered = df.select(*EVENT_LISTING).orderBy(F.desc("event_timestamp"), "source_ip", "destination_ip", "message")
    return ordered.limit(n) if n else ordered


def match_all(df: DataFrame, columns: list[str], query: str) -> DataFrame:
    """Rows in which every term of the query occurs in some of the columns."""
    return df.where(text.has_all_terms(columns, query))


def match_prefix(df: DataFrame, column: str, query: str, mode: str = "any") -> DataFrame:
    """Search as you type: by token prefixes (``any``) or by the start of the whole text (``whole``)."""
    if mode == "any":
        return df.where(text.has_prefix_terms(column, query))
    if mode == "whole":
        return df.where(text.starts_with_text(column, query))
    raise ValueError(mode)


def match_fuzzy(df: DataFrame, column: str, query: str) -> DataFrame:
    """Rows with a token close to a term of the query."""
    return df.where(text.has_fuzzy_term(column, query))


def match_trigram(df: DataFrame, column: str, query: str, threshold: float = 0.3, score: str = "similarity") -> DataFrame:
    """Rows whose trigram similarity reaches the threshold (above zero), with the score.

    Trigrams are taken once for each row that can share one with the query; the row of one element keeps the optimizer
    from writing them out wherever the score is used.
    """
    if threshold <= 0:
        raise ValueError("the threshold must be above zero")
    rows = df.where(text.may_share_trigram(column, query))
    own = rows.withColumn("_trigrams", F.explode(F.array(text.trigrams(F.lower(column)))))
    return own.withColumn(score, text.shared_trigrams(F.col("_trigrams"), query)).drop("_trigrams").where(
        F.col(score) >= threshold)


def best_trigram(df: DataFrame, column: str, query: str, n: int, time_col: str = "event_timestamp",
                 tie: str = "event_id", threshold: float = 0.3) -> DataFrame:
    """The n most similar rows, newest first among equals."""
    found = match_trigram(df, column, query, threshold)
    return found.orderBy(F.desc("similarity"), F.desc(time_col), tie).limit(n)


def facet(found: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The k most frequent values of a column among the rows found."""
    return top_counts(found.where(F.col(column).isNotNull()), column, k)
