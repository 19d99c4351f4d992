"""The alert document: one builder shared by all rules."""

from __future__ import annotations

from dataclasses import dataclass
from string import Formatter

from pyspark.sql import DataFrame

from sentrylake.schemas import ALERT_SCHEMA

# Fixed value: the producer name that prefixes rule ids and pipelines in alert documents.
PRODUCER = "flink"
ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS"


@dataclass(frozen=True)
class RuleMeta:
    """What is constant about a rule's alerts."""

    name: str
    category: str
    event_category: tuple[str, ...]
    event_type: tuple[str, ...]


def iso(column: str) -> str:
    """Timestamp text of alert documents: milliseconds, no zone suffix."""
    return f"date_format({column}, '{_quote(ISO_MILLIS)}')"


def _quote(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def say(template: str) -> str:
    """SQL for a sentence with ``{expression}`` parts; NULL if any part is NULL."""
    pieces = []
    for literal, expression, _, _ in Formatter().parse(template):
        if literal:
            pieces.append(f"'{_quote(literal)}'")
        if expression:
            pieces.append(f"CAST({expression} AS STRING)")
    return f"concat({', '.join(pieces)})"


def escalate(metric: str, threshold: int, high: int, low: int) -> str:
    """``high`` severity at twice the threshold, else ``low``."""
    return f"if({metric} >= {2 * threshold}, {high}, {low})"


def _texts(values: tuple[str, ...]) -> str:
    return f"array({', '.join(repr(v) for v in values)})"


def to_alert(df: DataFrame, rule: RuleMeta, producer: str = PRODUCER, **columns: str) -> DataFrame:
    """Project rule output to the alert schema.

    ``columns`` are SQL expressions over ``df``; fields not given are typed NULLs.
    """
    rule_id = f"'{_quote(producer)}.{rule.name}'"
    values = {
        "event_kind": "'alert'",
        "event_category": _texts(rule.event_category),
        "event_type": _texts(rule.event_type),
        "event_module": f"'{_quote(producer)}'",
        "event_dataset": "'siem.alert'",
        "rule_id": rule_id,
        "rule_name": f"'{rule.name}'",
        "rule_category": f"'{rule.category}'",
        "pipeline": rule_id,
        **columns,
    }
    unknown = set(values) - set(ALERT_SCHEMA.names)
    if unknown:
        raise ValueError(f"not in the alert schema: {sorted(unknown)}")
    return df.selectExpr(*[
        f"CAST({values.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}" for f in ALERT_SCHEMA
    ])
