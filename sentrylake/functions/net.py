"""Address and connection expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Private address ranges as LIKE patterns.
INTERNAL_PATTERNS = (
    "10.%", "192.168.%", "172.16.%", "172.17.%", "172.18.%", "172.19.%", "172.2_.%", "172.30.%", "172.31.%",
)


def is_internal(ip: Column | str, patterns: tuple[str, ...] = INTERNAL_PATTERNS) -> Column:
    """True for an address matching a pattern; NULL for a NULL address."""
    column = F.col(ip) if isinstance(ip, str) else ip
    return reduce(or_, [column.like(p) for p in patterns])


def with_internal_flags(df: DataFrame, patterns: tuple[str, ...] = INTERNAL_PATTERNS) -> DataFrame:
    return df.withColumns({
        "source_is_internal": is_internal("source_ip", patterns),
        "destination_is_internal": is_internal("destination_ip", patterns),
    })


def related_ips(*cols: str, keep_nulls: bool = False) -> Column:
    """The addresses of a row as an array; ingestion drops NULLs, the rules keep them."""
    ips = F.array(*cols)
    return ips if keep_nulls else F.array_compact(ips)


def conn_message() -> Column:
    """Readable summary of a connection. A missing part is written ``None``, a missing service is left out."""
    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("None"))

    return F.concat(
        F.coalesce(F.concat("network_protocol", F.lit(" ")), F.lit("")), text("network_transport"),
        F.lit(" connection "), text("source_ip"), F.lit(":"), text("source_port"), F.lit(" -> "),
        text("destination_ip"), F.lit(":"), text("destination_port"),
    )
