"""Intrusion-alert logs: blocks of lines separated by blank lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentrylake.functions.net import related_ips
from sentrylake.schemas import IDS_FIELDS, flat_name
from sentrylake.sources.line_blocks import BLANKS as _BLANKS
from sentrylake.sources.line_blocks import read_blocks

# The line formats of a block, in the order in which they may follow each other.
RULE_LINE = r"^\[\*\*\] \[(\d+):(\d+):(\d+)\] (.+) \[\*\*\]$"
CLASS_LINE = r"^\[Classification: (.+?)\] \[Priority: (\d+)\]\s*$"
ADDRESS_LINE = (
    r"^(\d{2}/\d{2})-(\d{2}:\d{2}:\d{2}\.\d{6}) (\d+\.\d+\.\d+\.\d+):(\d+) -> (\d+\.\d+\.\d+\.\d+):(\d+)$")
PROTOCOL_LINE = r"^(TCP|UDP|ICMP)\s+TTL:(\d+)\s+TOS:(\S+)\s+ID:(\d+)\s+IpLen:(\d+)\s+DgmLen:(\d+)(?:\s+(.*))?$"
TCP_LINE = (
    r"^(\S+)\s+Seq:\s+(0x[0-9A-Fa-f]+)\s+Ack:\s+(0x[0-9A-Fa-f]+)\s+Win:\s+(0x[0-9A-Fa-f]+)\s+TcpLen:\s+(\d+)$")
XREF_LINE = r"^\[Xref => (.+?)\]$"

_BLANK_LINES = r"(?>\r\n|\n|\r)[ \t\x0b\x0c]*(?>\r\n|\n|\r)"


def _part(line: str, pattern: str, group: int) -> Column:
    """A piece of a line; NULL if the line is absent or of another format, or if the piece is empty."""
    return F.nullif(F.regexp_extract(line, pattern, group), F.lit(""))


def _number(line: str, pattern: str, group: int) -> Column:
    return _part(line, pattern, group).try_cast("int")


def _is(line: str, pattern: str) -> Column:
    return F.coalesce(F.col(line).rlike(pattern), F.lit(False))


def parse_ids_blocks(records: DataFrame, column: str = "value", year: int = 2012) -> tuple[DataFrame, DataFrame]:
    """Text records of one or more blocks -> (events, rejects).

    A block whose address line is absent or of another format becomes an event without a time; see
    :func:`sentrylake.sources.streams.split_quarantine`. The log carries no year, so it is a parameter.
    """
    path = F.col("log_file_path") if "log_file_path" in records.columns else F.lit(None).cast("string")
    return parse_blocks(records.select(path.alias("log_file_path"), F.explode(F.split(column, _BLANK_LINES)).alias("raw")), year)


def parse_blocks(blocks: DataFrame, year: int = 2012) -> tuple[DataFrame, DataFrame]:
    """Single blocks (``log_file_path``, ``raw``) -> (events, rejects), as :func:`parse_ids_blocks` does."""
    kept = F.filter(F.split("raw", r"\r\n|\n|\r"), lambda line: F.btrim(line, F.lit(_BLANKS)) != "")
    # Generating the lines as a row of their own makes Spark split a block once, not once per condition below.
    listed = blocks.where(F.btrim("raw", F.lit(_BLANKS)) != "").select(
        "log_file_path", F.explode(F.array(kept)).alias("kept")).select(
        "log_file_path", F.array_join("kept", "\n").alias("block"),
        F.transform("kept", lambda line: F.btrim(line, F.lit(_BLANKS))).alias("lines"))

    # Each optional line shifts the place of the following ones by one.
    first = listed.withColumns({"rule_line": F.get("lines", F.lit(0)), "class_line": F.get("lines", F.lit(1))})
    valid = (F.size("lines") >= 3) & _is("rule_line", RULE_LINE)
    rejects = first.where(~valid).select("block", "log_file_path")
    placed = (
        first.where(valid)
        .withColumn("at", F.lit(1) + _is("class_line", CLASS_LINE).cast("int"))
        .withColumn("address_line", F.get("lines", F.col("at")))
        .withColumn("addressed", _is("address_line", ADDRESS_LINE))
        .withColumn("protocol_line", F.when(F.col("addressed"), F.get("lines", F.col("at") + 1)))
        .withColumn("at", F.col("at") + 1 + _is("protocol_line", PROTOCOL_LINE).cast("int"))
        .withColumn("tcp_line", F.when(F.col("addressed"), F.get("lines", F.col("at"))))
        .withColumn("at", F.col("at") + _is("tcp_line", TCP_LINE).cast("int"))
        .withColumn("rest", F.when(F.col("addressed"), F.slice("lines", F.col("at") + 1, F.size("lines")))))
    return _events(placed, year), rejects


def _events(placed: DataFrame, year: int) -> DataFrame:
    rule, address, protocol, tcp = "rule_line", "address_line", "protocol_line", "tcp_line"
    when = F.try_to_timestamp(
        F.concat(F.lit(f"{year}/"), _part(address, ADDRESS_LINE, 1), F.lit(" "), _part(address, ADDRESS_LINE, 2)),
        F.lit("yyyy/MM/dd HH:mm:ss.SSSSSS"))
    xrefs = F.filter("rest", lambda line: line.rlike(XREF_LINE))
    others = F.filter("rest", lambda line: ~line.rlike(XREF_LINE))
    title = _part(rule, RULE_LINE, 4)
    typed = placed.select(
        when.alias("event_timestamp"), F.lit("alert").alias("event_kind"),
        F.array(F.lit("intrusion_detection")).alias("event_category"), F.array(F.lit("info")).alias("event_type"),
        F.lit("snort").alias("event_module"), F.lit("snort.alert").alias("event_dataset"),
        _number("class_line", CLASS_LINE, 2).alias("event_severity"),
        F.concat_ws(":", *[_part(rule, RULE_LINE, i) for i in (1, 2, 3)]).alias("rule_id"),
        title.alias("rule_name"), _part("class_line", CLASS_LINE, 1).alias("rule_category"),
        _part(address, ADDRESS_LINE, 3).alias("source_ip"), _number(address, ADDRESS_LINE, 4).alias("source_port"),
        _part(address, ADDRESS_LINE, 5).alias("destination_ip"),
        _number(address, ADDRESS_LINE, 6).alias("destination_port"),
        F.lower(_part(protocol, PROTOCOL_LINE, 1)).alias("network_transport"), title.alias("message"),
        F.col("block").alias("event_original"), _number(rule, RULE_LINE, 1).alias("snort_generator_id"),
        _number(rule, RULE_LINE, 2).alias("snort_signature_id"),
        _number(rule, RULE_LINE, 3).alias("snort_signature_revision"),
        _number(protocol, PROTOCOL_LINE, 2).alias("snort_ip_ttl"), _part(protocol, PROTOCOL_LINE, 3).alias("snort_ip_tos"),
        _number(protocol, PROTOCOL_LINE, 4).alias("snort_ip_id"), _number(protocol, PROTOCOL_LINE, 5).alias("snort_ip_len"),
        _part(protocol, PROTOCOL_LINE, 7).alias("snort_ip_flags"),
        _number(protocol, PROTOCOL_LINE, 6).alias("snort_packet_len"),
        _part(tcp, TCP_LINE, 1).alias("snort_tcp_flags_raw"), _part(tcp, TCP_LINE, 2).alias("snort_tcp_seq"),
        _part(tcp, TCP_LINE, 3).alias("snort_tcp_ack"), _part(tcp, TCP_LINE, 4).alias("snort_tcp_window"),
        _number(tcp, TCP_LINE, 5).alias("snort_tcp_len"),
        F.regexp_extract(F.get(xrefs, F.size(xrefs) - 1), XREF_LINE, 1).alias("snort_xref"),
        F.col("log_file_path"),
        F.when(F.size(others) > 0, others).alias("snort_extra"))
    ips = F.when(F.col("source_ip").isNotNull(), related_ips("source_ip", "destination_ip"))
    return typed.withColumn("related_ip", ips).select(*[flat_name(name) for name in IDS_FIELDS], "snort_extra")


def read_ids_blocks(
    spark: SparkSession, path: str, year: int = 2012, glob: str | None = None, newline: str | None = None,
    limit: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Read block logs -> (events, rejects), with the file each block came from.

    Files are read line by line in splits, see :mod:`sentrylake.sources.line_blocks`: lines may end and blank lines may
    look as they like. For logs whose blocks are parted by empty lines alone, ``newline`` (``"\n"`` or ``"\r\n"``) lets
    Spark's reader cut the records, without Python in the tasks; where the separators are others the result is the same,
    but a file may be one record.
    """
    if newline is None:
        blocks = read_blocks(spark, path, glob).withColumnRenamed("file", "log_file_path")
        events, rejects = parse_blocks(blocks, year)
    else:
        reader = spark.read.option("lineSep", newline * 2)
        if glob:
            reader = reader.option("pathGlobFilter", glob)
        records = reader.text(path).select("value", F.col("_metadata.file_path").alias("log_file_path"))
        events, rejects = parse_ids_blocks(records, year=year)
    return (events.limit(limit) if limit is not None else events), rejects
