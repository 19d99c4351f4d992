"""Time the headline queries and print one JSON line.

Each query runs once to warm up and then ``BENCH_RUNS`` times (default 2) to completion with its result discarded in
the executors; the median counts. Rates are rows of the scanned table per second.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from sentrylake.plans.adapter import normalise_again  # noqa: E402
from sentrylake.plans.catalog import QUERIES  # noqa: E402
from sentrylake.session import build_session  # noqa: E402

HEADLINE = """
    rule_port_scan rule_top_talkers rule_exfiltration rule_alert_burst rule_correlation rule_protocol_anomaly
    stream_port_scan stream_top_talkers stream_exfiltration stream_alert_burst stream_correlation stream_protocol_anomaly
    parse_conn_log parse_ids_blocks decode_json lake_counts stream_lake overwrite_run
    time_range_search filter_by_source_ip alerts_by_severity top_source_ip_by_event_count top_talkers_by_network_bytes
    message_search multi_field_latest_hits autocomplete_latest_hits fuzzy_latest_hits trigram_latest_hits
    search_facet_top_destination_ports search_facet_top_source_ips search_timeline_histogram ip_pivot_latest_hits
    match_all_documents match_fuzzy_documents evidence_for latency_summary scale_out
""".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    times: dict[str, float] = {}
    took = []
    for _ in range(runs + 1):  # what every event query reads: extraction from JSON, sorting and writing
        start = time.perf_counter()
        normalise_again(spark, sf_dir)
        took.append(time.perf_counter() - start)
    times["normalise_events"] = round(statistics.median(took[1:]), 3)
    for name in names:
        took = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - start)
        times[name] = round(statistics.median(took[1:]), 3)
        print(f"{name}: first {took[0]:.2f}s, then {times[name]:.2f}s", file=sys.stderr)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "events_per_sec": {n: round(events / t) for n, t in times.items() if n.startswith(("rule_", "stream_"))},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
