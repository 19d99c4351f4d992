"""The windowed rules and the anomaly checks in plain Python, straight from their description, over bus documents."""

from collections import Counter, defaultdict


def seconds(text):
    h, m, s = text[11:19].split(":")
    return int(h) * 3600 + int(m) * 60 + int(s)


def clock(at):
    return f"{at // 3600:02d}:{at // 60 % 60:02d}:{at % 60:02d}"


def windows(rows, size, slide, key):
    """(start, end, key) -> rows, for all windows that hold a row."""
    found = defaultdict(list)
    for row in rows:
        at = seconds(row["@timestamp"])
        start = at // slide * slide
        while start > at - size:
            found[clock(start), clock(start + size), key(row)].append(row)
            start -= slide
    return found


def internal(ip):
    return ip.startswith(("10.", "192.168.", *[f"172.{n}." for n in range(16, 32)]))


def total(rows, field):
    return sum(r[field] for r in rows)


def port_scan(conns):
    """{(start, end, source, flows, ports, addresses, bytes, severity)}"""
    out = set()
    for (start, end, source), rows in windows(conns, 120, 30, lambda r: r["source.ip"]).items():
        ports, ips = len({r["destination.port"] for r in rows}), len({r["destination.ip"] for r in rows})
        if ports >= 5 or ips >= 3:
            out.add((start, end, source, len(rows), ports, ips, total(rows, "network.bytes"), 2 if ports >= 10 or ips >= 6 else 3))
    return out


def top_talkers(conns):
    """{(source, destination, bytes, flows, severity, start)}"""
    out = set()
    for side in ("source", "destination"):
        for (start, _, host), rows in windows(conns, 300, 300, lambda r, side=side: r[f"{side}.ip"]).items():
            size = total(rows, "network.bytes")
            if size >= 5_000_000 and len(rows) >= 3:
                named = (host, None) if side == "source" else (None, host)
                out.add((*named, size, len(rows), 2 if size >= 10_000_000 else 3, start))
    return out


def exfiltration(conns):
    """{(source, start, sample, bytes, addresses, flows, severity)}"""
    out, rows = set(), [r for r in conns if internal(r["source.ip"]) and not internal(r["destination.ip"])]
    for (start, _, source), own in windows(rows, 300, 60, lambda r: r["source.ip"]).items():
        sent, peers = total(own, "source.bytes"), {r["destination.ip"] for r in own}
        if sent >= 4_000_000 and len(own) >= 3:
            out.add((source, start, min(peers), total(own, "network.bytes"), len(peers), len(own), 1 if sent >= 8_000_000 else 2))
    return out


def alert_burst(ids):
    """{(source, start, sample, alerts, rule ids, severity)}"""
    out, rows = set(), [r for r in ids if r["event.severity"] <= 2]
    for (start, _, source), own in windows(rows, 300, 60, lambda r: r["source.ip"]).items():
        if len(own) >= 3:
            rules = ",".join(sorted(r["rule.id"] for r in own))
            out.add((source, start, min(r["destination.ip"] for r in own), len(own), rules, 1 if len(own) >= 6 else 2))
    return out


def correlation(ids, conns):
    """{(alert time, flow time, destination, bytes, severity)}"""
    return {
        (a["@timestamp"][11:19], c["@timestamp"][11:19], c["destination.ip"], c["network.bytes"],
         1 if a["event.severity"] <= 1 and c["network.bytes"] >= 2_000_000 else 2)
        for a in ids for c in conns
        if a["event.severity"] <= 2 and c["network.bytes"] >= 1_000_000 and a["source.ip"] == c["source.ip"]
        and 0 <= seconds(c["@timestamp"]) - seconds(a["@timestamp"]) <= 120}


def anomalies(conns):
    """{(time, source, port, type, severity)}"""
    out = set()
    for c in conns:
        service, port = c["network.protocol"], c["destination.port"]
        odd = {"http": (80, 8080, 8000, 8888), "dns": (53, 5353), "ssh": (22,)}
        if service is None and c["network.bytes"] >= 750_000:
            kind, severity = "unknown_service_high_bytes", 2
        elif service in odd and port not in odd[service]:
            kind, severity = f"{service}_unexpected_port", 3
        elif service == "http" and c["network.transport"] == "udp":
            kind, severity = "http_over_udp", 3
        else:
            continue
        out.add((c["@timestamp"][11:19], c["source.ip"], port, kind, severity))
    return out


def counts(conns, ids, until=None):
    """Alerts by rule; with ``until`` (seconds of the day) only of windows that ended by then, each input with its own."""
    def closed(starts, size, rows):
        limit = None if until is None else max(seconds(r["@timestamp"]) for r in rows) - until
        return sum(limit is None or seconds(f"           {s}") + size <= limit for s in starts)

    return Counter({
        "port_scan": closed([x[0] for x in port_scan(conns)], 120, conns), "top_talkers": closed([x[5] for x in top_talkers(conns)], 300, conns),
        "exfiltration": closed([x[1] for x in exfiltration(conns)], 300, conns), "alert_burst": closed([x[1] for x in alert_burst(ids)], 300, ids),
        "correlation": len(correlation(ids, conns)), "protocol_anomaly": len(anomalies(conns))})
