"""Fields of each shape as the one event."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shapelog.functions.profile import extract_timestamp, profile_line
from shapelog.functions.scalars import guess_action, ipv4s, normalize_action, normalize_protocol, to_int
from shapelog.functions.text import extract_all, filled, first_filled, get, last_wins, let, let_all, strip
from shapelog.functions.timestamps import epoch_to_iso, normalize_timestamp
from shapelog.functions.parse import parse_kv
from shapelog.schema import EVENT_FIELDS

NAMES = [n for n, _, _ in EVENT_FIELDS if n not in ("event_id",)]
KINDS = {n: t for n, t, _ in EVENT_FIELDS}


def _event(**values: Column) -> Column:
    return F.struct(*((values[n] if n in values else F.lit(None)).cast(KINDS[n]).alias(n) for n in NAMES))


def _flow(f: Column, src: str, src_port: str, dst: str, dst_port: str, protocol: str) -> dict[str, Column]:
    return {
        "src_ip": get(f, src), "src_port": to_int(get(f, src_port)), "dst_ip": get(f, dst), "dst_port": to_int(get(f, dst_port)),
        "protocol": normalize_protocol(get(f, protocol)),
    }


def kv_event(f: Column, vendor: str = "fortinet") -> Column:
    stamp = strip(F.concat(F.coalesce(get(f, "date"), F.lit("")), F.lit(" "), F.coalesce(get(f, "time"), F.lit(""))))
    return _event(
        timestamp=stamp, vendor=F.lit(vendor), source_format=F.lit("kv_syslog"), event_type=get(f, "type"), action=normalize_action(get(f, "action")),
        **_flow(f, "srcip", "srcport", "dstip", "dstport", "proto"),
        bytes_sent=to_int(get(f, "sentbyte")), bytes_received=to_int(get(f, "rcvdbyte")), user=get(f, "user"), message=get(f, "msg"), confidence=F.lit(0.95),
    )


def cef_event(f: Column) -> Column:
    return _event(
        timestamp=extract_timestamp(F.coalesce(get(f, "syslog_prefix"), F.lit(""))), vendor=F.coalesce(filled(F.lower(get(f, "vendor"))), F.lit("unknown")),
        source_format=F.lit("cef"), event_type=get(f, "cat"), action=normalize_action(get(f, "act")),
        **_flow(f, "src", "spt", "dst", "dpt", "proto"),
        bytes_sent=to_int(get(f, "out")), bytes_received=to_int(get(f, "in")), user=get(f, "duser"), message=get(f, "msg"), confidence=F.lit(0.95),
    )


def leef_event(f: Column) -> Column:
    either = lambda *keys: F.coalesce(first_filled(*(get(f, k) for k in keys)), get(f, keys[-1]))
    stamp = F.coalesce(filled(get(f, "devTime")), extract_timestamp(F.coalesce(get(f, "syslog_prefix"), F.lit(""))))
    return _event(
        timestamp=stamp, vendor=F.coalesce(filled(F.lower(get(f, "vendor"))), F.lit("unknown")), source_format=F.lit("leef"), event_type=get(f, "cat"),
        action=normalize_action(either("act", "event_id")), src_ip=either("src", "srcIP"), src_port=to_int(get(f, "srcPort")), dst_ip=either("dst", "dstIP"),
        dst_port=to_int(get(f, "dstPort")), protocol=normalize_protocol(get(f, "proto")), bytes_sent=to_int(either("bytesOut", "sentBytes")),
        bytes_received=to_int(either("bytesIn", "rcvdBytes")), user=either("usrName", "suser"), message=either("msg", "cat"), confidence=F.lit(0.95),
    )


def rfc5424_event(f: Column) -> Column:
    return _event(
        timestamp=get(f, "timestamp"), vendor=F.coalesce(get(f, "appname"), F.lit("unknown")), source_format=F.lit("syslog5424"),
        event_type=F.when(filled(get(f, "srcIP")).isNotNull(), "traffic").otherwise("other"), action=normalize_action(get(f, "action")),
        **_flow(f, "srcIP", "srcPort", "dstIP", "dstPort", "proto"),
        bytes_sent=to_int(get(f, "bytesSent")), bytes_received=to_int(get(f, "bytesRecv")), user=get(f, "user"), message=get(f, "message"),
        confidence=F.when(get(f, "has_structured_data") == "true", 0.95).otherwise(0.5),
    )


def json_event(f: Column, raw: Column) -> Column:
    """Whole numbers may be JSON numbers of any kind; those of a repeated key come from the map."""
    return let(F.try_parse_json(raw), lambda whole: _from_json(f, whole))


def _from_json(f: Column, whole: Column) -> Column:
    def number(key: str) -> Column:
        return F.coalesce(F.try_variant_get(whole, f"$.{key}", "bigint"), to_int(get(f, key)))

    start = F.coalesce(F.try_variant_get(whole, "$.start", "bigint").cast("string"), get(f, "start"))
    return _event(
        timestamp=epoch_to_iso(start), vendor=F.lit("cloud"), source_format=F.lit("json"), event_type=F.lit("flow"), action=normalize_action(get(f, "action")),
        src_ip=get(f, "srcaddr"), src_port=number("srcport"), dst_ip=get(f, "dstaddr"), dst_port=number("dstport"), protocol=normalize_protocol(get(f, "protocol")),
        bytes_sent=number("bytes"), packets=number("packets"), confidence=F.lit(0.98),
    )


def csv_event(f: Column) -> Column:
    return _event(
        timestamp=get(f, "timestamp"), vendor=F.lit("generic"), source_format=F.lit("csv"), event_type=F.lit("traffic"), action=normalize_action(get(f, "action")),
        **_flow(f, "source_ip", "source_port", "destination_ip", "destination_port", "protocol"),
        bytes_sent=to_int(get(f, "bytes_sent")), bytes_received=to_int(get(f, "bytes_received")), packets=to_int(get(f, "packets")), confidence=F.lit(0.98),
    )


def coded_event(f: Column) -> Column:
    return _event(
        timestamp=get(f, "timestamp"), vendor=F.coalesce(get(f, "vendor"), F.lit("unknown")), source_format=F.lit("coded_syslog"), event_type=get(f, "event_type"),
        action=F.coalesce(get(f, "action"), F.lit("other")), **_flow(f, "src_ip", "src_port", "dst_ip", "dst_port", "protocol"),
        bytes_sent=to_int(get(f, "bytes")), user=get(f, "user"), message=get(f, "description"),
        confidence=F.when(get(f, "matched_code") != "true", 0.3).when(get(f, "body_matched") != "true", 0.5).otherwise(0.9),
    )


def template_event(template: Column, variables: Column, raw: Column) -> Column:
    """From a template hit: what the line shows, its key=value and key: value pairs, and the typed variables.

    Confidence is counted in hundredths: 30, and more for each thing found, up to 75.
    """
    # A word, a colon and its value.
    colon = r"(?U)\b([A-Za-z_]\w*):\s+(\S+)"
    pairs = last_wins(F.transform(extract_all(raw, colon, 1), F.lower), extract_all(raw, colon, 2))
    kinds = ["date", "time", "ip_port_flow", "ip_port", "ip", "port_or_number"]
    seen = {"kv": parse_kv(raw), "pairs": pairs, "ips": ipv4s(raw), "profile": profile_line(raw)}

    def typed(kind: str) -> Column:
        return F.filter(variables, lambda v: v["guessed_type"] == kind)

    seen |= {k: typed(k) for k in kinds}
    return let_all(seen, lambda x: _from_seen(template, x))


def _from_seen(template: Column, x: dict[str, Column]) -> Column:
    profile, kv, pairs = x["profile"], x["kv"], x["pairs"]

    def of(kind: str, field: str = "value", place: int = 1) -> Column:
        return F.try_element_at(x[kind], F.lit(place))[field]

    def clean(text: Column) -> Column:
        return F.rtrim(text, F.lit(",;:.!?)"))

    def any_of(*keys: str) -> Column:
        return first_filled(*(get(kv, k) for k in keys))

    alternative = filled(F.concat_ws(" ", filled(of("date")), filled(of("time"))))
    stamp = F.coalesce(filled(profile["timestamp"]), alternative)
    user = any_of("user", "uid", "ruser", "username")
    kv_src, kv_dst = clean(any_of("rhost", "host", "ip", "src", "srcip")), clean(any_of("dst", "dstip"))
    has_flow = of("ip_port_flow").isNotNull()
    src0 = F.when(has_flow, of("ip_port_flow", "src_ip")).otherwise(of("ip_port", "ip"))
    src0_port = F.when(has_flow, of("ip_port_flow", "src_port")).otherwise(of("ip_port", "port"))
    dst0 = F.when(has_flow, of("ip_port_flow", "dst_ip")).otherwise(of("ip_port", "ip", 2))
    dst0_port = F.when(has_flow, of("ip_port_flow", "dst_port")).otherwise(of("ip_port", "port", 2))
    src1 = first_filled(kv_src, src0, of("ip"))
    dst1 = first_filled(kv_dst, dst0, of("ip", place=2), F.when(filled(kv_src).isNotNull(), of("ip")))
    received = to_int(F.coalesce(any_of("bytes_received", "rcvd", "received"), first_filled(get(pairs, "len"), get(pairs, "bytes"))))
    packets = to_int(F.coalesce(any_of("packets", "pkts"), filled(get(pairs, "packets"))))
    protocol = normalize_protocol(F.coalesce(any_of("proto", "protocol"), filled(get(pairs, "proto"))))

    found = {"src": src1, "dst": dst1, "src_port": src0_port, "dst_port": dst0_port, "stamp": stamp, "alternative": alternative, "user": user, "received": received, "packets": packets, "protocol": protocol}

    def points(n: int, value: Column) -> Column:
        return F.when(value.isNotNull(), n).otherwise(0)

    def addresses(y: dict[str, Column]) -> Column:
        src = F.coalesce(y["src"], F.try_element_at(x["ips"], F.lit(1)))
        dst = F.coalesce(y["dst"], F.when(y["src"].isNull(), F.try_element_at(x["ips"], F.lit(2))))
        return let_all({"src": src, "dst": dst}, lambda z: build(y, z["src"], F.when(z["src"].isNull() | (z["dst"] != z["src"]), z["dst"])))

    def build(y: dict[str, Column], src: Column, dst: Column) -> Column:
        src_port = F.when(src.isNotNull(), F.coalesce(to_int(y["src_port"]), to_int(of("port_or_number"))))
        dst_port = F.when(dst.isNotNull(), F.coalesce(to_int(y["dst_port"]), to_int(of("port_or_number", place=2))))
        total = (
            F.lit(30) + F.when(filled(profile["timestamp"]).isNotNull(), 10).when(y["alternative"].isNotNull(), 5).otherwise(0)
            + points(5, profile["severity"]) + points(5, profile["host"]) + points(5, profile["process"]) + points(5, y["user"]) + points(10, src) + points(5, y["received"])
        )
        return _event(
            timestamp=y["stamp"], vendor=F.lit("unknown"), source_format=F.lit("unknown"), event_type=F.when(src.isNotNull(), "traffic").otherwise("unclassified"),
            action=guess_action(template), severity=profile["severity"], src_ip=src, src_port=src_port, dst_ip=dst, dst_port=dst_port, protocol=y["protocol"],
            bytes_received=y["received"], packets=y["packets"], user=clean(y["user"]), host=profile["host"], process=profile["process"], pid=F.when(profile["process"].isNotNull(), profile["pid"]),
            message=template, confidence=F.least(total, F.lit(75)) / 100.0,
        )

    return let_all(found, addresses)


def finalize(event: Column, now: Column | None = None) -> Column:
    """The event with its timestamp in ISO 8601."""
    return let(event, lambda e: e.withField("timestamp", normalize_timestamp(e["timestamp"], now)))
