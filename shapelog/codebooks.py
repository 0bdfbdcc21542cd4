"""Vendor codebooks: what a coded message means and which fields its body holds."""

from __future__ import annotations

import json
import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The two codebooks that ship with the engine.
VENDOR_CODEBOOKS = [
    {"vendor": "cisco", "product": "asa", "prefix": "ASA", "messages": [
        {"code": "302013", "description": "Connection built", "action": "allow", "event_type": "connection",
         "regex": r"Built (?P<direction>\w+) (?P<protocol>\w+) connection (?P<conn_id>\d+) for \w+:(?P<src_ip>[\d.]+)/(?P<src_port>\d+) \([\d.]+/\d+\) to \w+:(?P<dst_ip>[\d.]+)/(?P<dst_port>\d+)"},
        {"code": "302014", "description": "Connection teardown", "action": "other", "event_type": "connection",
         "regex": r"Teardown (?P<protocol>\w+) connection (?P<conn_id>\d+) for \w+:(?P<src_ip>[\d.]+)/(?P<src_port>\d+) to \w+:(?P<dst_ip>[\d.]+)/(?P<dst_port>\d+) duration (?P<duration>[\d:]+) bytes (?P<bytes>\d+)"},
        {"code": "106023", "description": "Denied by access-group", "action": "deny", "event_type": "traffic",
         "regex": r'Deny (?P<protocol>\w+) src \w+:(?P<src_ip>[\d.]+)/(?P<src_port>\d+) dst \w+:(?P<dst_ip>[\d.]+)/(?P<dst_port>\d+) by access-group "(?P<acl>[^"]+)"'},
        {"code": "106021", "description": "Denied by reverse path check (anti-spoofing)", "action": "deny", "event_type": "traffic",
         "regex": r"Deny protocol reverse path check from (?P<src_ip>[\d.]+) to (?P<dst_ip>[\d.]+) on interface (?P<interface>\w+)"},
        {"code": "313001", "description": "Denied ICMP", "action": "deny", "event_type": "traffic",
         "regex": r"Denied ICMP type=(?P<icmp_type>\d+), code=(?P<icmp_code>\d+) from (?P<src_ip>[\d.]+) on interface (?P<interface>\w+)"},
        {"code": "113004", "description": "AAA authentication successful", "action": "allow", "event_type": "auth",
         "regex": r"AAA user authentication Successful : server = (?P<auth_server>[\d.]+) : user = (?P<user>\S+)"},
        {"code": "113005", "description": "AAA authentication rejected", "action": "deny", "event_type": "auth",
         "regex": r"AAA user authentication Rejected : reason = (?P<reason>.+?) : server = (?P<auth_server>[\d.]+) : user = (?P<user>\S+)"},
        {"code": "111008", "description": "Admin command executed", "action": "other", "event_type": "admin",
         "regex": r"User '(?P<user>[^']+)' executed the '(?P<command>[^']+)' command"},
    ]},
    {"vendor": "cisco_firepower", "product": "ftd", "prefix": "FTD", "messages": [
        {"code": "430001", "description": "Connection allowed by access control policy", "action": "allow", "event_type": "traffic",
         "regex": r"AC_RuleAction: Allow, .*SrcIP: (?P<src_ip>[\d.]+), DstIP: (?P<dst_ip>[\d.]+), SrcPort: (?P<src_port>\d+), DstPort: (?P<dst_port>\d+), Protocol: (?P<protocol>\w+)"},
        {"code": "430002", "description": "Connection blocked by access control policy", "action": "deny", "event_type": "traffic",
         "regex": r"AC_RuleAction: Block, .*SrcIP: (?P<src_ip>[\d.]+), DstIP: (?P<dst_ip>[\d.]+), SrcPort: (?P<src_port>\d+), DstPort: (?P<dst_port>\d+), Protocol: (?P<protocol>\w+)"},
        {"code": "430003", "description": "Connection blocked by intrusion policy", "action": "deny", "event_type": "traffic",
         "regex": r"Intrusion Event.*SrcIP: (?P<src_ip>[\d.]+), DstIP: (?P<dst_ip>[\d.]+), SrcPort: (?P<src_port>\d+), DstPort: (?P<dst_port>\d+)"},
        {"code": "111008", "description": "Admin command executed", "action": "other", "event_type": "admin",
         "regex": r"User '(?P<user>[^']+)' executed the '(?P<command>[^']+)' command"},
        {"code": "113004", "description": "AAA authentication successful", "action": "allow", "event_type": "auth",
         "regex": r"AAA user authentication Successful : server = (?P<auth_server>[\d.]+) : user = (?P<user>\S+)"},
    ]},
]

ENTRY = T.StructType([T.StructField(x, T.StringType()) for x in ("prefix", "vendor", "product", "code", "description", "action", "event_type", "regex")] + [T.StructField("groups", T.ArrayType(T.StringType()))])


def java_pattern(pattern: str) -> tuple[str, list[str | None]]:
    """A pattern with plain groups, as Java allows no underscore in a group's name, and the names in order."""
    names: list[str | None] = []

    def plain(m: re.Match) -> str:
        if m[0].startswith("\\") or m[0].startswith("["):
            return m[0]
        names.append(m[1])
        return "("

    return re.sub(r"\\.|\[(?:\\.|[^\]\\])*\]|\(\?P<(\w+)>|\((?!\?)", plain, pattern), names


def load_codebooks(folder: str | None = None) -> list[dict]:
    """The shipped codebooks, and those in the JSON files of a folder; a later one of a prefix wins."""
    books = {b["prefix"]: b for b in VENDOR_CODEBOOKS}
    for path in sorted(Path(folder).glob("*.json")) if folder else []:
        book = json.loads(path.read_text(encoding="utf-8"))
        books[book.get("prefix", book["vendor"].upper())] = book
    return list(books.values())


def entries(books: list[dict]) -> list[dict]:
    """One entry per prefix and code; a repeated code's last entry wins."""
    found = {}
    for book in books:
        for m in book["messages"]:
            pattern, names = java_pattern(m["regex"])
            prefix = book.get("prefix", book["vendor"].upper())
            found[prefix, m["code"]] = {"prefix": prefix, "vendor": book["vendor"], "product": book.get("product")} | {k: m[k] for k in ("code", "description", "action", "event_type")} | {"regex": pattern, "groups": names}
    return list(found.values())


def codebook_table(spark: SparkSession, books: list[dict] | None = None) -> DataFrame:
    """The codebooks as a small table, to be joined by (prefix, code)."""
    return spark.createDataFrame([tuple(e[f.name] for f in ENTRY) for e in entries(books or load_codebooks())], ENTRY)
