"""Types of a template's variables, by the shape of the token."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shapelog.functions.text import let

# An address, one with a port, and a flow between two.
IP = r"\d{1,3}(?:\.\d{1,3}){3}"
IP_PORT = rf"^({IP}):(\d{{1,5}})$"
FLOW = rf"^({IP}):(\d{{1,5}})(?:->|>| to )({IP}):(\d{{1,5}})$"
# Token shapes in the order they are tried.
TAGS = [
    ("ip_port_flow", FLOW),
    ("ip_port", IP_PORT),
    ("ip", rf"^{IP}$"),
    ("mac", r"^[0-9a-fA-F]{2}(:[0-9a-fA-F]{2}){5}$"),
    ("uuid", r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"),
    ("email", r"(?U)^[\w.\-]+@[\w.\-]+\.\w+$"),
    ("url", r"(?U)^[a-zA-Z][a-zA-Z0-9+.\-]*://\S+$"),
    ("path", r"(?U)^(/[\w.\-]+)+/?$|^[A-Za-z]:\\[\w.\\\-]+$"),
    ("hex", r"^0x[0-9a-fA-F]+$"),
    ("date", r"^\d{4}[-.]\d{2}[-.]\d{2}"),
    ("time", r"^\d{2}:\d{2}:\d{2}([.,]\d+)?$"),
    ("ipv6", r"^(?=[^:]*:[^:]*:)[0-9a-fA-F:]{2,}:[0-9a-fA-F:]*$"),
]


def guess_tag(token: Column) -> Column:
    return let(token, _guess)


def _guess(token: Column) -> Column:
    out = F.when(F.coalesce(token, F.lit("")) == "", "unknown")
    for name, pattern in TAGS:
        out = out.when(token.rlike(pattern), name)
    number = F.when(token.rlike(r"^\d{1,5}$"), token).try_cast("int")
    return out.when((number > 0) & (number <= 65535), "port_or_number").when(token.rlike(r"(?U)^\d+$"), "large_number").otherwise("unknown")


def tag_variable(token: Column) -> Column:
    """The token, its type, and the parts of address and port tokens."""

    def parts(kind: Column) -> Column:
        def part(of: str, pattern: str, group: int) -> Column:
            return F.when(kind == of, F.regexp_extract(token, pattern, group))

        names = ["ip", "port"], ["src_ip", "src_port", "dst_ip", "dst_port"]
        fields = [part("ip_port", IP_PORT, i + 1).alias(n) for i, n in enumerate(names[0])] + [part("ip_port_flow", FLOW, i + 1).alias(n) for i, n in enumerate(names[1])]
        return F.struct(token.alias("value"), kind.alias("guessed_type"), *fields)

    return let(guess_tag(token), parts)
