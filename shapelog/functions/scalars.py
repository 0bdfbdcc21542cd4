"""Scalar normalization: numbers, actions, protocols, addresses, identity of an event."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from shapelog.functions.text import extract_all, let, strip
from shapelog.schema import ACTIONS, PROTOCOLS

# A valid IPv4 address.
IPV4 = r"\b(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\b"


def to_int(text: Column) -> Column:
    """A whole number with optional sign and surrounding space, else null."""
    return F.when(text.rlike(r"^\s*[+-]?\d+\s*$"), strip(text).try_cast("bigint"))


def normalize_action(text: Column) -> Column:
    """allow, deny, auth or other, by exact keyword."""
    known = F.create_map(*(F.lit(x) for pair in ACTIONS for x in pair))
    return F.coalesce(F.try_element_at(known, F.lower(strip(text))), F.lit("other"))


def guess_action(text: Column) -> Column:
    """By the first keyword, in the order of precedence, that is a whole word of the text."""

    def first(low: Column) -> Column:
        out = F
        for word, action in ACTIONS:
            out = out.when(low.rlike(rf"(?U)\b{re.escape(word)}\b"), action)
        return out.otherwise("other")

    return let(F.lower(text), first)


def normalize_protocol(text: Column) -> Column:
    known = F.create_map(*(F.lit(x) for pair in PROTOCOLS for x in pair))
    return let(F.lower(strip(text)), lambda value: F.coalesce(F.try_element_at(known, value), value))


def confidence_bucket(confidence: Column) -> Column:
    return F.when(confidence >= 0.8, "high").when(confidence >= 0.4, "medium").otherwise("low")


def ipv4s(text: Column) -> Column:
    """Valid IPv4 addresses in the order they first appear."""
    return F.array_distinct(extract_all(text, IPV4))


def event_id(path: Column, number: Column, raw: Column) -> Column:
    """The first 24 hex digits of SHA-256 of path:line:text."""
    return F.substring(F.sha2(F.concat_ws(":", path, number.cast("string"), raw), 256), 1, 24)


def lineage(path: Column, name: Column, number: Column, raw: Column) -> Column:
    now = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    return F.struct(event_id(path, number, raw).alias("event_id"), path.alias("source_path"), name.alias("source_name"), number.cast("bigint").alias("line_number"), now.alias("ingested_at"))
