"""The shape of one line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shapelog.functions.text import extract_all, let, strip, tokens

# What tells each shape.
CODED = r"%[A-Za-z0-9_]+-\d-\d+:"
LEEF = r"LEEF:[\d.]+\|"
RFC5424 = r"(?U)^<\d+>1\s+\S+\s+\S+\s+\S+\s+\S+\s+\S+\s+(\[|-)"
PAIR = r'(?U)\b\w+=("[^"]*"|\S+)'


def json_fields(line: Column) -> Column:
    """A JSON object's members as text; null unless the line is one whole object."""
    whole = F.json_array_length(F.concat(F.lit("["), line, F.lit("]"))) == 1
    fields = F.from_json(line, T.MapType(T.StringType(), T.StringType()), {"allowSingleQuotes": "false"})
    return F.when(strip(line).startswith("{") & whole, fields)


def commas(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(",")))


def sniff_line(line: Column) -> Column:
    """empty, json, leef, cef, syslog5424, coded_syslog, csv_like, kv_syslog or unknown; the first that fits."""
    return let(strip(line), _sniff)


def _sniff(text: Column) -> Column:
    pairs = F.size(extract_all(text, PAIR))
    return (
        F.when(text == "", "empty")
        .when(json_fields(text).isNotNull(), "json")
        .when(text.rlike(LEEF), "leef")
        .when(text.contains("CEF:"), "cef")
        .when(text.rlike(RFC5424), "syslog5424")
        .when(text.rlike(CODED), "coded_syslog")
        .when((commas(text) >= 2) & ~text.contains("=") & ~text.contains("%"), "csv_like")
        .when((pairs >= 3) & (pairs >= 0.6 * F.greatest(F.size(tokens(text)), F.lit(1))), "kv_syslog")
        .otherwise("unknown")
    )


def csv_header(line: Column) -> Column:
    """Whether a file's first line can be the header of a table."""
    other = line.startswith("<") | line.startswith("{") | line.contains("=") | line.rlike(LEEF) | line.contains("CEF:") | line.rlike(CODED)
    return (commas(line) >= 2) & ~other
