"""What a line of any source shows near its front: time, severity, host, process."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shapelog.functions.text import extract, filled, let

# Timestamp shapes that are searched for in the first 80 characters; the leftmost match counts.
STAMPS = [
    r"\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}[.,]\d+",
    r"\d{4}-\d{2}-\d{2}-\d{2}\.\d{2}\.\d{2}\.\d+",
    r"\d{4}\.\d{2}\.\d{2}",
    r"\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}",
    r"\d{8}-\d{1,2}:\d{1,2}:\d{1,2}:\d+",
    r"^\d{6} \d{6}",
    r"\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2}",
    r"\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d+",
    r"\[\d{2}\.\d{2} \d{2}:\d{2}:\d{2}\]",
    r"[A-Z][a-z]{2}\s+\d{1,2} \d{2}:\d{2}:\d{2}",
]
STAMP = "|".join(STAMPS)
# A word's edges, told by Unicode; \b is ASCII in some JDKs and RE2, not in others.
NO_WORD_BEFORE, NO_WORD_AFTER = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
# What a bare epoch, a level word, a level letter and a process tag look like.
EPOCH = r"(?<!\d)(10\d{8}|1[1-9]\d{8}|20\d{8})(?!\d)"
LEVEL = rf"(?i){NO_WORD_BEFORE}(TRACE|DEBUG|INFO|NOTICE|WARN(?:ING)?|ERR(?:OR)?|CRIT(?:ICAL)?|ALERT|EMERG(?:ENCY)?|FATAL){NO_WORD_AFTER}"
LETTER_LEVEL = NO_WORD_BEFORE + r"\d+\s+\d+\s+([VDIWEF])\s+[\w.$]+:"
TAG = r"(?U)\b([\w.\-]+)(?:\([\w.\-]+\))?\[(\d+)\]:"
# Severities by level word or letter.
SEVERITIES = [
    ("trace", "debug"), ("debug", "debug"), ("d", "debug"), ("v", "debug"), ("verbose", "debug"),
    ("info", "info"), ("notice", "info"), ("i", "info"),
    ("warn", "warning"), ("warning", "warning"), ("w", "warning"),
    ("err", "error"), ("error", "error"), ("e", "error"),
    ("crit", "critical"), ("critical", "critical"), ("alert", "critical"), ("emerg", "critical"), ("emergency", "critical"), ("fatal", "critical"), ("f", "critical"),
]


def stamp(line: Column) -> Column:
    return extract(F.substring(line, 1, 80), STAMP)


def extract_timestamp(line: Column) -> Column:
    """As it stands in the line; a bare epoch only where no other shape is found."""
    return F.coalesce(stamp(line), extract(line, EPOCH, 1))


def extract_severity(line: Column) -> Column:
    known = F.create_map(*(F.lit(x) for pair in SEVERITIES for x in pair))
    return F.try_element_at(known, F.lower(F.coalesce(extract(line, LETTER_LEVEL, 1), extract(line, LEVEL, 1))))


def extract_process(line: Column) -> tuple[Column, Column]:
    """Name and pid of a tag such as name[12]: or name(part)[12]:"""
    return extract(line, TAG, 1), extract(line, TAG, 2)


def extract_host(line: Column) -> Column:
    """The word after a timestamp that starts with a month's name, as in RFC 3164."""

    def after(found: Column) -> Column:
        rest = F.substr(line, F.instr(line, found) + F.length(found))
        return F.when(found.rlike(r"^[A-Z][a-z]{2}\s"), filled(F.regexp_extract(rest, r"(?U)^\s*([\w.\-]+)\s", 1)))

    return let(stamp(line), after)


def profile_line(line: Column) -> Column:
    process, pid = extract_process(line)
    return F.struct(extract_timestamp(line).alias("timestamp"), extract_severity(line).alias("severity"), extract_host(line).alias("host"), process.alias("process"), pid.alias("pid"))
