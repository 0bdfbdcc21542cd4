"""Parsers: a line as a map of its fields, null where the line isn't of the shape."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from shapelog.codebooks import entries, load_codebooks
from shapelog.functions.sniff import json_fields
from shapelog.functions.text import at, extract_all, get, groups, last_wins, let, let_all, strip

#: A key of key=value pairs whose values run to the next key.
KEY = r"(?U)(\w++)="


def present(columns: Column) -> Column:
    return F.size(columns) > 0


def parse_json(line: Column) -> Column:
    return json_fields(line)


def parse_kv(line: Column) -> Column:
    """key=value and key="value" pairs."""
    # A pair, its value bare or in quotes.
    pattern = r'(?U)(\w++)=("[^"]*"|\S+)'

    def read(x: dict[str, Column]) -> Column:
        # A line has no newline, so all values lose their quotes by one pass.
        bare = F.split(F.regexp_replace(F.array_join(x["v"], "\n"), r'(?md)^"(?:(.*)")?$', "$1"), "\n", -1)
        return F.when(present(x["k"]), last_wins(x["k"], bare))

    return let_all({"k": extract_all(line, pattern, 1), "v": extract_all(line, pattern, 2)}, read)


def _headed(line: Column, mark: str, header: str, names: list[str], rest: Callable[[Column], Column]) -> Column:
    """The header's fields and those that `rest` makes a map of, given all keys and values; null without a header."""

    def read(x: dict[str, Column]) -> Column:
        return let(groups(x["body"], rf"(?s)^.*?{mark}{header}", len(names) + 1), lambda own: F.when(F.size(own) == len(names) + 1, rest(own, strip(x["before"]))))

    def cut(place: Column) -> Column:
        return let_all({"body": F.when(place > 0, F.substr(line, place)), "before": F.substr(line, F.lit(1), place - 1)}, read)

    return let(F.instr(line, F.lit(mark)), cut)


def _with_header(names: list[str], own: Column, before: Column, keys: Column, values: Column) -> Column:
    """Header, then the pairs, then the text before; later ones win. A line with no pairs has the header alone."""
    every = F.concat(F.array(*map(F.lit, names)), keys, F.array(F.lit("syslog_prefix")))
    return last_wins(every, F.concat(F.slice(own, 1, len(names)), values, F.array(before)))


def parse_cef(line: Column) -> Column:
    """The seven header fields, the extension's pairs, and the text before as syslog_prefix; later ones win."""
    # The header's fields and its grammar.
    names = ["cef_version", "vendor", "product", "product_version", "signature_id", "name", "severity"]

    def rest(own: Column, before: Column) -> Column:
        def pairs(x: dict[str, Column]) -> Column:
            values = F.slice(x["v"], F.lit(2), F.size(x["v"]))
            return _with_header(names, own, before, x["k"], values)

        extension = at(own, len(names))
        return let(strip(extension), lambda text: let_all({"k": extract_all(text, KEY, 1), "v": F.split(text, r"(?U)\s*\w++=\s*", -1)}, pairs))

    return _headed(line, "CEF:", r"(\d+)\|" + r"([^|]*)\|" * 6 + "(.*)$", names, rest)


def parse_leef(line: Column) -> Column:
    """Like CEF; version 2 names the delimiter (a literal of up to four characters, or x and two hex digits)."""
    # The header's fields and its grammar, and how a delimiter is named.
    names = ["leef_version", "vendor", "product", "product_version", "event_id"]
    spec = r"(?s)^([^|]{0,4})\|(.*)$"

    def rest(own: Column, before: Column) -> Column:
        extension = at(own, len(names))

        def cut(parts: Column) -> Column:
            named = F.size(parts) == 2
            token = F.when(named, at(parts, 0)).otherwise("")
            return let_all({"token": token, "text": F.when(named, at(parts, 1)).otherwise(extension)}, delimited)

        def delimited(x: dict[str, Column]) -> Column:
            code = F.conv(F.regexp_extract(x["token"], "^[xX]([0-9A-Fa-f]{2})$", 1), 16, 10).try_cast("int")
            delimiter = F.when(x["token"] == "", "\t").when(x["token"].rlike("^[xX][0-9A-Fa-f]{2}$"), F.char(code)).otherwise(x["token"])
            quoted = F.concat(F.lit(r"(?:\Q"), F.replace(delimiter, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E)"))
            return let(quoted, lambda one: let_all({"k": extract_all(x["text"], KEY, 1), "v": F.split(F.regexp_replace(x["text"], F.concat(one, F.lit(r"\z")), F.lit("")), F.concat(F.lit("(?U)"), one, F.lit(r"?\w++=")), -1)}, pairs))

        def pairs(x: dict[str, Column]) -> Column:
            # One delimiter goes at the end of each value, then white space; a line has no newline.
            values = F.array_join(F.slice(x["v"], F.lit(2), F.size(x["v"])), "\n")
            trimmed = F.split(F.regexp_replace(values, r"(?Umd)^[^\S\n]+|[^\S\n]+$", ""), "\n", -1)
            return _with_header(names, own, before, x["k"], F.when(present(x["k"]), trimmed).otherwise(F.array().cast("array<string>")))

        version = at(own, 0)
        return let(F.when(version.startswith("2"), groups(extension, spec, 2)).otherwise(F.array(extension)), cut)

    return _headed(line, "LEEF:", r"([\d.]+)\|" + r"([^|]*)\|" * 4 + "(.*)$", names, rest)


def parse_rfc5424(line: Column) -> Column:
    """Header, parameters of all structured elements, and the free text as message."""
    # The header's fields.
    names = ["pri", "version", "timestamp", "hostname", "appname", "procid", "msgid"]
    # Elements follow each other after one space; one bracket may stand within an element.
    elements = r"^(\[(?:[^\[\]]|\[[^\[\]]*\])*\](?: \[(?:[^\[\]]|\[[^\[\]]*\])*\])*)"
    element, pair = r'(?U)\[([^\s\]]+)((?:\s+\S+?="[^"]*")*)\s*\]', r'(?U)(\S+?)="([^"]*)"'

    def read(words: Column) -> Column:
        first = groups(at(words, 0), r"(?U)^<(\d+)>(\d+)$", 2)
        return let(first, lambda start: F.when((F.size(words) == 7) & (F.size(start) == 2), let(at(words, 6), lambda rest: split(start, words, rest))))

    def split(start: Column, words: Column, rest: Column) -> Column:
        def data(found: Column) -> Column:
            return F.when(~rest.startswith("["), "").when(found != "", found).otherwise(rest)

        return let(let(F.regexp_extract(rest, elements, 1), data), lambda x: parts(start, words, rest, x))

    def parts(start: Column, words: Column, rest: Column, data: Column) -> Column:
        message = F.when(rest.startswith("-"), strip(F.substr(rest, F.lit(2)))).otherwise(strip(F.substr(rest, F.length(data) + 1)))
        inner = F.array_join(extract_all(data, element, 2), " ")

        def join(x: dict[str, Column]) -> Column:
            keys = F.concat(F.array(*map(F.lit, names)), x["k"], F.array(F.lit("message"), F.lit("has_structured_data")))
            return last_wins(keys, F.concat(start, F.slice(words, 2, 5), x["v"], F.array(message, (data != "").cast("string"))))

        return let(inner, lambda text: let_all({"k": extract_all(text, pair, 1), "v": extract_all(text, pair, 2)}, join))

    return let(F.split(strip(line), r"(?U)\s+", 7), read)


def parse_coded(line: Column, books: list[dict] | None = None) -> Column:
    """Header, the codebook's meaning of the code, and the fields of the body.

    The codebooks become literals of one expression: each pattern is compiled once, and no row
    goes through a join. `operators.coded.join_codebook` is the same by a join, for codebooks too
    large for an expression.
    """
    # The header's grammar and fields.
    header = r"(?Us)^<(\d+)>(\w+\s+\d+\s+\d+\s+\d+:\d+:\d+)\s+(\S+)\s*:?\s*%([A-Za-z0-9_]+)-(\d)-(\d+):\s*(.*)$"
    names = ["pri", "timestamp", "hostname", "severity", "code", "message"]
    books = books or load_codebooks()
    vendors = F.create_map(*(F.lit(x) for b in books for x in (b.get("prefix", b["vendor"].upper()), b["vendor"])))

    def meaning(prefix: Column, code: Column, body: Column) -> Column:
        known = F
        for e in entries(books):
            fields = [(i, n) for i, n in enumerate(e["groups"]) if n]
            fixed = {"vendor": e["vendor"], "matched_code": "true", "action": e["action"], "event_type": e["event_type"], "description": e["description"]}
            drifted = F.create_map(*(F.lit(v) for item in (fixed | {"body_matched": "false"}).items() for v in item))
            keys = F.array(*map(F.lit, [*fixed, *(n for _, n in fields), "body_matched"]))

            def here(found: Column, fields: list = fields, fixed: dict = fixed, keys: Column = keys, size: int = len(e["groups"]), drifted: Column = drifted) -> Column:
                values = F.array(*map(F.lit, fixed.values()), *(at(found, i) for i, _ in fields), F.lit("true"))
                return F.when(F.size(found) == size + 1, F.map_from_arrays(keys, values)).otherwise(drifted)

            # The line's end as one more group, so that a pattern without groups counts too.
            found = groups(body, rf"(?s)^.*?(?:{e['regex']})(.*)$", len(e["groups"]) + 1)
            mine = (prefix == e["prefix"]) & (code == e["code"])
            known = known.when(mine, let(F.when(mine, found), here))
        vendor = F.coalesce(F.try_element_at(vendors, prefix), F.lower(prefix))
        return known.otherwise(F.create_map(F.lit("vendor"), vendor, F.lit("matched_code"), F.lit("false"), F.lit("action"), F.lit("other"), F.lit("event_type"), F.lit("unknown_code")))

    def read(own: Column) -> Column:
        def join(m: Column) -> Column:
            values = F.array(at(own, 0), at(own, 1), at(own, 2), at(own, 4), at(own, 5), at(own, 6))
            return last_wins(F.concat(F.array(*map(F.lit, names)), F.map_keys(m)), F.concat(values, F.map_values(m)))

        return F.when(F.size(own) == 7, let(F.when(F.size(own) == 7, meaning(at(own, 3), at(own, 5), at(own, 6))), join))

    return let(groups(strip(line), header, 7), read)


def parse_csv(header: Column, line: Column) -> Column:
    """A row's cells by its file's header, both split at commas outside quotes; a short row's missing cells are null."""
    cells = r'(?:^|,)(?:"((?:[^"]|"")*)"|([^,"]*))'

    def split(text: Column) -> Column:
        quoted, plain = extract_all(text, cells, 1), extract_all(text, cells, 2)
        careful = F.zip_with(quoted, plain, lambda q, p: F.when(q != "", F.replace(q, F.lit('""'), F.lit('"'))).otherwise(p))
        return F.when(text.contains('"'), careful).otherwise(F.split(text, ",", -1))

    def row(x: dict[str, Column]) -> Column:
        size = F.size(x["names"])
        return last_wins(x["names"], F.slice(F.concat(x["values"], F.array_repeat(F.lit(None).cast("string"), size)), F.lit(1), size))

    return F.when(header.isNotNull(), let_all({"names": split(header), "values": split(line)}, row))


__all__ = ["get", "parse_cef", "parse_coded", "parse_csv", "parse_json", "parse_kv", "parse_leef", "parse_rfc5424"]
