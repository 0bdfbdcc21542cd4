"""WARC archives of pages, and one ordered capture index over all of them.

`write_archives` writes a record per page (a revisit where an equal payload is stored already),
`read_archives` reads records back as a stream, checks them and tells where each stands, and `merge_index` turns the index of each
archive, a run sorted by URL key and time, into one: ranges of the keys are dealt out by sampled
splitters, so that one key's captures may span ranges, and each range merges its slices of the runs
with a loser tree. The index holds each capture's archive and place in it, by which `fetch` finds it.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import groupby, islice
from operator import itemgetter
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shapelog.llm.common import HEAVY_SHARE, materialize, table, work_dir

#: Records of one archive file. Archives are read as a stream, so their size bounds no memory.
RECORDS_PER_FILE = 20_000
#: Index entries of one range of the merge, on average, at most.
RANGE_ROWS = 200_000
#: Entries whose keys are held of each run, and entries of an output batch.
AHEAD = 1024
#: Payload bytes after which a batch of records goes on.
BATCH_BYTES = 8 << 20
#: Payloads under so many bytes are stored again rather than referred to.
MIN_REVISIT_BYTES = 0
#: The time of the capture of page 0, where the pages have no column `captured`: a second a page.
FIRST_CAPTURE = "2020-01-01T00:00:00Z"
#: Fixed values of base32 (RFC 4648) and of the digits that conv() gives in base 32.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"

CRLF = "\r\n"
RECORD = "page_id {id}, url string, captured string, record_type string, refers_to {id}, payload_digest string, payload_bytes long, payload string, archive string, offset long, length long, url_key string"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: five hex digits are four of base 32."""
    digest = F.sha1(payload.cast("binary"))
    parts = [F.lpad(F.conv(F.substring(digest, 1 + i, 5), 16, 32), 4, "0") for i in range(0, 40, 5)]
    return F.translate(F.concat(*parts), DIGITS, BASE32)


def with_records(pages: DataFrame, folder: str, min_bytes: int) -> DataFrame:
    """The pages with digest, size, and the page_id that an equal payload is stored under (`stored`)."""
    payload = F.coalesce("html", F.lit(""))
    captured = F.col("captured") if "captured" in pages.columns else F.date_format(
        F.to_utc_timestamp(F.timestamp_seconds(F.lit(1577836800) + F.coalesce(F.col("page_id").cast("long"), F.lit(0))), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'"
    )
    rows = pages.select("page_id", "url", captured.alias("captured"), payload.alias("payload"), base32_sha1(payload).alias("digest"), F.octet_length(payload).cast("long").alias("size"))
    groups = materialize(rows.groupBy("digest").agg(F.min("page_id").alias("stored"), F.count("*").alias("copies")), f"{folder}/payloads")
    total = groups.agg(F.sum("copies")).first()[0] or 0
    # Digests of over 1/HEAVY_SHARE of the pages each are at most HEAVY_SHARE; the rest meets its group by shuffle.
    heavy = groups.filter(F.col("copies") * HEAVY_SHARE > total).drop("copies")
    light = groups.filter(F.col("copies") * HEAVY_SHARE <= total).drop("copies")
    joined = rows.join(F.broadcast(heavy), "digest").unionByName(rows.join(F.broadcast(heavy.select("digest")), "digest", "left_anti").join(light.hint("shuffle_hash"), "digest"))
    is_stored = F.col("page_id").eqNullSafe(F.col("stored")) | (F.col("size") < min_bytes)
    return joined.withColumn("record_type", F.when(is_stored, "response").otherwise("revisit"))


def _uuid(of: Column) -> Column:
    return F.regexp_replace(F.md5(of.cast("binary")), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>")


def write_archives(pages: DataFrame, path: str, folder: str, min_bytes: int = MIN_REVISIT_BYTES, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write gzipped WARC 1.1 files under `path`, a record per page.

    pages: page_id, url, html and, if the captures have times, captured (ISO 8601 text). A null html
    is an empty payload, a null url is written as urn:null, and control characters or spaces in one
    are percent-encoded, as they would end the header. Of equal payloads of at least min_bytes, the
    smallest page_id is stored (all rows of it, if repeated) and the others refer to it; a null
    page_id is stored only if its whole group has none. Other columns are ignored. No page gives
    archives without records.
    """
    rows = with_records(pages, folder, min_bytes)
    url = F.coalesce("url", F.lit("urn:null"))
    for char, code in ((" ", "%20"), ("\r", "%0D"), ("\n", "%0A"), ("\t", "%09")):
        url = F.replace(url, F.lit(char), F.lit(code))
    header = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("size").cast("string"), F.lit(CRLF + CRLF))
    revisit = F.col("record_type") == "revisit"
    block = F.when(revisit, header).otherwise(F.concat(header, F.col("payload")))

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    own, stored = (F.col(x).cast("string") for x in ("page_id", "stored"))
    record = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Target-URI", url),
        line("WARC-Date", F.col("captured")),
        line("WARC-Record-ID", _uuid(F.concat(F.lit("page "), F.coalesce(own, F.lit("-"))))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(own.isNotNull(), line("X-Page-Id", own)).otherwise(""),
        F.when(revisit, line("WARC-Refers-To", _uuid(F.concat(F.lit("page "), stored)))).otherwise(""),
        F.when(revisit, line("X-Refers-To-Page-Id", stored)).otherwise(""),
        F.when(revisit, F.lit(f"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{CRLF}")).otherwise(""),
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}"),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(CRLF),
        block,
        F.lit(CRLF),
    )
    rows.select(record.alias("value")).write.option("compression", "gzip").option("lineSep", CRLF).option("maxRecordsPerFile", records_per_file).text(path)


def parse_records(lines: Iterator[bytes]) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """Of each record of an archive, given by its lines: offset, length, headers (names in lower case) and block.

    Lines are what newlines end, without them. Only one record is held at a time.
    """
    at = 0
    for line in lines:
        if not line.strip():
            at += len(line) + 1
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:60]!r}")
        start, headers = at, {}
        at += len(line) + 1
        for line in lines:
            at += len(line) + 1
            if not line.strip():
                break
            name, _, value = line.partition(b":")
            headers[name.decode().lower()] = value.strip().decode()
        size = int(headers["content-length"])
        parts, have = [], 0
        while have < size:
            if (line := next(lines, None)) is None:
                raise ValueError("an archive ends within a record")
            parts.append(line)
            have += len(line) + 1
        parts.append(b"")
        yield start, at + size - start, headers, b"\n".join(parts)[:size]
        at += have


def read_archives(spark: SparkSession, path: str | list[str], id_type: str = "bigint") -> DataFrame:
    """The records of all archives under `path`, their stored payloads checked against their digests.

    A revisit has the digest and the size of the payload that it refers to, and no payload itself.
    `offset` and `length` are a record's place in the unpacked archive. An archive is one task's, as
    gzip can't be split, and goes through it line by line.
    """
    names = [x.split()[0] for x in RECORD.format(id="string").split(", ")]

    def record_batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = {"payload_bytes": pa.int64(), "offset": pa.int64(), "length": pa.int64()}
        return pa.RecordBatch.from_arrays([pa.array(x, kinds.get(name, pa.string())) for name, x in zip(names, zip(*rows, strict=True), strict=True)], names=names)

    def record(archive: str, offset: int, length: int, headers: dict[str, str], block: bytes) -> tuple:
        head, _, payload = block.partition(b"\r\n\r\n")
        digest, revisit = headers["warc-payload-digest"].removeprefix("sha1:"), headers["warc-type"] == "revisit"
        size = int(next(x.split(b":")[1] for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")))
        if not revisit and (size != len(payload) or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
            raise ValueError(f"the payload of page {headers.get('x-page-id')} isn't what its header says")
        return headers.get("x-page-id"), headers["warc-target-uri"], headers["warc-date"], headers["warc-type"], headers.get("x-refers-to-page-id"), digest, size, None if revisit else payload.decode(), archive, offset, length, url_key(headers["warc-target-uri"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = ((path, line) for batch in batches for path, line in zip(batch["archive"].to_pylist(), batch["line"].to_pylist(), strict=True))
        rows, held = [], 0
        for archive, own in groupby(every, key=itemgetter(0)):
            for found in parse_records(line for _, line in own):
                rows.append(record(archive, *found))
                held += len(found[-1])
                if held > BATCH_BYTES:
                    yield record_batch(rows)
                    rows, held = [], 0
        if rows:
            yield record_batch(rows)

    lines = spark.read.option("lineSep", "\n").option("pathGlobFilter", "*.gz").text(path)
    lines = lines.select(F.col("_metadata.file_path").alias("archive"), F.col("value").cast("binary").alias("line"))
    found = lines.mapInArrow(run, RECORD.format(id="string"))
    return found.withColumns({x: F.col(x).cast(id_type) for x in ("page_id", "refers_to")})


def fetch(spark: SparkSession, index: DataFrame, id_type: str = "bigint") -> DataFrame:
    """The records that the entries of an index stand for (a few: their archives' names come to the driver)."""
    names = [r.archive for r in index.select("archive").distinct().collect()]
    if not names:
        return spark.createDataFrame([], RECORD.format(id=id_type))
    return read_archives(spark, names, id_type).join(index.select("archive", "offset").distinct(), ["archive", "offset"], "left_semi")


def url_key(url: str) -> str:
    """A sortable key: the host's labels from the last to the first, then path and query, in lower case."""
    try:
        parts = urlsplit(url.strip().lower())
        host = parts.hostname or ""
    except ValueError:
        return url.strip().lower()
    if not host:
        return url.strip().lower()
    labels = [x for x in host.split(".") if x]
    if labels and labels[0] == "www":
        labels = labels[1:]
    return ",".join(reversed(labels)) + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


def index_runs(records: DataFrame) -> DataFrame:
    """An index entry per record, in runs: one per input partition, sorted by URL key, time and page.

    `run` names the run and `place` the position in it. A null url counts as an empty one, equal captures
    stay as they are, and no records give no runs.
    """
    kept = records.select("page_id", "url", "captured", "record_type", "refers_to", "payload_digest", "payload_bytes", "archive", "offset", "length", "url_key", F.spark_partition_id().alias("run"))
    return kept.sortWithinPartitions("url_key", "captured", "page_id").withColumn("place", F.monotonically_increasing_id())


class LoserTree:
    """Merges k sorted sequences: inner nodes hold the losers, so the next winner takes log2(k) comparisons."""

    def __init__(self, sources: list[Iterator]):
        self.sources = sources
        self.heads = [next(s, None) for s in sources]
        self.k = k = len(sources)
        self.losers = [-1] * k  # of each inner node; at 0 the winner
        for i in range(k):
            self.replay(i)

    def before(self, a: int, b: int) -> bool:
        """Whether a's head comes first; a source that hasn't played yet (-1) does, an ended one doesn't."""
        if a < 0 or b < 0:
            return a < 0
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x, a) < (y, b)

    def replay(self, i: int) -> None:
        node = (i + self.k) // 2
        while node:
            if self.before(self.losers[node], i):
                self.losers[node], i = i, self.losers[node]
            node //= 2
        self.losers[0] = i

    def __iter__(self) -> Iterator:
        while self.k and (head := self.heads[winner := self.losers[0]]) is not None:
            yield head
            self.heads[winner] = next(self.sources[winner], None)
            self.replay(winner)


def merge_index(runs: DataFrame) -> DataFrame:
    """One capture index, in the order of URL key, time and page_id, from sorted runs.

    Ranges are bounded by samples of the whole key, so captures of one URL may fill several. Within
    a range the slices of the runs, each in its own order, are merged; their keys are read some ahead.
    `runs` should be a written table, as it is counted first. Nulls come first, equal captures follow
    each other. No runs give an empty index.
    """
    names = [x for x in runs.columns if x not in ("run", "place")]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)  # a range, so bounded; as Arrow columns
        if not held:
            return
        rows = pa.Table.from_batches(held)
        run = rows["run"].to_numpy()
        order = np.lexsort((rows["place"].to_numpy(), run))  # blocks of a shuffle arrive in any order
        keys = rows.select(["url_key", "captured", "page_id"])

        def source(own: np.ndarray) -> Iterator:
            for i in range(0, len(own), AHEAD):
                part = own[i : i + AHEAD].tolist()
                columns = [[(v is not None, v) if v is not None else (False,) for v in c.to_pylist()] for c in keys.take(part).columns]
                yield from zip(zip(*columns, strict=True), part, strict=True)

        cuts = np.flatnonzero(np.diff(run[order])) + 1
        merged = iter(LoserTree([source(x) for x in np.split(order, cuts)]))
        while part := [i for _, i in islice(merged, AHEAD)]:
            yield from rows.select(names).take(part).combine_chunks().to_batches()

    ranges = max(1, -(-runs.count() // RANGE_ROWS))
    dealt = runs.repartitionByRange(max(ranges, int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "url_key", "captured", "page_id")
    return dealt.mapInArrow(merge, ", ".join(f"{x} {kind}" for x, kind in runs.dtypes if x in names))


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, folder = table(spark, sf_dir, "pages"), work_dir(spark)
    write_archives(pages, f"{folder}/archives", folder)
    records = read_archives(spark, f"{folder}/archives", dict(pages.dtypes)["page_id"])
    runs = materialize(index_runs(records), f"{folder}/runs")
    return merge_index(runs).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = r"""
WITH d AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), b AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(h, 1 + 5 * (i // 4), 5) AS INTEGER) >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1)), '') AS payload_digest FROM d
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = min(page_id) OVER w THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = min(page_id) OVER w THEN NULL ELSE min(page_id) OVER w END AS refers_to
FROM b WINDOW w AS (PARTITION BY payload_digest)
"""
