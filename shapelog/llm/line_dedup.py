"""Line dedup over overlapping three-line windows.

Each three consecutive lines of a document are hashed. Windows that occur again, anywhere, are found
by an aggregate that combines before its shuffle; all but the first occurrence of each are joined
back to their documents, where the lines they cover merge and go.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shapelog.llm import spans
from shapelog.llm.common import materialize, table, work_dir

LINES = 3


def line_dedup(docs: DataFrame, folder: str, lines: int = LINES) -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed, kept (the lines left, joined by newlines).

    Lines end at a newline and are compared as they are, blank ones too. Of equal windows of `lines`
    lines the first stays, by doc_id (null as the largest) and then by place in the text; every line
    under another one goes. Windows are judged on the input. Null and empty texts have no lines; a
    text of fewer than `lines` lines loses none. A row that is repeated as a whole is the same
    occurrence. Columns other than doc_id and text are ignored.
    """
    own, _ = spans.keyed(docs, folder)
    split = own.select("doc", "rid", F.expr("split(text, '\\n', -1)").alias("l")).filter(f"size(l) >= {lines}")
    window = F.expr(f"transform(sequence(0, size(l) - {lines}), i -> unhex(md5(array_join(slice(l, i + 1, {lines}), '\\n'))))")
    # 128 bits of digest: windows are compared by value, whatever their number.
    seen = materialize(split.select("doc", "rid", F.posexplode(window).alias("lo", "w")), f"{folder}/windows")
    again = seen.groupBy("w").agg(F.min(F.struct("doc", "rid", "lo")).alias("first"), F.count("*").alias("times")).filter("times > 1").select("w", "first")
    again = materialize(again, f"{folder}/again")  # so that both sides of the join are plain shuffles, which Spark can split
    later = seen.join(again.hint("merge"), "w").filter("struct(doc, rid, lo) > first").selectExpr("doc", "rid", "lo", f"{lines} AS len")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, gone, texts = [], [], []
            for text, drop in zip(batch["text"].to_pylist(), spans.covered(batch["rows"]), strict=True):
                parts, at, kept = text.split("\n") if text else [], 0, []
                for lo, hi in drop.tolist():
                    kept += parts[at:lo]
                    at = hi
                kept += parts[at:]
                sizes.append(len(parts))
                gone.append(len(parts) - len(kept))
                texts.append("\n".join(kept))
            columns = [batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_lines", "n_removed", "kept"])

    kind = dict(docs.dtypes)["doc_id"]
    rows = spans.with_text(own, later, ["lo", "len"], "left").select("doc_id", "text", "rows")
    return rows.mapInArrow(cut, f"doc_id {kind}, n_lines long, n_removed long, kept string")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents"), work_dir(spark))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH l AS (SELECT doc_id, CASE WHEN coalesce(text, '') = '' THEN [] ELSE string_split(text, chr(10)) END AS l FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(l[i : i + 2], chr(10)) AS s
  FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS i FROM l WHERE len(l) >= 3)
), later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS r FROM win) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 3)) AS i FROM later),
kept AS (
  SELECT doc_id, count(*) FILTER (g.i IS NULL) AS n_kept, string_agg(line, chr(10) ORDER BY p.i) FILTER (g.i IS NULL) AS text
  FROM (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS i FROM l) p LEFT JOIN gone g USING (doc_id, i) GROUP BY doc_id
)
SELECT l.doc_id, CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - coalesce(n_kept, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM l LEFT JOIN kept USING (doc_id)
"""
