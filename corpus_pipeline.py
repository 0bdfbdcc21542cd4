"""Cleaning of a corpus, stage by stage, from documents to token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's docs. All but the last return the columns of documents. A stage decides
on all that the one before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shapelog.llm import bpe, decontaminate, exact_dedup, ngram_join, toxicity
from shapelog.llm.common import materialize, table, work_dir


def fresh(docs: DataFrame, name: str) -> str:
    """A name that no column of the documents has, whatever its case."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = f"_{name}"
    return name


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine scores under 0.5 stay, with all their columns as they are.

    Null and empty texts score what the base rate of the labels gives; repeated rows stay or go alike; an
    empty table stays empty.
    """
    labels = table(spark, sf_dir, "labels")
    machine = toxicity.fit(docs, labels.filter(~toxicity.held_out(5, 0)))
    own = fresh(docs, "score")
    scored = toxicity.score(docs.withColumnRenamed("score", own) if own != "score" else docs, machine).filter("score < 0.5").drop("score")
    return (scored.withColumnRenamed(own, "score") if own != "score" else scored).select(*docs.columns)


def first_rows(rows: DataFrame, keys: list[str], where: str, place: str) -> DataFrame:
    """Of rows that agree in all keys one, or all that meet the condition."""
    return rows.withColumn(place, F.row_number().over(Window.partitionBy(*keys).orderBy("doc_id"))).filter(f"{place} = 1 OR {where}")


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest doc_id stays, and one row of those that repeat it.

    Null counts as the empty text, a null doc_id ranks after all others, and an empty table stays empty.
    """
    folder = work_dir(spark)
    index = exact_dedup.DigestIndex(spark, f"{folder}/index", dict(docs.dtypes)["doc_id"], temporary=True)
    kept = exact_dedup.exact_dedup(docs, index, folder).filter("kept").select(F.col("doc_id").alias("the_id"), F.col("text_sha256").alias("the_digest")).distinct()
    text, place = fresh(docs, "digest"), fresh(docs, "place")
    rows = docs.withColumn(text, exact_dedup.digest(F.col("text"))).alias("own")
    joined = rows.join(kept.alias("kept").hint("merge"), (F.col(f"own.{text}") == F.col("kept.the_digest")) & F.col("own.doc_id").eqNullSafe(F.col("kept.the_id")))
    return first_rows(joined.select("own.*"), [text, "doc_id"], "false", place).select(*docs.columns)


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest doc_id stays, then the smallest hash of its text.

    A null doc_id ranks after all others. Of rows that repeat both doc_id and text one stays, unless
    the text has no words: such texts are near copies of nothing. An empty table stays empty.
    """
    found = ngram_join.ngram_join(docs, work_dir(spark))
    first = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("rid") == F.col("first_rid"))
    kept = found.filter(first).select(F.col("doc_id").alias("the_id"), F.col("rid").alias("the_rid"), F.col("n_shingles").alias("the_size")).distinct()
    text, size, place = (fresh(docs, x) for x in ("rid", "size", "place"))
    rows = docs.withColumn(text, F.xxhash64(F.coalesce("text", F.lit("")))).alias("own")
    same = F.col("own.doc_id").eqNullSafe(F.col("kept.the_id")) & (F.col(f"own.{text}") == F.col("kept.the_rid"))
    joined = rows.join(kept.alias("kept").hint("shuffle_hash"), same)
    return first_rows(joined.select("own.*", F.col("kept.the_size").alias(size)), ["doc_id", text], f"{size} = 0", place).select(*docs.columns)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item stay, all repeated rows of them too.

    Each text of a null or repeated doc_id is judged by itself; null and empty texts stay.
    """
    text = fresh(docs, "rid")
    row = F.struct("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("rid"))
    found = decontaminate.decontaminate(docs.select(row.alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"), work_dir(spark))
    hit = found.filter("contaminated").select(F.col("doc_id.doc_id").alias("the_id"), F.col("doc_id.rid").alias("the_rid")).distinct()
    rows = docs.withColumn(text, F.xxhash64(F.coalesce("text", F.lit("")))).alias("own")
    same = F.col("own.doc_id").eqNullSafe(F.col("hit.the_id")) & (F.col(f"own.{text}") == F.col("hit.the_rid"))
    return rows.join(hit.alias("hit").hint("shuffle_hash"), same, "left_anti").select(*docs.columns)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (decimal, joined by one space), and the digest of what they decode to.

    Null and empty texts have no tokens; every row gives one, repeated ones and null ids too.
    """
    import public_tokenizers

    out = bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "n_tokens", "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact dedup", exact_dedup_stage),
    ("n-gram Jaccard join", ngram_join_stage),
    ("benchmark decontamination", decontaminate_stage),
    ("BPE encoding and decoding", bpe_stage),
]

#: SQL can't express the first and the last stage; tests compare all with brute force, the first by its own scores.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), work_dir(spark)
    for i, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"{folder}/stage{i}")
    return docs
