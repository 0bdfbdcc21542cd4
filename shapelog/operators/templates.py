"""Templates of lines of unknown shape (Drain: He et al., ICWS 2017), and the learned codebook.

Lines of one source, length and first word form a leaf; only they compete for a template. Training
deals out the leaves, sorts each by its lines' order and streams it, so a leaf may be of any size:
what is held is its templates. Matching is by position, in column expressions.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import UTC, datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shapelog.functions.tags import tag_variable
from shapelog.functions.text import strip, tokens
from shapelog.sources.shared import join_small, shared_folder, written

ANY = "<*>"
#: Share of equal tokens from which a line belongs to a template.
SIMILARITY = 0.4
#: Lines that a template must have had to be promoted.
MIN_OCCURRENCES = 20
SAMPLE_CHARS = 200
#: Lines of one leaf that one task trains on, at most: a larger leaf is trained in parts.
LEAF_LINES = 1_000_000

TEMPLATES = "source_name string, template string, tokens array<string>, size bigint, example string, example_path string, example_line bigint"
ENTRIES = "signature string, template string, tokens array<string>, sample_count bigint, sample_line string, learned_from_source string, roles array<string>"


def line_tokens(raw: Column) -> Column:
    """Words, with | and , as separators too."""
    return tokens(F.translate(strip(raw), "|,", "  "))


class Leaf:
    """Templates that compete for the lines of one leaf."""

    def __init__(self, similarity: float = SIMILARITY):
        self.similarity = similarity
        self.clusters: list[dict] = []

    def add(self, words: list[str], weight: int, example: tuple) -> dict:
        best, most = None, (-1.0, -1)
        for cluster in self.clusters:
            have = cluster["tokens"]
            same = sum(a == b and a != ANY for a, b in zip(have, words, strict=True))
            score = (same / len(words), have.count(ANY))
            if score > most:
                best, most = cluster, score
        if best is None or most[0] < self.similarity:
            best = {"tokens": list(words), "size": 0, "example": example}
            self.clusters.append(best)
        else:
            best["tokens"] = [a if a == b else ANY for a, b in zip(best["tokens"], words, strict=True)]
        best["size"] += weight
        return best


def with_leaf(lines: DataFrame, wordless: bool = False) -> DataFrame:
    """Words and leaf of each line; lines of separators only have no words, and go unless wordless is set."""
    first = F.try_element_at("words", F.lit(1))
    leaf = F.concat_ws(" ", F.size("words"), F.when(F.size("words") > 1, F.when(first.rlike(r"\d"), ANY).otherwise(first)))
    rows = lines.withColumn("words", line_tokens(F.col("raw")))
    return (rows if wordless else rows.filter("size(words) > 0")).withColumn("leaf", leaf)


def known_rows(templates: DataFrame) -> DataFrame:
    """Templates as rows of their leaf, to go on from or to merge."""
    first = F.try_element_at("tokens", F.lit(1))
    leaf = F.concat_ws(" ", F.size("tokens"), F.when(F.size("tokens") > 1, F.when(first.rlike(r"\d") | (first == ANY), ANY).otherwise(first)))
    named = templates.withColumn("leaf", leaf).withColumnsRenamed({"tokens": "words", "size": "weight", "example": "raw", "example_path": "source_path", "example_line": "line_number"})
    return named.select("source_name", "leaf", "words", "weight", "raw", "source_path", "line_number")


def train(lines: DataFrame, similarity: float = SIMILARITY, salts: int | None = None, known: DataFrame | None = None, leaf_lines: int = LEAF_LINES) -> DataFrame:
    """One row per template: source, text, tokens, size, first line.

    known: templates of earlier lines of the sources, which the new lines go on from; all are in the
    result, so it is the state that the next run goes on from. A leaf too large for one task is first
    trained in parts, as many as its measured lines need (or as `salts` says), and their templates are
    then merged; those may differ from what one pass in order would give.
    """
    keys = ["source_name", "leaf", "salt"]

    def mine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, leaf = None, Leaf(similarity)

        def done() -> pd.DataFrame:
            rows = [(key[0], " ".join(c["tokens"]), c["tokens"], c["size"], *c["example"]) for c in leaf.clusters]
            return pd.DataFrame(rows, columns=[x.split()[0] for x in TEMPLATES.split(", ")])

        for batch in batches:
            for source, place, salt, words, weight, raw, path, number, given in batch[[*keys, "words", "weight", "raw", "source_path", "line_number", "given"]].itertuples(index=False, name=None):
                if (source, place, salt) != key:
                    if key is not None:
                        yield done()
                    key, leaf = (source, place, salt), Leaf(similarity)
                if given:
                    leaf.clusters.append({"tokens": list(words), "size": int(weight), "example": (raw, path, number)})
                else:
                    leaf.add(list(words), int(weight), (raw, path, number))
        if key is not None:
            yield done()

    def pass_over(rows: DataFrame, start: DataFrame | None) -> DataFrame:
        every = rows.withColumn("given", F.lit(False))
        if start is not None:
            every = every.unionByName(known_rows(start).withColumn("salt", F.lit(0)).withColumn("given", F.lit(True)))
        dealt = every.repartition(*keys).sortWithinPartitions(*keys, F.desc("given"), "source_path", "line_number")
        return dealt.mapInPandas(mine, TEMPLATES)

    columns = ["source_name", "leaf", "salt", "words", "weight", "raw", "source_path", "line_number"]
    rows = with_leaf(lines).withColumn("weight", F.lit(1).cast("bigint"))
    if salts is None:
        # At most one leaf in leaf_lines lines is that large.
        large = rows.groupBy("source_name", "leaf").agg(F.count("*").alias("n")).filter(F.col("n") > leaf_lines).select("source_name", "leaf", F.ceil(F.col("n") / leaf_lines).cast("int").alias("salts")).persist()
        parted = not large.isEmpty()
        rows = rows.join(F.broadcast(large), ["source_name", "leaf"], "left") if parted else rows.withColumn("salts", F.lit(1))
    else:
        parted, rows = salts > 1, rows.withColumn("salts", F.lit(salts))
    salt = F.pmod(F.xxhash64("source_path", "line_number"), F.coalesce("salts", F.lit(1))).cast("int")
    rows = rows.withColumn("salt", salt).select(*columns)
    if parted:
        rows = known_rows(pass_over(rows, None)).withColumn("salt", F.lit(0)).select(*columns)
    return pass_over(rows, known)


def mine_online(lines: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Each line with the template as it stood right after the line, as a one-pass miner reports it.

    A line without words is its own template, the empty text of size 1, as `match` has it. What a line
    shows depends on all lines before it, so a leaf is one task's, whatever its size: for sources of
    bounded size; `train` and `match` have no such bound.
    """
    out = "source_path string, source_name string, line_number bigint, raw string, template string, tokens array<string>, cluster_size bigint"

    def mine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, leaf = None, Leaf(similarity)
        for batch in batches:
            rows = []
            for source, place, words, raw, path, number in batch[["source_name", "leaf", "words", "raw", "source_path", "line_number"]].itertuples(index=False, name=None):
                if (source, place) != key:
                    key, leaf = (source, place), Leaf(similarity)
                c = leaf.add(list(words), 1, ()) if len(words) else {"tokens": [], "size": 1}
                rows.append((path, source, number, raw, " ".join(c["tokens"]), list(c["tokens"]), c["size"]))
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in out.split(", ")])

    dealt = with_leaf(lines, wordless=True).repartition("source_name", "leaf").sortWithinPartitions("source_name", "leaf", "source_path", "line_number")
    return with_variables(dealt.mapInPandas(mine, out), F.col("tokens")).drop("tokens").withColumn("learned", F.lit(False))


def with_variables(lines: DataFrame, template: Column) -> DataFrame:
    """The typed words of a line where its template has a variable."""
    words = line_tokens(F.col("raw"))
    at = F.filter(F.arrays_zip(template.alias("t"), words.alias("w")), lambda x: x["t"] == ANY)
    return lines.withColumn("variables", F.transform(at, lambda x: tag_variable(x["w"])))


def _fits(template: Column, words: Column) -> Column:
    return F.forall(F.zip_with(template, words, lambda t, w: (t == ANY) | (t == w)), lambda x: x)


def match(lines: DataFrame, templates: DataFrame, codebook: DataFrame | None = None) -> DataFrame:
    """Each line with template, cluster_id, cluster_size, variables and learned.

    Entries of the learned codebook come first, by sample count; then the source's templates, the
    one with most literal words first. A line that fits none is its own template. Candidates of one
    length meet the line as one array, so a line stays one row; they are written first, and broadcast as
    long as they are few, so that no line is shuffled.
    """
    rows = lines.withColumn("words", line_tokens(F.col("raw"))).withColumn("n_words", F.size("words"))
    literal = F.size(F.filter("tokens", lambda t: t != ANY))
    own = templates.select("source_name", F.size("tokens").alias("n_words"), F.struct((-literal).alias("o"), (-F.col("size")).alias("p"), "template", "tokens", F.substring(F.sha1("template"), 1, 16).alias("id"), F.col("size").alias("size")).alias("t"))
    folder = shared_folder(lines.sparkSession)
    own = written(own.groupBy("source_name", "n_words").agg(F.sort_array(F.collect_list("t")).alias("own")), f"{folder}/own")
    rows = join_small(rows, own, ["source_name", "n_words"], "left")
    mine = F.try_element_at(F.filter("own", lambda t: _fits(t["tokens"], F.col("words"))), F.lit(1))
    rows = rows.withColumn("mine", mine)
    if codebook is not None:
        known = codebook.select(F.size("tokens").alias("n_words"), F.struct((-F.col("sample_count")).alias("o"), F.col("signature").alias("p"), "template", "tokens", F.concat(F.lit("learned:"), "signature").alias("id"), F.col("sample_count").alias("size")).alias("t"))
        known = written(known.groupBy("n_words").agg(F.sort_array(F.collect_list("t")).alias("known")), f"{folder}/known")
        rows = join_small(rows, known, ["n_words"], "left").withColumn("hit", F.try_element_at(F.filter("known", lambda t: _fits(t["tokens"], F.col("words"))), F.lit(1)))
    else:
        rows = rows.withColumn("hit", F.lit(None).cast("struct<o:bigint,p:string,template:string,tokens:array<string>,id:string,size:bigint>"))

    def pick(field: str, default: Column) -> Column:
        return F.coalesce(F.col("hit")[field], F.col("mine")[field], default)

    alone = F.array_join("words", " ")
    rows = rows.select(
        "source_path", "source_name", "line_number", "raw", pick("template", alone).alias("template"), pick("tokens", F.col("words")).alias("tokens"),
        pick("id", F.substring(F.sha1(alone), 1, 16)).alias("cluster_id"), pick("size", F.lit(1).cast("bigint")).alias("cluster_size"), F.col("hit").isNotNull().alias("learned"),
    )
    return with_variables(rows, F.col("tokens")).drop("tokens")


def infer_roles(variables: Column) -> Column:
    """A name for each variable of an example: the first address is the source, the second the destination."""
    def role(v: Column, i: Column) -> Column:
        def before(kind: str) -> Column:
            return F.size(F.filter(F.slice(variables, F.lit(1), i), lambda x: x["guessed_type"] == kind))

        kind = v["guessed_type"]
        ip = F.when(before("ip") == 0, "src_ip").when(before("ip") == 1, "dst_ip").otherwise("ip")
        port = F.when(before("port_or_number") == 0, "src_port").when(before("port_or_number") == 1, "dst_port").otherwise("port")
        return F.when(kind == "ip", ip).when(kind == "port_or_number", port).otherwise(kind)

    return F.transform(variables, role)


def promote(templates: DataFrame, min_occurrences: int = MIN_OCCURRENCES, existing: DataFrame | None = None) -> DataFrame:
    """Codebook entries of templates seen often enough and not in the codebook yet; the first source wins."""
    stable = templates.filter(F.col("size") >= min_occurrences)
    chosen = stable.groupBy("template").agg(F.min_by(F.struct("source_name", "tokens", "size", "example"), F.struct("source_name", "example_path", "example_line")).alias("x"))
    rows = chosen.select(F.substring(F.sha1("template"), 1, 16).alias("signature"), "template", "x.tokens", F.col("x.size").alias("sample_count"), F.col("x.example").alias("raw"), F.col("x.source_name").alias("learned_from_source"))
    rows = with_variables(rows, F.col("tokens")).withColumn("roles", infer_roles(F.col("variables")))
    rows = rows.select("signature", "template", "tokens", "sample_count", F.substring("raw", 1, SAMPLE_CHARS).alias("sample_line"), "learned_from_source", "roles")
    return rows if existing is None else rows.join(existing.select("signature"), "signature", "left_anti")


def merge_codebooks(mine: DataFrame, other: DataFrame) -> DataFrame:
    """Of each signature the entry with more lines behind it; mine if equal."""
    both = mine.withColumn("rank", F.lit(1)).unionByName(other.withColumn("rank", F.lit(0)))
    best = both.groupBy("signature").agg(F.max_by(F.struct(*[c for c in mine.columns if c != "signature"]), F.struct("sample_count", "rank")).alias("x"))
    return best.select("signature", *[F.col(f"x.{c}").alias(c) for c in mine.columns if c != "signature"])


def template_pattern(template: str) -> str:
    """An anchored pattern: each variable a non-greedy group, all else literal."""
    return "^" + "(.+?)".join(rf"\Q{part}\E" if part else "" for part in template.split(ANY)) + "$"


def pattern_of(template: Column) -> Column:
    """`template_pattern` of a column."""
    parts = F.transform(F.split(template, r"<\*>", -1), lambda x: F.when(x != "", F.concat(F.lit("\\Q"), x, F.lit("\\E"))).otherwise(""))
    return F.concat(F.lit("^"), F.array_join(parts, "(.+?)"), F.lit("$"))


def save_codebook(codebook: DataFrame, path: str) -> int:
    """Write the entries as one JSON file on the driver; a codebook holds a few thousand at most."""
    now = datetime.now(UTC).isoformat()
    rows = [r.asDict() for r in codebook.orderBy(F.desc("sample_count"), "signature").collect()]
    content = [{k: r[k] for k in ("signature", "template")} | {"regex": template_pattern(r["template"])} | {k: r[k] for k in ("roles", "sample_count", "sample_line", "learned_from_source")} | {"learned_at": now} for r in rows]
    with open(path, "w", encoding="utf-8") as f:
        json.dump({"codebook_version": 1, "entries": content}, f, indent=2)
    return len(rows)


def load_codebook(spark: SparkSession, path: str) -> DataFrame:
    with open(path, encoding="utf-8") as f:
        entries = json.load(f)["entries"]
    rows = [(e["signature"], e["template"], e["template"].split(), e["sample_count"], e["sample_line"], e["learned_from_source"], e["roles"]) for e in entries]
    return spark.createDataFrame(rows, ENTRIES)


def review_summary(promoted: DataFrame) -> DataFrame:
    """A line of text per promoted template, the most frequent first."""
    return promoted.orderBy(F.desc("sample_count"), "signature").select(F.format_string("[%5dx from %-28s]  %s", "sample_count", "learned_from_source", "template").alias("line"))
