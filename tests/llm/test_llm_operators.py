"""The training-data operators against brute force, on small texts with nulls, copies and clashing columns."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shapelog.llm import bpe, decontaminate, exact_dedup, line_dedup, ngram_join, quality, substring_dedup, suffix_dedup, toxicity, warc
from shapelog.llm.common import work_dir

RNG = random.Random(5)
WORDS = ["alpha", "Beta", "gamma", "délta", "eps", "zeta!", "eta", "theta"]


def text(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n))


BASE = text(160, 1)
PASSAGE = text(70, 2)
NEAR = BASE.split()
NEAR[80] = "edited"
TEXTS = [
    None, "", "  \n ", "one two", "one\ttwo", BASE, BASE, " ".join(NEAR), text(30, 3) + " " + PASSAGE + " " + text(30, 4), text(10, 5) + "\n" + PASSAGE + text(20, 6),
    "a\nb\nc\nd\na\nb\nc\n", "x\na\nb\nc\ny", PASSAGE, "Ünïcode 中文 text " * 40, text(3000, 7), "w " * 300, BASE.upper(),
]
SCHEMA = "doc_id bigint, text string, lang string, rows int, doc string, score double, rid string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", 1, "x", 0.5, "r") for i, t in enumerate(TEXTS)], SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def got(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_exact_dedup(spark, docs):
    folder = work_dir(spark)
    index = exact_dedup.DigestIndex(spark, f"{folder}/index")
    found = got(exact_dedup.exact_dedup(docs, index, folder), "doc_id", "keep_id", "group_size")
    key = [re.sub("[\x20\x09-\x0d]+", " ", t or "") for t in TEXTS]
    assert found == [(i, key.index(k), key.count(k)) for i, k in enumerate(key)]
    more = spark.createDataFrame([(100, BASE), (101, "new"), (102, "new")], "doc_id bigint, text string")
    again = got(exact_dedup.exact_dedup(more, index, work_dir(spark)), "doc_id", "keep_id", "kept")
    assert again == [(100, TEXTS.index(BASE), False), (101, 101, True), (102, 101, False)]
    assert exact_dedup.exact_dedup(empty(spark), index, work_dir(spark)).count() == 0


def test_index_grows_and_reopens(spark):
    """The index gets more buckets as it grows, holds each digest once, and another object opens what one wrote."""
    folder, ids = work_dir(spark), []
    for part in range(4):
        index = exact_dedup.DigestIndex(spark, f"{folder}/index", bucket_rows=5, temporary=True)
        rows = [(100 * part + i, f"text {j}") for i, j in enumerate([*range(30 * part), 5, 5])]
        found = got(exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id bigint, text string"), index, work_dir(spark)), "doc_id", "keep_id")
        ids.append(dict(found))
    assert index.buckets == 32 and index.read().count() == index.read().select("digest").distinct().count() == 90
    assert ids[3][300 + 40] == 200 + 40 and ids[3][300 + 75] == 375 and ids[3][300 + 5] == 0
    none = spark.createDataFrame([(None, None), (None, "a"), (1, "a"), (1, "a"), (2, "")], "doc_id bigint, text string")
    own = exact_dedup.DigestIndex(spark, f"{folder}/other", temporary=True)
    found = sorted(map(tuple, exact_dedup.exact_dedup(none, own, work_dir(spark)).drop("text_sha256").collect()), key=repr)
    assert found == sorted([(None, 2, 2, False), (None, 1, 3, False), (1, 1, 3, True), (1, 1, 3, True), (2, 2, 2, True)], key=repr)


def item_hits(items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    out = []
    for i, t in enumerate(TEXTS):
        w, hit, ids = split(t), set(), set()
        for item, own in items:
            x = split(own)
            for n, s in {(min(10, len(x)), j) for j in range(max(1, len(x) - 9))} if x else ():
                for p in range(len(w) - n + 1):
                    if w[p : p + n] == x[s : s + n]:
                        hit |= set(range(p, p + n))
                        ids.add(str(item))
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return out


@pytest.mark.parametrize(("room", "bits"), [(decontaminate.BROADCAST_BYTES, decontaminate.FILTER_BITS), (-1, 6)])
def test_decontaminate(spark, docs, room, bits):
    """With any filter, even one that lets all through, and with or without broadcasts."""
    items = [(9, PASSAGE[:200]), (10, "one TWO"), (11, None), (12, ""), (13, "zeta"), (14, text(40, 99)), (15, PASSAGE[:200])]
    table = spark.createDataFrame([(*x, 1, "rid") for x in items], "item_id bigint, text string, doc_id int, tokens string")
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert got(decontaminate.decontaminate(docs, table, work_dir(spark), broadcast_bytes=room, filter_bits=bits), *names) == item_hits(items)


def test_decontaminate_repeated_ids(spark):
    """Each text of a repeated or null id has its own hits."""
    rows = [(1, PASSAGE), (1, "clean text"), (None, PASSAGE), (None, None), (1, PASSAGE), (2, "x " + PASSAGE + " y")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    items = spark.createDataFrame([(9, PASSAGE), (None, "clean text")], "item_id bigint, text string")
    n = len(decontaminate_words(PASSAGE))
    found = sorted(map(tuple, decontaminate.decontaminate(table, items, work_dir(spark)).select("doc_id", "n_words", "n_hit", "n_items").collect()), key=repr)
    assert found == sorted([(1, n, n, 1), (1, 2, 2, 0), (None, n, n, 1), (None, 0, 0, 0), (1, n, n, 1), (2, n + 2, n, 1)], key=repr)


def decontaminate_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)


def test_decontaminate_without_items(spark, docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.decontaminate(docs, none, work_dir(spark)).filter("contaminated").count() == 0
    assert decontaminate.decontaminate(empty(spark), none, work_dir(spark)).count() == 0


def test_substring_dedup(spark, docs):
    words = [(t or "").encode().split() for t in TEXTS]
    first = {}
    for i, w in enumerate(words):
        for p in range(len(w) - 49):
            first.setdefault(tuple(w[p : p + 50]), i)
    want = []
    for i, w in enumerate(words):
        gone = {q for p in range(len(w) - 49) if first[tuple(w[p : p + 50])] < i for q in range(p, p + 50)}
        want.append((i, len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone).decode()))
    assert got(substring_dedup.substring_dedup(docs, work_dir(spark)), "doc_id", "n_words", "n_removed", "kept") == want
    assert substring_dedup.substring_dedup(empty(spark), work_dir(spark)).count() == 0


@pytest.mark.parametrize("limit", [20_000, 1])
def test_suffix_dedup(spark, docs, limit):
    raw = [(t or "").encode() for t in TEXTS]
    seen = Counter(x[p : p + 400] for x in raw for p in range(len(x) - 399))
    want = []
    for i, x in enumerate(raw):
        gone = np.zeros(len(x) + 1, bool)
        for p in range(len(x) - 399):
            if seen[x[p : p + 400]] > 1:
                gone[p : p + 400] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        want.append((i, len(x), int(gone.sum()), spans, bytes(b for b, g in zip(x, gone, strict=False) if not g)))
    found = suffix_dedup.suffix_dedup(docs, work_dir(spark), group_limit=limit)
    assert [(*r[:4], bytes(r[4])) for r in got(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept")] == want


def test_line_dedup(spark, docs):
    lines = [(t or "").split("\n") if t else [] for t in TEXTS]
    seen, want = set(), []
    for i, x in enumerate(lines):
        gone = set()
        for p in range(len(x) - 2):
            key = tuple(x[p : p + 3])
            if key in seen:
                gone |= {p, p + 1, p + 2}
            seen.add(key)
        want.append((i, len(x), len(gone), "\n".join(y for j, y in enumerate(x) if j not in gone)))
    assert got(line_dedup.line_dedup(docs, work_dir(spark)), "doc_id", "n_lines", "n_removed", "kept") == want


@pytest.mark.parametrize("rows", [4096, 2])
def test_ngram_join(spark, docs, rows):
    sets = []
    for t in TEXTS:
        w = re.sub(b"[A-Z]", lambda m: m[0].lower(), (t or "").encode()).split()
        sets.append({tuple(w[p : p + 5]) for p in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(sets)))
    for _ in sets:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 75 * len(a | b):
                    root[i] = root[j] = min(root[i], root[j])
    want = [(i, len(s), root[i]) for i, s in enumerate(sets)]
    assert got(ngram_join.ngram_join(docs, work_dir(spark), block_rows=rows), "doc_id", "n_shingles", "component_id") == want
    assert ngram_join.ngram_join(empty(spark), work_dir(spark)).count() == 0


def test_bpe_equals_the_library(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    content = open(path, encoding="utf-8").read()
    library, own = Tokenizer.from_file(path), bpe.Bpe(content, bpe.unsettled(content))
    for t in [*filter(None, TEXTS), "<|endoftext|>A'LL ΣΑΣ<|startoftext|>", "a" * 2000, "ab" * 300 + "!?" * 50]:
        ids = library.encode(t, add_special_tokens=False).ids
        assert own.encode(t) == ids and own.decode(ids) == library.decode(ids, skip_special_tokens=False)
    rows = got(bpe.encode_decode(docs, path), "doc_id", "n_tokens", "ids", "decoded")
    assert [r[1] for r in rows] == [len(own.encode(t or "")) for t in TEXTS] and rows[0][2] == ""
    assert [r[3] for r in rows] == [library.decode(library.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False) for t in TEXTS]
    assert bpe.encode_decode(empty(spark), path).count() == 0
    # Every character there is, and each after a letter and before a digit.
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(every), 4096):
        for t in (" ".join(every[i : i + 4096]), "".join(f"a{c}1 " for c in every[i : i + 4096])):
            assert own.encode(t) == library.encode(t, add_special_tokens=False).ids
    many = spark.createDataFrame([(None, "one two"), (1, "one two"), (1, "x"), (1, "x")], "doc_id bigint, text string")
    assert bpe.encode_decode(many, path).count() == 4


def test_warc(spark):
    pages = [(1, "http://b.org/x", "héllo"), (2, "http://a.org/", "héllo"), (3, None, None), (4, "http://a.org/ y\r\nz", ""), (5, "http://b.org/x", "WARC/1.1\r\n\r\n" * 3), (6, "junk", "x" * 100_000)]
    table = spark.createDataFrame([(*p, 7) for p in pages], "page_id bigint, url string, html string, digest int").repartition(3)
    folder = work_dir(spark)
    warc.write_archives(table, f"{folder}/a", folder)
    records = warc.read_archives(spark, f"{folder}/a")
    assert {r.page_id: r.payload for r in records.collect()} == {1: "héllo", 2: None, 3: "", 4: None, 5: pages[4][2], 6: pages[5][2]}
    merged = warc.merge_index(warc.index_runs(records)).collect()
    assert {r.page_id: (r.record_type, r.refers_to) for r in merged} == {1: ("response", None), 2: ("revisit", 1), 3: ("response", None), 4: ("revisit", 3), 5: ("response", None), 6: ("response", None)}
    assert [r.url_key for r in merged] == sorted(r.url_key for r in merged)
    none = warc.index_runs(records.limit(0))
    assert warc.merge_index(none).count() == 0
    wanted = [r for r in merged if r.page_id in (2, 5)]
    found = warc.fetch(spark, spark.createDataFrame(wanted, warc.merge_index(none).schema)).collect()
    assert {(r.page_id, r.payload) for r in found} == {(2, None), (5, pages[4][2])} and warc.fetch(spark, warc.merge_index(none)).count() == 0


def test_warc_edges(spark, monkeypatch):
    """Null and repeated ids, small payloads, archives of few records, equal captures over several ranges, and no page."""
    monkeypatch.setattr(warc, "AHEAD", 2)
    monkeypatch.setattr(warc, "BATCH_BYTES", 10)
    pages = [(None, "http://a/", "same"), (1, "http://a/", "same"), (2, "http://a/", "same"), (2, "http://a/", "same"), (3, None, "ab"), (4, "http://a/", "ab"), (5, "http://a/", "\n"), (6, "http://a/", "x\r\n\r\n"), (7, "http://a/", "WARC/1.1\n")]
    pages += [(10 + i, "http://one.key/", f"body {i}") for i in range(40)]
    table = spark.createDataFrame([(*p, "2024-01-01T00:00:00Z") for p in pages], "page_id bigint, url string, html string, captured string").repartition(4)
    folder = work_dir(spark)
    warc.write_archives(table, f"{folder}/a", folder, min_bytes=3, records_per_file=7)
    records = warc.read_archives(spark, f"{folder}/a").cache()
    assert records.select("archive").distinct().count() >= 7
    small = {(r.page_id, r.record_type, r.refers_to) for r in records.collect() if r.page_id is None or r.page_id < 10}
    assert small == {(None, "revisit", 1), (1, "response", None), (2, "revisit", 1), (3, "response", None), (4, "response", None), (5, "response", None), (6, "response", None), (7, "response", None)}
    assert {r.page_id: r.payload for r in records.collect() if r.page_id in (5, 6, 7)} == {5: "\n", 6: "x\r\n\r\n", 7: "WARC/1.1\n"}
    from_runs = warc.merge_index(warc.index_runs(records)).collect()
    want = sorted((warc.url_key(u or "urn:null"), -1 if i is None else i) for i, u, _ in pages)
    assert [(r.url_key, -1 if r.page_id is None else r.page_id) for r in from_runs] == want
    # Places are those of the unpacked archive.
    import gzip

    for r in from_runs[:20]:
        with gzip.open(r.archive.removeprefix("file://").removeprefix("file:")) as f:
            data = f.read()[r.offset : r.offset + r.length]
        assert data.startswith(b"WARC/1.1\r\n") and (r.page_id is None or f"X-Page-Id: {r.page_id}\r\n".encode() in data)
    warc.write_archives(table.limit(0), f"{folder}/none", folder + "/n")
    assert warc.read_archives(spark, f"{folder}/none").count() == 0


def test_loser_tree():
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted(RNG.randrange(50) for _ in range(RNG.randrange(30))) for _ in range(k)]
        assert list(warc.LoserTree([iter(r) for r in runs])) == sorted(x for r in runs for x in r)


def test_multikey_quicksort():
    rows = np.frombuffer(bytes(RNG.choice(b"ab") for _ in range(300 * 20)), np.uint8).reshape(300, 20)
    order = suffix_dedup.multikey_quicksort(rows)
    assert [rows[i].tobytes() for i in order] == sorted(r.tobytes() for r in rows)


@pytest.mark.parametrize(("module", "label", "folds", "fold", "least"), [(toxicity, "toxic", 5, 0, 0.93), (quality, "quality", 3, 1, 0.93)])
def test_held_out_accuracy(spark, module, label, folds, fold, least):
    read = lambda name: spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet")
    out = toxicity.held_out(folds, fold)
    model = module.fit(read("documents"), read("labels").filter(~out))
    found = module.score(read("documents").select("doc_id", "text"), model).join(read("labels"), "doc_id").filter(out)
    assert found.agg(F.avg(((F.col("score") >= 0.5).cast("int") == F.col(label)).cast("int"))).first()[0] >= least
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "x")], "doc_id bigint, text string")
    assert all(0 <= r.score <= 1 for r in module.score(odd, model).collect())
    assert module.score(odd.limit(0), module.fit(odd, read("labels").limit(0))).count() == 0
