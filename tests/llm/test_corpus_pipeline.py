"""Each stage of the pipeline, and the whole of it, against brute force; the first with its own scores."""

import hashlib
import re

import pytest
import test_llm_operators as small

import corpus_pipeline as pipeline
from shapelog.llm import toxicity

SCHEMA = "doc_id bigint, text string, lang string, score double, rid string, doc string, n_tokens string, kept string, contaminated string, component_id string, digest string, place string, _place string, the_id string, size string, _text string, _doc string"
REST = ("en", 0.75, "r", "d", "t", "k", "c", "i", "g", "p", "q", "h", "s", "x", "y")
ITEMS = [(1, small.PASSAGE), (2, None), (3, "zeta zeta")]
TOXIC = [f"vile scum {small.text(8, 200 + i)}" for i in range(40)]
CLEAN = [small.text(12, 300 + i) for i in range(60)]
TEXTS = [*small.TEXTS, *TOXIC, *CLEAN]
DOCS = [*enumerate(TEXTS), (None, "without an id"), (7, small.TEXTS[7])]  # the last repeats a row


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("corpus")
    base = len(small.TEXTS)
    labels = [(base + i, 1, int(i < len(TOXIC))) for i in range(len(TOXIC) + len(CLEAN))] + [(None, 1, 1), (0, None, None), (base, 1, 1)]
    write(spark, at, DOCS, labels, ITEMS)
    return str(at)


def write(spark, at, docs, labels, items):
    table(spark, docs).repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{at}/benchmark.parquet")


def table(spark, docs):
    return spark.createDataFrame([(*d, *REST) for d in docs], SCHEMA)


def order(rows):
    return sorted(map(tuple, rows), key=repr)


def least(rows):
    """The row that stays of copies: the smallest doc_id, null after all others."""
    return min(rows, key=lambda r: (r[0] is None, r[0] or 0))


def exact(docs):
    groups = {}
    for d in docs:
        groups.setdefault(re.sub("[\x20\x09-\x0d]+", " ", d[1] or ""), []).append(d)
    return [least(g) for g in groups.values()]


def shingles(t):
    w = re.sub(b"[A-Z]", lambda m: m[0].lower(), (t or "").encode()).split()
    return {tuple(w[p : p + 5]) for p in range(max(1, len(w) - 4))} if w else set()


def near(docs):
    sets, left, out = [shingles(t) for _, t in docs], set(range(len(docs))), []
    while left:
        todo, group = [left.pop()], []
        while todo:
            i = todo.pop()
            group.append(i)
            linked = {j for j in left if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])}
            left -= linked
            todo += linked
        out.append(least([docs[i] for i in group]))
    return out


def clean(docs):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    windows = set()
    for _, t in ITEMS:
        w = words(t)
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(x) for x in windows}
    return [d for d in docs if not any(tuple(w[i : i + n]) in windows for w in [words(d[1])] for n in sizes for i in range(len(w) - n + 1))]


def encoded(docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = []
    for i, t in docs:
        ids = library.encode(t or "", add_special_tokens=False).ids
        out.append((i, len(ids), " ".join(map(str, ids)), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    return out


def mild(spark, docs, folder):
    """By the stage's own scores."""
    labels = spark.read.parquet(f"{folder}/labels.parquet").filter(~toxicity.held_out(5, 0))
    frame = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return [(r.doc_id, r.text) for r in toxicity.score(frame, toxicity.fit(frame, labels)).collect() if r.score < 0.5]


WANT = [None, exact, near, clean, encoded]


@pytest.mark.parametrize("k", range(5))
def test_stage(spark, folder, k):
    stage = pipeline.STAGES[k][1]
    docs = list(DOCS)
    if k == 2:
        docs = exact(docs)
    want = WANT[k](docs) if k else mild(spark, docs, folder)
    found = stage(spark, table(spark, docs).repartition(3), folder)
    if k < 4:
        assert found.dtypes == table(spark, []).dtypes and 0 < len(want) < len(DOCS)
        want = [(*d, *REST) for d in want]
    assert order(found.collect()) == order(want)
    assert stage(spark, table(spark, []), folder).count() == 0


def test_run(spark, folder):
    docs = mild(spark, DOCS, folder)
    for step in WANT[1:]:
        docs = step(docs)
    assert len(docs) > 40 and order(pipeline.run(spark, folder).collect()) == order(docs)


def test_run_on_empty_tables(spark, tmp_path):
    write(spark, tmp_path, [], [], [])
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_null_and_repeated_ids(spark, folder):
    """Near copies with one repeated id or null ids only leave one row; a contaminated row takes no other with it."""
    base, other, third = (small.text(80, s) for s in (70, 71, 72))
    edited = lambda t, w: " ".join([*t.split()[:-1], w])
    groups = [[(5, base), (5, edited(base, "x"))], [(None, other), (None, edited(other, "x")), (None, edited(other, "y"))], [(5, third), (9, third)], [(5, third + " " + small.text(80, 73))]]
    alone = [(5, None), (5, ""), (None, " "), (None, " ")]
    found = pipeline.ngram_join_stage(spark, table(spark, [*(d for g in groups for d in g), (5, base), (9, third), *alone]).repartition(3), folder)
    rows = [(r.doc_id, r.text) for r in found.collect()]
    assert [sum(r in g for r in rows) for g in groups] == [1, 1, 1, 1] and (5, third) in rows and order(r for r in rows if not (r[1] or "").strip()) == order(alone)
    docs = [(5, small.PASSAGE), (5, base), (None, "a " + small.PASSAGE), (None, other), (None, None), (5, base), (6, third)]
    found = pipeline.decontaminate_stage(spark, table(spark, docs).repartition(3), folder)
    assert order((r.doc_id, r.text) for r in found.collect()) == order(clean(docs)) and len(clean(docs)) == 5
