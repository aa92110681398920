"""Token counts, word runs and pivot clusters against plain Python."""

import hashlib
import math
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from reelhouse.llm import heap_counts, pivot_clusters, queries, word_runs
from tests.conftest import SAMPLE_FOLDER, plan_of

BYTE_FILE = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "It's 12 o'clock, don't they'll say!", "", None, "ÀÉÎ straße ﬁne Ⅳ 漢字 😀", " \n\n\t x  ", "x" * 30_000,
    "same text", "same text", "<|endoftext|>", "a<|endoftext|><|endoftext|> b <|endoftext", "　\x85\x1c\x00",
    "word " * 40_000, "ab" * 9_000 + " " * 9_000, "'s'll'LL 'RE",
]


def documents(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", 1, "s") for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, runs int, key string")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE_FILE)


@pytest.fixture(scope="module")
def heap():
    with open(BYTE_FILE, encoding="utf-8") as file:
        return heap_counts.PairHeap(file.read())


def test_counts_of_odd_texts(spark, library):
    docs = documents(spark, TEXTS, [None, *range(1, len(TEXTS))])
    rows = heap_counts.count_tokens(docs.union(docs.limit(2)), BYTE_FILE, limit=6).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        text = TEXTS[r.doc_id or 0] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 6)
    assert heap_counts.count_tokens(docs.limit(0), BYTE_FILE).count() == 0


def test_counts_of_the_whole_table(spark, library):
    texts = {r.doc_id: r.text or "" for r in queries.read(spark, SAMPLE_FOLDER, "documents").collect()}
    found = {r.doc_id: r for r in queries.all_queries()["op13_heap_counts"](spark, SAMPLE_FOLDER).collect()}
    assert found.keys() == texts.keys()
    for doc, code in zip(texts, library.encode_batch(list(texts.values()), add_special_tokens=False)):
        n = len(code.ids)
        assert (found[doc].n_tokens, found[doc].over_limit) == (n, n > 512)
        assert found[doc].n_bytes == len(texts[doc].encode())


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("aest'rvml d1 \n\t.,éß漢😀́ <|>")), max_size=40))
def test_any_text_gives_the_librarys_count(library, heap, text):
    assert heap.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_every_character_is_of_the_librarys_class(library, heap):
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(chars), 50_000):
        texts = [f"a{c} {c}1" for c in chars[at : at + 50_000]]
        codes = library.encode_batch(texts, add_special_tokens=False)
        wrong = [t for t, code in zip(texts, codes) if heap.count(t) != len(code.ids)]
        assert wrong == []


def test_other_definitions_are_refused():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        with pytest.raises(ValueError):
            heap_counts.PairHeap(file.read())


def plain_runs(codes):
    """(start, length, smallest period) by comparing all words at all distances."""
    n, found = len(codes), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and codes[j] == codes[j + q]:
                j += 1
            if j - i >= q:
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


@st.composite
def periodic_words(draw):
    """Blocks repeated, and again those repeated, over a small alphabet."""
    word = st.lists(st.integers(0, draw(st.integers(0, 3))), min_size=1, max_size=9)
    out = []
    for _ in range(draw(st.integers(1, 4))):
        inner = draw(word) * draw(st.integers(1, 12))
        out += (inner + draw(word)) * draw(st.integers(1, 4)) + draw(word)
    return out[:260]


@settings(max_examples=500, deadline=None)
@given(periodic_words())
def test_runs_are_those_of_all_comparisons(codes):
    found = word_runs.find_runs(np.array(codes, np.int64))
    assert [(s, e - s, q) for s, e, q in found.tolist()] == plain_runs(codes)


def test_halves_that_are_highly_periodic():
    for p, size, copies in ((1, 40, 2), (3, 55, 2), (2, 61, 3), (5, 99, 2), (7, 140, 2)):
        root = [0] * (p - 1) + [1]
        codes = (root * size)[:size] * copies
        found = [(s, e - s, q) for s, e, q in word_runs.find_runs(np.array(codes)).tolist()]
        assert found == plain_runs(codes) and (0, len(codes), size if size % p else p) in found


def plain_document(doc_id, text):
    """The contract's columns, word by word."""
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = [r for r in plain_runs(words) if r[1] >= 12]
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join("%d,%d,%d\n" % r for r in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *shown, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_documents_runs(spark, tmp_path):
    texts = [
        None, "", " \t\n", "one", "a " * 11, "a " * 12, "x y z " * 40 + "end", "é b c\x0bd " * 30,
        "one two three four five six " * 3 + "odd " + "one two three four five six " * 3,
        "same line again and again\n" * 9, "w " * 5_000,
    ]
    texts += [" ".join(f"w{(i * k) % 37}" for i in range(150)) for k in range(1, 90)]
    ids = [None, 1, 1, *range(3, len(texts))]
    documents(spark, texts, ids).drop("runs").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.all_queries()["op12_word_runs"](spark, str(tmp_path)).collect()
    expected = [plain_document(i, t) for i, t in zip(ids, texts) if t != "w " * 5_000]
    assert any(e[0] and zlib.crc32(str(e[0]).encode()) % 10 == 0 and e[1] for e in expected)
    long = [tuple(r) for r in found if r.doc_id == 10]
    assert long[0][1:6] == (1, 0, 5_000, 1, 5_000_000)
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, [*expected, *long]))
    clashing = word_runs.find_document_runs(documents(spark, texts, ids))
    assert clashing.columns == ["doc_id", "runs", "collapsed"] and clashing.count() == len(texts)
    assert word_runs.find_document_runs(documents(spark, texts).limit(0)).count() == 0


def test_runs_on_the_sample(spark):
    """A part of the sample's documents, long ones among them, word by word."""
    docs = [r for r in queries.read(spark, SAMPLE_FOLDER, "documents").select("doc_id", "text").collect()]
    found = {r.doc_id: tuple(r) for r in queries.all_queries()["op12_word_runs"](spark, SAMPLE_FOLDER).collect()}
    assert len(found) == len(docs)
    for d in docs:
        if len((d.text or "").split()) < 700:
            assert found[d.doc_id] == plain_document(d.doc_id, d.text)


def plain_clusters(rows, clusters=8, rounds=10, components=64):
    kept = [
        (i, [math.floor(1024 * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == components and all(x is not None and math.isfinite(x) for x in v)
    ]
    digest = lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(kept, key=digest)[:clusters]]
    apart = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    for turn in range(rounds + 1):
        placed = [min((apart(v, c), n) for n, c in enumerate(centroids)) for _, v in kept]
        if turn < rounds:
            for n in range(len(centroids)):
                own = [v for (_, v), (_, c) in zip(kept, placed) if c == n]
                if own:
                    centroids[n] = [sum(column) // len(own) for column in zip(*own)]
    long = lambda x: x if x < 1 << 63 else None
    out = []
    for (i, _), (d, n) in zip(kept, placed):
        own, every = sum(d for d, c in placed if c == n), sum(d for d, _ in placed)
        sha = hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest()
        out.append((i, n, long(d), long(own), long(every), sha))
    return out


def vectors(spark, rows):
    kinds = "vec_id long, embedding array<double>, vec string, cluster string"
    return spark.createDataFrame([(i, v, "v", "c") for i, v in rows], kinds)


@pytest.mark.parametrize("size", [1.0, 1e5, 1e6, 1e8])
def test_clusters_of_odd_vectors(spark, size):
    draw = np.random.default_rng(5)
    centres = draw.normal(0, size, (6, 64))
    rows = [(i, (centres[i % 6] + draw.normal(0, size / 8, 64)).tolist()) for i in range(160)]
    rows += [(i, rows[i][1]) for i in range(5)]  # repeated rows
    rows += [(None, rows[7][1]), (None, rows[8][1]), (200, rows[9][1]), (201, [0.0] * 64), (202, [-0.0] * 64)]
    rows += [(300, None), (301, []), (302, [1.0] * 63), (303, [1.0] * 65), (304, [None] + [1.0] * 63)]
    rows += [(305, [math.nan] * 64), (306, [math.inf] + [1.0] * 63)]
    found = pivot_clusters.cluster_vectors(vectors(spark, rows))
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, plain_clusters(rows)))


def test_few_and_no_vectors(spark):
    rows = [(4, [0.5] * 64), (9, [0.25] * 64), (2, [9.0] * 64)]
    for part in (rows, rows[:1], []):
        df = vectors(spark, part) if part else vectors(spark, rows).limit(0)
        found = pivot_clusters.cluster_vectors(df).collect()
        assert sorted(map(tuple, found)) == sorted(plain_clusters(part))
    beyond = pivot_clusters.cluster_vectors(vectors(spark, [*rows, (5, [1e300] * 64)])).collect()
    assert sorted(map(tuple, beyond)) == sorted(plain_clusters(rows))


def test_bounds_spare_exact_distances():
    draw = np.random.default_rng(2)
    centres = draw.integers(-2_000, 2_000, (8, 64))
    points = np.repeat(centres, 50, axis=0) + draw.integers(-60, 60, (400, 64))
    pivots = pivot_clusters.choose_pivots(points[::7], 12)
    stored = pivot_clusters.pivot_distances(points, pivots)
    cluster, best, taken = pivot_clusters.nearest(points, stored, centres, pivots)
    every = ((points[:, None] - centres[None]) ** 2).sum(axis=2)
    assert (cluster == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
    assert taken < 1.5 * len(points)


def test_clusters_do_not_depend_on_partitions(spark):
    rows = queries.read(spark, SAMPLE_FOLDER, "embeddings")
    one = pivot_clusters.cluster_vectors(rows.repartition(1)).collect()
    many = pivot_clusters.cluster_vectors(rows.repartition(13)).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, many))
    assert "BatchEvalPython" not in plan_of(pivot_clusters.whole_vectors(rows, 64, 1024))
