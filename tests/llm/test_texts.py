import base64
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reelhouse.llm import byte_bpe, cotraining, covering_simhash, hd_language, near_copies
from reelhouse.llm.components import components
from tests.conftest import SAMPLE_FOLDER, rows_of

RANK_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")
DOC = "doc_id long, text string, lang string, source string, n_chars long, score string, keep int"


def docs_of(spark, texts, langs=None):
    langs = langs or ["en"] * len(texts)
    return spark.createDataFrame([(i, t, l, "s", 1, "a", 5) for i, (t, l) in enumerate(zip(texts, langs))], DOC)


# -- byte-level BPE -------------------------------------------------------


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.BytePairs(byte_bpe.read_bytes(RANK_FILE))


@pytest.fixture(scope="module")
def library(bpe):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={}
    )


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("aZé '.,!\n\tstrevlmd19漢\u0301\u00a0\x1c\x00😀")), max_size=25), max_size=5))
def test_ids_are_the_librarys(bpe, library, texts):
    for text, (ids, offsets) in zip(texts, bpe.encode(texts)):
        assert ids == library.encode_ordinary(text)
        assert bpe.decode(ids) == text.encode()
        spans = [*offsets.tolist(), len(text.encode())]
        assert [bpe.decode([i]) for i in ids] == [text.encode()[a:b] for a, b in zip(spans, spans[1:])]


def test_all_letters_and_long_pieces(bpe, library):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    text = "".join(f"{chr(c)}x1" for c in points[::7])
    for whole in (text, "ab" * 40_000, " " * 5_000 + "x", "漢字" * 3_000):
        assert next(bpe.encode([whole]))[0] == library.encode_ordinary(whole)


def test_encode_and_decode_tables(spark, library):
    texts = ["it's here", "", None, "naïve  café\n", "it's here"]
    docs = docs_of(spark, texts)
    tokens = byte_bpe.encode(docs, RANK_FILE, decoded=True)
    again = {r.doc_id: bytes(r.decoded) for r in byte_bpe.decode(tokens.drop("decoded"), RANK_FILE).collect()}
    for r in tokens.collect():
        text = texts[r.doc_id] or ""
        assert r.ids == library.encode_ordinary(text)
        assert bytes(r.decoded) == text.encode() == again[r.doc_id]
    assert byte_bpe.encode(docs.limit(0), RANK_FILE).count() == 0


def test_rank_file_is_read_whole(bpe):
    lines = byte_bpe.read_bytes(RANK_FILE).splitlines()
    assert len(bpe.ranks) == len(lines) == 50_256
    assert bpe.tokens[int(lines[9].split()[1])] == base64.b64decode(lines[9].split()[0])


# -- SimHash --------------------------------------------------------------


def plain_fingerprint(text, n=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    parts = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from(list("aBÉ \t\n\x1c\u00a0")), max_size=60))
def test_fingerprint(text):
    assert covering_simhash.fingerprint(text) == plain_fingerprint(text)


def test_long_text_fingerprint():
    text = " ".join(f"w{i % 977}" for i in range(70_000))
    assert covering_simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_masks_cover_every_pair_within_the_radius(radius):
    rng = np.random.default_rng(radius)
    masks = covering_simhash.covering_masks(radius)
    finer = covering_simhash.finer_masks(radius)
    for _ in range(3000):
        flip = sum(1 << int(b) for b in rng.choice(64, radius, replace=False))
        meets = [t for t, m in enumerate(masks) if not m & flip]
        assert meets and all(any(not m & flip for m in finer[t]) for t in meets)


def plain_components(fps, radius):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (int(fps[i]) ^ int(fps[j])).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("limit", [4, 1024])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, limit):
    monkeypatch.setattr(covering_simhash, "BUCKET_LIMIT", limit)
    rng = np.random.default_rng(5)
    fps = {int(x) for x in rng.integers(0, 2**64, 60, np.uint64)}
    for centre in list(fps)[:6]:
        for _ in range(40):
            near = centre
            for bit in rng.choice(20, 3):
                near ^= 1 << int(bit) * 3
            fps.add(near)
    fps = sorted(fps, key=lambda x: x - 2**64 if x >> 63 else x)
    signed = [x - 2**64 if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    covering_simhash.ensure_checkpoint_dir(spark)
    found = dict(rows_of(components(covering_simhash.near_links(df))))
    expected = [signed[r] for r in plain_components(fps, 3)]
    assert [found.get(x, x) for x in signed] == expected


def test_near_duplicates_with_nulls_and_copies(spark):
    base = " ".join(f"word{i}" for i in range(200))
    texts = [base, base.upper(), base, None, "", " \n", "other text here", base.replace("word77 ", "changed ")]
    rows = [(i or None, t) for i, t in enumerate(texts)] + [(2, base)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash"))
    found = covering_simhash.near_duplicates(df)
    by_id = {(r.doc_id, r.component_id) for r in found.collect()}
    fps = [plain_fingerprint(t) for _, t in rows]
    assert found.count() == len(rows)
    assert {(1, 1), (2, 1), (None, 1), (3, 3), (4, 3), (5, 3), (6, 6)} <= by_id
    assert ((7, 1) in by_id) == ((fps[7] ^ fps[0]).bit_count() <= 3)
    assert covering_simhash.near_duplicates(df.limit(0)).count() == 0


def test_components_of_paths_and_stars(spark):
    covering_simhash.ensure_checkpoint_dir(spark)
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(8, 60)] + [(7, 7), (8, 7)]
    edges = spark.createDataFrame(path + star, "a long, b long")
    found = dict(rows_of(components(edges)))
    assert found == {i: 100 for i in range(101, 161)} | {i: 7 for i in range(8, 60)}
    assert components(edges.limit(0)).count() == 0


@pytest.mark.parametrize("hubs, tile_rows", [(near_copies.HUBS, near_copies.TILE_ROWS), (1, 3)])
def test_one_of_each_group_of_near_copies_stays(spark, monkeypatch, hubs, tile_rows):
    monkeypatch.setattr(near_copies, "HUBS", hubs)
    monkeypatch.setattr(near_copies, "TILE_ROWS", tile_rows)
    rng = np.random.default_rng(9)
    words = [f"w{i}" for i in range(5000)]
    sources = [rng.choice(words, 150).tolist() for _ in range(20)]
    texts = []
    for source in sources:
        texts.append(" ".join(source))
        for _ in range(12):
            copy = list(source)
            for at in rng.choice(150, rng.integers(0, 5), replace=False):
                copy[at] = str(rng.choice(words))
            texts.append(" ".join(copy).capitalize())
    texts += [None, "", "short", "short", "Short", "two words"]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := (t or "").lower().split()) else {()} for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if len(a & b) >= 0.8 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    docs = docs_of(spark, texts)
    kept = near_copies.drop_near_copies(docs)
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(len(texts)) if find(i) == i]
    assert kept.columns == docs.columns
    nulls = docs.limit(1).withColumn("doc_id", F.lit(None).cast("long"))
    assert near_copies.drop_near_copies(docs.union(docs).union(nulls)).count() == kept.count() + 1
    assert near_copies.drop_near_copies(docs.limit(0)).count() == 0


def test_open_pairs_are_all_pairs_outside_one_group(spark, monkeypatch):
    """Rows of one bucket in three groups: every pair across groups that can be similar, once."""
    monkeypatch.setattr(near_copies, "TILE_ROWS", 4)
    rng = np.random.default_rng(4)
    common = rng.integers(1, 1 << 62, 300).astype(np.uint64)
    sets = [np.unique(np.r_[common, rng.integers(1, 1 << 62, n % 70).astype(np.uint64)]) for n in range(0, 600, 17)]
    sets += [rng.integers(1, 1 << 62, 300).astype(np.uint64) for _ in range(5)]
    rows = [
        (n, [1, 2, 3, n, 7 if n % 2 else -n], len(s), near_copies.odd_sketch(s).tolist())
        for n, s in enumerate(sets)
    ]
    texts = spark.createDataFrame(rows, "rep long, bands array<long>, kinds long, odd array<long>")
    texts = texts.withColumn("fp", F.lit(0))
    root = {n: 0 if n < 20 else 20 if n < 26 else n for n in range(len(sets))}
    roots = spark.createDataFrame([(n, r) for n, r in root.items() if n != r], "node long, root long")
    shared = near_copies._shared_buckets(texts)
    found = rows_of(near_copies._open_pairs(shared, texts, roots, 0.8).select("a", "b"))
    assert len(found) == len(set(found))
    similar = set()
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[i + 1 :], i + 1):
            both = len(np.intersect1d(x, y))
            if root[i] != root[j] and both >= 0.8 * (len(x) + len(y) - both):
                similar.add((i, j))
    assert similar <= {tuple(p) for p in found}
    assert all(root[a] != root[b] and a < b for a, b in found)
    assert not any(b >= len(sets) - 5 for _, b in found)


def test_one_common_band_is_enough(spark):
    """Isolated similar pairs with one, two and three bands in common all come out of the second pass."""
    rng = np.random.default_rng(6)
    rows = []
    for pair, common in enumerate((1, 2, 3, 0)):
        whole = np.unique(rng.integers(1, 1 << 62, 400).astype(np.uint64))
        for n in (0, 1):
            node = 2 * pair + n
            bands = [10 * pair + b if b >= 5 - common else 100 + 10 * node + b for b in range(5)]
            part = whole[n * 20 : n * 20 + 380]
            rows.append((node, bands, len(part), near_copies.odd_sketch(part).tolist()))
    texts = spark.createDataFrame(rows, "rep long, bands array<long>, kinds long, odd array<long>")
    texts = texts.withColumn("fp", F.lit(0))
    roots = spark.createDataFrame([], "node long, root long")
    shared = near_copies._shared_buckets(texts)
    found = rows_of(near_copies._open_pairs(shared, texts, roots, 0.8).select("a", "b"))
    assert sorted(found) == [(0, 1), (2, 3), (4, 5)]


# -- language and quality -------------------------------------------------


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SAMPLE_FOLDER}/documents.parquet")
    model = hd_language.learn(docs.where(~hd_language.held_out(F.col("doc_id"))))
    rows = hd_language.identify(docs, model).where(hd_language.held_out(F.col("doc_id"))).collect()
    right = sum(r.lang == r.lang_pred for r in rows)
    assert right / len(rows) > 0.98 and all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_texts(spark):
    texts = ["the house is there", "das haus ist dort", None, "", "123 !?", "the " * 300_000, "ß", "漢字 " * 900]
    docs = docs_of(spark, texts, ["en", "de", None, "en", "en", None, None, None]).withColumn("lang_pred", F.lit(1))
    found = {r.doc_id: (r.lang_pred, r.score) for r in hd_language.identify(docs, hd_language.learn(docs)).collect()}
    assert found[0][0] == "en" and found[1][0] == "de" and found[5][0] == "en"
    assert found[2] == found[3] == found[4] == ("und", 0.0)
    nothing = hd_language.learn(docs.limit(0))
    assert {r.lang_pred for r in hd_language.identify(docs, nothing).collect()} == {"und"}
    assert hd_language.identify(docs.limit(0), nothing).count() == 0


def test_letters_are_marked_without_any_language(spark):
    docs = docs_of(spark, ["some words", None, "", "12 !?", "漢"], ["und", None, None, "und", None])
    for given in (docs, docs.limit(0)):
        found = hd_language.identify(docs, hd_language.learn(given), lettered=True).collect()
        assert {r.doc_id: r.lettered for r in found} == {0: True, 1: False, 2: False, 3: False, 4: True}
        assert {r.lang_pred for r in found} == {"und"}


def test_bundles_add_up_n_grams():
    out = hd_language.bundles(["abc", "", "Ab c"])
    v = {c: hd_language._letter_vector(ord(c)).astype(int) for c in " abc"}
    gram = lambda x, y, z: np.roll(v[x], 2) * np.roll(v[y], 1) * v[z]
    assert (out[0] == gram(" ", "a", "b") + gram("a", "b", "c") + gram("b", "c", " ")).all()
    assert not out[1].any()


def test_pieces_of_long_texts_bundle_alike(monkeypatch):
    text = "some words are here and there " * 40
    whole = hd_language.bundles([text, "x"])
    monkeypatch.setattr(hd_language, "PIECE_CHARS", 100)
    assert (hd_language.bundles([text, "x"]) == whole).all()


def test_quality_on_labelled_documents_not_trained_on(spark):
    docs = spark.read.parquet(f"{SAMPLE_FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{SAMPLE_FOLDER}/labels.parquet")
    seen = labels.where("doc_id % 2 = 0")
    model = cotraining.learn(docs, seen)
    scored = cotraining.score(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id")
    rows = scored.select("quality", "keep").collect()
    assert sum(bool(r.quality) == r.keep for r in rows) / len(rows) > 0.95


def test_quality_without_labels_and_with_odd_rows(spark):
    docs = docs_of(spark, ["fine words here", None, "", "x " * 200_000], [None, "en", "de", "fr"])
    labels = spark.createDataFrame([(0, 1, 0), (None, 0, 0), (9, None, 1)], "doc_id long, quality int, toxic int")
    for given in (labels, labels.limit(0)):
        rows = cotraining.score(docs, cotraining.learn(docs, given)).collect()
        assert len(rows) == 4 and all(r.keep and r.score is None for r in rows)
    both = labels.union(spark.createDataFrame([(3, 0, 0), (3, 0, 0)], labels.schema))
    rows = cotraining.score(docs.union(docs), cotraining.learn(docs, both)).collect()
    assert len(rows) == 8 and all(0 <= r.score <= 1 for r in rows)
    assert cotraining.score(docs.limit(0), cotraining.learn(docs.limit(0), both)).count() == 0
