import math
import struct
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reelhouse.llm import hash_tree_shards as shards
from reelhouse.llm import vector_packing as packing

WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "The cat sat on the mat. It's 12 o'clock!", "", None, "ÀÉÎ straße ﬁne Ⅳ 漢字 😀", "word " * 9000,
    "x" * 5000, "same text", "same text", "tabs\tand\u3000wide\x85spaces\x1cnot", "İstanbul ΟΔΟΣ",
    "<|endoftext|> don't", "e\u0301 combining",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD_FILE)


@pytest.fixture(scope="module")
def own():
    with open(WORD_FILE, encoding="utf-8") as file:
        return packing.WordTokenizer(file.read())


def test_chunks_give_the_ids_of_whole_texts(library, own):
    for text in filter(None, TEXTS):
        ids = np.frombuffer(own.encode(text), "<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("aZé ß'.,!\n\tst19漢İΣ\u0301\u00a0\x1c<|>")), max_size=30))
def test_any_text_gives_the_librarys_ids(library, own, text):
    ids = np.frombuffer(own.encode(text), "<u4").tolist()
    assert ids == library.encode(text, add_special_tokens=False).ids


def documents(spark, texts):
    rows = [(i, t, "en", 0, "s") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, size int, shard string")


def test_pieces_hold_all_ids_and_sequences_have_no_gaps(spark, library):
    pieces = packing.token_pieces(documents(spark, TEXTS), WORD_FILE, max_tokens=64)
    limits = packing.Capacities(tokens=64, documents=64, attention=64**2)
    rows = packing.pack(pieces, len(TEXTS), limits, group_documents=4).collect()
    for doc, text in enumerate(TEXTS):
        own = sorted((r for r in rows if r.doc_id == doc), key=lambda r: r.piece)
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        assert b"".join(r.ids for r in own) == struct.pack(f"<{len(ids)}I", *ids)
        assert [r.start for r in own] == list(range(0, len(ids), 64))
        assert all(r.length == len(r.ids) // 4 for r in own)
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for spans in places.values():
        spans.sort()
        assert [o for o, _ in spans] == [sum(n for _, n in spans[:i]) for i in range(len(spans))]
        assert sum(n for _, n in spans) <= 64


def test_packing_of_an_empty_table(spark):
    pieces = packing.token_pieces(documents(spark, TEXTS).limit(0), WORD_FILE)
    assert packing.pack(pieces, 0).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
@settings(max_examples=60, deadline=None)
@given(lengths=st.lists(st.integers(1, 40), max_size=60), documents=st.integers(1, 6))
def test_best_fit_keeps_every_capacity(rule, lengths, documents):
    limits = packing.Capacities(tokens=40, documents=documents, attention=1600)
    sequence, offset = packing.best_fit(np.array(lengths, int), limits, rule=rule)
    for s in set(sequence.tolist()):
        inside = np.flatnonzero(sequence == s)
        sizes = np.array(lengths)[inside]
        assert sizes.sum() <= 40 and len(sizes) <= documents and (sizes**2).sum() <= 1600
        spans = sorted(zip(offset[inside].tolist(), sizes.tolist()))
        assert [o for o, _ in spans] == np.r_[0, np.cumsum([n for _, n in spans])[:-1]].tolist()


def test_best_fit_is_near_the_least_number():
    lengths = np.random.default_rng(1).integers(1, 2000, 4000)
    sequence, _ = packing.best_fit(lengths)
    assert sequence.max() + 1 <= math.ceil(lengths.sum() / 4096) + 2
    tight, _ = packing.best_fit(lengths, packing.Capacities(documents=2))
    assert tight.max() + 1 >= 2000


def test_a_piece_above_the_limit_is_refused():
    with pytest.raises(ValueError):
        packing.best_fit(np.array([41]), packing.Capacities(tokens=40))


def _plain_descent(doc_id, tree):
    """Region, rack and shard, one draw after the other."""

    def drawn(level, weights):
        def arrival(node):
            h = 42 if doc_id is None else xxhash.xxh64_intdigest(struct.pack("<q", doc_id), 42)
            for value in (level, node):
                h = xxhash.xxh64_intdigest(struct.pack("<q", value), h)
            return -math.log(((h >> 11) + 0.5) / 2**53) / weights[node]

        return min(sorted(weights), key=arrival)

    def below(*path):
        out = defaultdict(float)
        for nodes, weight in tree.items():
            if nodes[: len(path)] == path:
                out[nodes[len(path)]] += weight
        return out

    region = drawn(0, below())
    rack = drawn(1, below(region))
    return region, rack, drawn(2, below(region, rack))


def test_shards_slots_and_growth(spark):
    texts = TEXTS + [f"text {i}" for i in range(3000)]
    docs = documents(spark, texts)
    tree, grown = shards.even_tree(24), shards.even_tree(25)
    rows = shards.shard_documents(docs, tree, grown).collect()
    assert len(rows) == len(texts)
    slots = defaultdict(list)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 8, zlib.crc32(raw), "key")
        assert (r.region, r.rack, r.shard) == _plain_descent(r.doc_id, tree)
        assert r.grown_shard == _plain_descent(r.doc_id, grown)[2] and r.grown_shard in (r.shard, 24)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert 0.02 < sum(r.grown_shard == 24 for r in rows) / len(rows) < 0.07


def test_slots_over_many_buckets_and_repeated_rows(spark):
    rows = [(i % 50 or None, 8, 0, i % 3) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, size long, text_crc32 long, shard int")
    found = shards.number_slots(df, 600, 3, rows_per_bucket=20).collect()
    for s in range(3):
        assert sorted(r.slot for r in found if r.shard == s) == list(range(200))


def test_null_and_repeated_ids_and_no_rows(spark):
    docs = documents(spark, ["a", None, "", "b" * 9]).selectExpr("cast(null as long) as doc_id", "text", "lang", "shard")
    tree, grown = shards.even_tree(24), shards.even_tree(25)
    rows = shards.shard_documents(docs.union(docs), tree, grown).collect()
    assert {(r.region, r.rack, r.shard) for r in rows} == {_plain_descent(None, tree)}
    assert sorted(r.slot for r in rows) == list(range(8)) and sorted({r["size"] for r in rows}) == [8, 9, 17]
    assert shards.shard_documents(docs.limit(0), tree, grown).count() == 0


def test_slots_of_one_hot_id_are_spread(spark):
    rows = spark.range(0, 6000, 1, 6).selectExpr("7L as doc_id", "8L as size", "1L as text_crc32", "0 as shard")
    found = shards.number_slots(rows, 6000, 1, rows_per_bucket=500)
    assert sorted(r.slot for r in found.collect()) == list(range(6000))


def test_only_changed_subtrees_move(spark):
    """One heavier shard draws rows into its own region, rack and shard; no other subtree changes inside."""
    tree = {(g, r, 4 * g + 2 * r + s): 1.0 + s for g in range(2) for r in range(2) for s in range(2)}
    heavier = tree | {(1, 1, 6): 3.0}
    ids = spark.range(4000)
    both = shards.descend(ids, "id", tree, ("g", "r", "s"))
    rows = shards.descend(both, "id", heavier, ("g2", "r2", "s2")).collect()
    assert any(r.s != r.s2 for r in rows)
    for r in rows:
        if r.g != r.g2:
            assert r.g2 == 1
        elif r.r != r.r2:
            assert (r.g2, r.r2) == (1, 1)
        elif r.s != r.s2:
            assert r.s2 == 6
    for column, share in (("s", tree), ("s2", heavier)):
        for (_, _, shard), weight in share.items():
            assert abs(sum(r[column] == shard for r in rows) / 4000 - weight / sum(share.values())) < 0.03
