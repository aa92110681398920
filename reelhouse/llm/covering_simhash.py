"""Near-duplicates by SimHash and covering locality-sensitive hashing.

For radius r every bit of a fingerprint gets a non-zero code of r + 1 bits. The mask of a
non-zero vector v keeps the bits whose code has an odd product with v. The codes of r differing
bits span at most r dimensions, so some v is orthogonal to all of them: its mask drops just bits
that may differ, and the two fingerprints fall into one bucket of that table. No pair within the
radius is missed, with 2**(r + 1) - 1 tables that each keep about half of the bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.components import components, shuffled
from reelhouse.session import ensure_checkpoint_dir

BITS = 64
#: A bucket above this size is split by a second family of masks over the bits it leaves open.
BUCKET_LIMIT = 1_024
SHINGLE_CHUNK = 1 << 16
BATCH_ROWS = 1_024

# Each byte of a hash as eight lanes of one bit, so that a sum counts eight bits at once.
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
_LANES = np.ascontiguousarray(_LANES).view(np.uint64).ravel()


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each bit set, the lowest bit first."""
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 255):
        lanes = _LANES[hashes[at : at + 255].view(np.uint8).reshape(-1, 8)].sum(axis=0)
        counts += lanes.view(np.uint8)
    return counts


def shingle_hashes(text: str | None, words: int = 3, seed: int = 42) -> np.ndarray:
    """XXH64 of every shingle of ``words`` words, repeats included, as unsigned numbers.

    A-Z are lower-cased, words are runs without ASCII white space. A text of fewer words is one
    shingle, a text without words has none.
    """
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    joined, digest = b" ".join(tokens), xxhash.xxh64_intdigest
    if len(tokens) < words:
        return np.array([digest(joined, seed)], np.uint64)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.r_[0, ends[:-1] + 1][: len(tokens) - words + 1]
    ends = ends[words - 1 :]
    parts = []
    for at in range(0, len(starts), SHINGLE_CHUNK):
        spans = zip(starts[at : at + SHINGLE_CHUNK].tolist(), ends[at : at + SHINGLE_CHUNK].tolist())
        parts.append(np.array([digest(joined[a:b], seed) for a, b in spans], np.uint64))
    return np.concatenate(parts)


def simhash(hashes: np.ndarray) -> int:
    """Unsigned SimHash: a bit is set if more than half of the hashes have it; 0 of none."""
    set_bits = (2 * _bit_counts(hashes) > len(hashes)).astype(np.uint8)
    return int(np.packbits(set_bits, bitorder="little").view(np.uint64)[0]) if len(hashes) else 0


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    return simhash(shingle_hashes(text, words, seed))


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp) of every row; ``fp`` is the fingerprint as a signed long. Null texts are empty."""
    out = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                found = [fingerprint(t, words, seed) for t in part.column(1).to_pylist()]
                fps = np.array(found, np.uint64).view(np.int64)
                yield pa.record_batch([part.column(0), pa.array(fps)], schema=out)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, fp long")


def covering_masks(radius: int, bits: list[int] | None = None) -> list[int]:
    """Masks over ``bits`` (all 64 by default) such that each ``radius`` of them miss some mask."""
    bits = list(range(BITS)) if bits is None else bits
    codes = 2 ** (radius + 1) - 1
    return [
        sum(1 << bit for n, bit in enumerate(bits) if (n % codes + 1 & v).bit_count() % 2)
        for v in range(1, codes + 1)
    ]


def finer_masks(radius: int) -> list[list[int]]:
    """For each mask the masks that keep its bits and cover the bits it leaves open."""
    out = []
    for mask in covering_masks(radius):
        still_open = [b for b in range(BITS) if not mask >> b & 1]
        out.append([mask | finer for finer in covering_masks(radius, still_open)])
    return out


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least linked item of each of ``n`` items."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return root


def _link_small(bucket: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of all pairs within the radius; ``bucket`` is sorted."""
    left, right = [], []
    here = np.arange(len(fps))
    step = 0
    while len(here):
        step += 1
        here = here[here + step < len(fps)]
        here = here[bucket[here] == bucket[here + step]]
        near = here[np.bitwise_count(fps[here] ^ fps[here + step]) <= radius]
        left.append(near)
        right.append(near + step)
    a, b = np.concatenate(left or [here]), np.concatenate(right or [here])
    root = _roots(len(fps), a, b)
    linked = np.flatnonzero(root != np.arange(len(fps)))
    return fps[linked], fps[root[linked]]


def _link_large(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for one bucket, row by row. Each row links to all it is near to."""
    root = np.arange(len(fps))
    for i in range(len(fps) - 1):
        near = i + np.flatnonzero(np.bitwise_count(fps[i:] ^ fps[i]) <= radius)
        roots = np.unique(root[near])
        if len(roots) > 1:
            root[np.isin(root, roots)] = roots[0]
    linked = np.flatnonzero(root != np.arange(len(fps)))
    return fps[linked], fps[root[linked]]


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("open_table", pa.int32())])


def _links(rows: DataFrame, radius: int, limit: int | None) -> DataFrame:
    """Links inside the buckets of ``rows`` (table, bucket, fp), or rows of buckets over ``limit``.

    A link is (a, b, null); a row of a large bucket is (fp, null, table).
    """

    def made(a, b):
        a, b = np.asarray(a, np.uint64).view(np.int64), np.asarray(b, np.uint64).view(np.int64)
        return pa.record_batch([pa.array(a), pa.array(b), pa.nulls(len(a), pa.int32())], schema=_LINKS)

    def left_open(table, fps):
        columns = [pa.array(fps.view(np.int64)), pa.nulls(len(fps), pa.int64())]
        return pa.record_batch([*columns, pa.array(np.full(len(fps), table, np.int32))], schema=_LINKS)

    def run(batches):
        table, bucket, fps = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.uint64)
        skipping = None  # the large bucket whose rows are being passed on
        for batch in batches:
            table = np.r_[table, batch.column(0).to_numpy()]
            bucket = np.r_[bucket, batch.column(1).to_numpy()]
            fps = np.r_[fps, batch.column(2).to_numpy().view(np.uint64)]
            last = (table == table[-1]) & (bucket == bucket[-1])
            whole = int(len(last) - last.sum())
            if whole:
                yield from closed(table[:whole], bucket[:whole], fps[:whole], skipping)
                table, bucket, fps = table[whole:], bucket[whole:], fps[whole:]
            key = (table[0], bucket[0])
            if limit and (len(fps) > limit or key == skipping):
                skipping = key
                yield left_open(table[0], fps)
                table, bucket, fps = table[:0], bucket[:0], fps[:0]
        if len(fps):
            yield from closed(table, bucket, fps, skipping)

    def closed(table, bucket, fps, skipping):
        """Links of complete buckets, many small ones at a time."""
        new = np.r_[True, (table[1:] != table[:-1]) | (bucket[1:] != bucket[:-1])]
        starts = np.r_[np.flatnonzero(new), len(fps)]
        sizes = np.diff(starts)
        number = np.repeat(np.arange(len(sizes)), sizes)
        large = sizes > BUCKET_LIMIT
        if skipping is not None:
            large |= (table[starts[:-1]] == skipping[0]) & (bucket[starts[:-1]] == skipping[1])
        for n in np.flatnonzero(large):
            part = slice(starts[n], starts[n + 1])
            yield left_open(table[part][0], fps[part]) if limit else made(*_link_large(fps[part], radius))
        small = ~large[number] & (sizes > 1)[number]
        yield made(*_link_small(number[small], fps[small], radius))

    dealt = rows.repartition("table", "bucket").sortWithinPartitions("table", "bucket")
    return dealt.mapInArrow(run, "a long, b long, open_table int")


def near_links(distinct: DataFrame, radius: int = 3) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints ``fp`` within ``radius`` of each other.

    Not all pairs: inside a bucket each fingerprint links to the least one it is connected with.
    A bucket above BUCKET_LIMIT is passed on, split by the second family of masks, and searched in
    full there. For radius 3 that family fixes at least 48 of 64 bits, which bounds a bucket by the
    2**16 values of the others, whatever the data.
    """
    masks, finer = covering_masks(radius), finer_masks(radius)
    fp = F.col("fp")
    keyed = lambda t, m: F.struct(
        F.lit(t).alias("table"), fp.bitwiseAND(F.lit(_signed(m))).alias("bucket")
    )
    tables = F.explode(F.array(*[keyed(t, m) for t, m in enumerate(masks)]))
    rows = distinct.select(tables.alias("k"), "fp").select("k.table", "k.bucket", "fp")
    first = _links(rows, radius, BUCKET_LIMIT).checkpoint()
    # The second family: its tables are numbered on from those of the first.
    by_table = [
        F.array(*[keyed(t * len(f) + n, m) for n, m in enumerate(f)]) for t, f in enumerate(finer)
    ]
    table = F.element_at(F.array(*by_table), F.col("open_table") + 1)
    left = first.where("open_table is not null").select(F.col("a").alias("fp"), "open_table")
    split = left.select(F.explode(table).alias("k"), "fp").select("k.table", "k.bucket", "fp")
    links = first.where("open_table is null")
    return links.union(_links(split, radius, None)).select("a", "b")


def near_duplicates(
    docs: DataFrame, words: int = 3, radius: int = 3, seed: int = 42
) -> DataFrame:
    """Every row's fingerprint and component: doc_id, fp (signed long), component_id.

    Rows link if their fingerprints differ in at most ``radius`` bits; component_id is the smallest
    doc_id that a row reaches, itself included. Copies share a fingerprint and are compared once.
    A null or wordless text has fingerprint 0 and links like any other. A null doc_id takes part
    but names no component; a component without any id has a null one. Repeated rows stay.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    marked = fingerprints(docs, words, seed).checkpoint()
    distinct = marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = components(near_links(distinct.select("fp"), radius))
    rooted = distinct.join(shuffled(roots), distinct["fp"] == roots["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    places = rooted.join(named, "root").select("fp", "component_id")
    return marked.join(places, "fp").select("doc_id", "fp", "component_id")
