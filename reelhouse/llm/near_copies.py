"""Groups of texts whose shingle sets are similar, for dropping all but one of each.

SimHash links (``covering_simhash``) give candidates. At five words and a similarity of 0.8, most
pairs differ in more bits than a covering family can afford, so banded minimum hashes add the
others: first pairs with a bucket's best connected rows, then all that are still in different
groups and have any band in common. Every candidate pair is checked on the whole shingle sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from reelhouse.llm.components import components, shuffled
from reelhouse.llm.covering_simhash import near_links, shingle_hashes, simhash
from reelhouse.session import ensure_checkpoint_dir

BANDS = 25
ROWS_PER_BAND = 4
#: Rows of a bucket that all its rows are paired with first.
HUBS = 4
#: Rows of a bucket that are compared with as many others under one key.
TILE_ROWS = 2_048
#: Bands that a first pair has in common at least. At similarity 0.8 a pair shares ten on average and
#: fewer than three once in 3,235 pairs, which the second pass finds.
SHARED_BANDS = 3
#: Bits of a text's odd sketch, in longs.
SKETCH_LONGS = 16
BATCH_ROWS = 1_024
HASH_CHUNK = 4_096
#: A filter of ids: its bits for each id, those of a block, and the most blocks (8 MB).
FILTER_BITS = 32
BLOCK_BITS = 32_768
MOST_BLOCKS = 2_048

_draw = np.random.Generator(np.random.Philox(key=7))
_FACTORS = _draw.integers(0, 1 << 63, BANDS * ROWS_PER_BAND, np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
_SHIFTS = _draw.integers(0, 1 << 63, BANDS * ROWS_PER_BAND, np.uint64)[:, None]


def band_keys(hashes: np.ndarray) -> list[int]:
    """A signed key for each band of minimum hashes; none without a shingle."""
    if not len(hashes):
        return []
    least = np.full(len(_FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), HASH_CHUNK):
        mixed = hashes[None, at : at + HASH_CHUNK] * _FACTORS + _SHIFTS
        least = np.minimum(least, (mixed ^ (mixed >> np.uint64(32))).min(axis=1))
    rows = least.reshape(BANDS, ROWS_PER_BAND)
    return np.array([xxhash.xxh64_intdigest(r.tobytes()) for r in rows], np.uint64).view(np.int64).tolist()


def odd_sketch(hashes: np.ndarray) -> np.ndarray:
    """Each bit: is the number of shingles that fall on it odd? ``hashes`` are distinct.

    The bits in which two sketches differ are at most as many as the shingles that only one text has.
    """
    bits = 64 * SKETCH_LONGS
    odd = np.bincount((hashes % np.uint64(bits)).astype(np.int64), minlength=bits) % 2
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def text_key(text: str | None) -> bytes:
    """128 bits of the words of a text, A-Z lower-cased; a null text has none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return xxhash.xxh3_128_digest(b" ".join(words))


def _keys(texts: list[str | None]) -> pa.Array:
    return pa.array(map(text_key, texts), pa.binary())


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, copy (``text_key``), fp, bands of every row with an id.

    ``kinds`` is the number of different shingles, ``odd`` their odd sketch.
    """
    fields = [("doc_id", pa.int64()), ("copy", pa.binary()), ("fp", pa.int64())]
    longs = pa.list_(pa.int64())
    out = pa.schema([*fields, ("bands", longs), ("kinds", pa.int64()), ("odd", longs)])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                texts = part.column(1).to_pylist()
                fps, bands, kinds, odd = [], [], [], []
                for text in texts:
                    hashes = shingle_hashes(text, words)
                    fps.append(simhash(hashes))
                    different = np.unique(hashes)
                    bands.append(band_keys(different))
                    kinds.append(len(different))
                    odd.append(odd_sketch(different))
                made = [_keys(texts), pa.array(np.array(fps, np.uint64).view(np.int64))]
                made += [pa.array(bands, longs), pa.array(kinds, pa.int64()), pa.array(odd, longs)]
                yield pa.record_batch([part.column(0), *made], schema=out)

    columns = "doc_id long, copy binary, fp long, bands array<long>, kinds long, odd array<long>"
    return _with_id(docs).mapInArrow(run, columns)


def _with_id(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of every row with an id."""
    return docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def _by_ids(docs: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` whose doc_id may be in ``ids``, and the others: none of those is.

    All rows of an id are on one side. Tasks get a bitmap of the hashed ids, of 8 MB at most however
    many there are. So only the first part, in which some rows are not of ``ids``, is left to be
    joined: texts that a few ids do not name are not shuffled. Rows without doc_id are others.
    """
    blocks = min(MOST_BLOCKS, ids.count() * FILTER_BITS // BLOCK_BITS + 1)
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(blocks * BLOCK_BITS))
    block, bit = F.shiftright(place, 15), place.bitwiseAND(BLOCK_BITS - 1)
    listed = ids.select(block.alias("near copies block"), bit.alias("bit")).repartition("near copies block")
    bits = F.bitmap_construct_agg("bit").alias("near copies bits")
    bitmap = listed.groupBy("near copies block").agg(bits).checkpoint()
    octet = F.substring("near copies bits", F.shiftright(bit, 3).cast("int") + 1, F.lit(1))
    is_set = F.getbit(F.conv(F.hex(octet), 16, 10).cast("int"), bit.bitwiseAND(7).cast("int")) == 1
    marked = docs.withColumn("near copies block", block).join(F.broadcast(bitmap), "near copies block", "left")
    marked = marked.withColumn("near copies listed", F.col("doc_id").isNotNull() & F.coalesce(is_set, F.lit(False)))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return tuple(marked.where(F.col("near copies listed") == side).select(*columns) for side in (True, False))


def _distinct_texts(marked: DataFrame) -> DataFrame:
    """One row for each text, with its least doc_id and a number of its own, ``rep``.

    The number is drawn while the rows are stored, so no later step can see another one.
    """
    of_text = [F.first(c).alias(c) for c in ("fp", "bands", "kinds", "odd")]
    texts = marked.groupBy("copy").agg(F.min("doc_id").alias("doc_id"), *of_text)
    return texts.withColumn("rep", F.monotonically_increasing_id()).checkpoint()


def _shared_buckets(texts: DataFrame) -> DataFrame:
    """(band, key, rep, met) of each bucket with ``met`` texts, at least two."""
    buckets = texts.select("rep", F.posexplode("bands").alias("band", "key"))
    sizes = buckets.groupBy("band", "key").agg(F.count("*").alias("met")).where("met > 1")
    return buckets.join(shuffled(sizes), ["band", "key"])


def _hub_pairs(shared: DataFrame) -> DataFrame:
    """First candidate pairs (a, b): those of a bucket's rows with its HUBS best connected rows.

    They meet most others in all their buckets. The source of a group of copies meets more of them
    than any copy does, so most groups come together here; ``_open_pairs`` finds what is left.
    """
    known = shared.groupBy("rep").agg(F.sum("met").alias("met_in_all"))
    order = "row_number() over (partition by band, key order by met_in_all desc, rep)"
    hubs = shared.join(shuffled(known), "rep").withColumn("place", F.expr(order)).where(F.col("place") <= HUBS)
    hubs = hubs.select("band", "key", F.col("rep").alias("hub"))
    met = shared.join(shuffled(hubs), ["band", "key"]).where("rep <> hub")
    pairs = met.select("band", F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b"))
    # Two hubs meet twice in a band. A mask counts it once, and is merged before the only shuffle by pair.
    in_band = F.bit_or(F.expr("shiftleft(1L, band)")).alias("in_band")
    masks = pairs.groupBy("a", "b").agg(in_band)
    return masks.where(F.bit_count("in_band") >= SHARED_BANDS).select("a", "b")


def _open_pairs(
    shared: DataFrame, texts: DataFrame, roots: DataFrame, similarity: float
) -> DataFrame:
    """All pairs (a, b) that share a band and are not in one group of ``roots``.

    Rows of a bucket that are in one group already need no more links. The rest is compared in
    tiles: all rows of the bucket against those outside its largest group. Both are dealt by hash to
    parts of about TILE_ROWS, so a large bucket is spread over many keys. Only rows of such buckets
    get their sketches. A pair whose sizes or sketches rule the similarity out is dropped in the join.
    """
    rooted = shared.join(shuffled(roots), shared["rep"] == roots["node"], "left")
    rooted = rooted.select("band", "key", "rep", F.coalesce("root", "rep").alias("root"))
    groups = rooted.groupBy("band", "key", "root").agg(F.count("*").alias("n"))
    largest = F.max(F.struct("n", "root"))
    buckets = groups.groupBy("band", "key").agg(largest.alias("main"), F.sum("n").alias("met"))
    buckets = buckets.where("met > main.n").select(
        "band",
        "key",
        F.col("main.root").alias("main"),
        F.ceil(F.col("met") / TILE_ROWS).alias("left_tiles"),
        F.ceil((F.col("met") - F.col("main.n")) / TILE_ROWS).alias("right_tiles"),
    )
    open_rows = rooted.join(shuffled(buckets), ["band", "key"]).checkpoint()
    rows = open_rows.join(shuffled(texts.select("rep", "kinds", "odd")), "rep")

    def side(name: str, own: str, other: str) -> DataFrame:
        """Every row in its own tile, once for each tile of the other side."""
        dealt = F.pmod(F.xxhash64("rep"), F.col(f"{own}_tiles")).alias(f"{own}_tile")
        copies = F.explode(F.sequence(F.lit(0), F.col(f"{other}_tiles") - 1)).alias(f"{other}_tile")
        columns = [F.col(c).alias(f"{name}_{c}") for c in ("rep", "root", "kinds", "odd")]
        return rows.select("band", "key", "main", dealt, copies, *columns)

    right = side("b", "right", "left").where("b_root <> main").drop("main")
    met = side("a", "left", "right").join(shuffled(right), ["band", "key", "left_tile", "right_tile"])
    # Sets of a shingles in all, d of them in one set only, have a similarity of (a - d) / (a + d).
    differing = [
        F.bit_count(F.col("a_odd")[i].bitwiseXOR(F.col("b_odd")[i])) for i in range(SKETCH_LONGS)
    ]
    most_differing = (F.col("a_kinds") + F.col("b_kinds")) * (1 - similarity) / (1 + similarity)
    found = met.where(
        (F.col("a_root") != F.col("b_root"))
        & ((F.col("a_root") == F.col("main")) | (F.col("a_root") < F.col("b_root")))
        & (F.least("a_kinds", "b_kinds") >= F.greatest("a_kinds", "b_kinds") * similarity - 1e-6)
        & (sum(differing) <= most_differing + 1e-6)
    )
    pairs = found.select(F.least("a_rep", "b_rep").alias("a"), F.greatest("a_rep", "b_rep").alias("b"))
    return pairs.distinct()


def _simhash_pairs(texts: DataFrame, radius: int) -> DataFrame:
    """Candidate pairs of texts whose fingerprints are linked or equal."""
    first = texts.groupBy("fp").agg(F.min("rep").alias("first"))
    equal = texts.join(shuffled(first), "fp").select(F.col("first").alias("a"), F.col("rep").alias("b"))
    links = near_links(first.select("fp"), radius)
    ends = [first.select(F.col("fp").alias(c), F.col("first").alias(f"{c}_rep")) for c in "ab"]
    linked = links.join(shuffled(ends[0]), "a").join(shuffled(ends[1]), "b")
    far = linked.select(F.least("a_rep", "b_rep").alias("a"), F.greatest("a_rep", "b_rep").alias("b"))
    return equal.where("a <> b").union(far)


def _similar(
    pairs: DataFrame, docs: DataFrame, texts: DataFrame, words: int, similarity: float
) -> DataFrame:
    """The pairs whose shingle sets have a Jaccard similarity of at least ``similarity``."""
    ends = pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "rep")
    needed = texts.select("rep", "doc_id", "copy").join(shuffled(ends), "rep", "left_semi").checkpoint()
    ids = needed.select("doc_id").distinct()
    rows = _by_ids(_with_id(docs), ids)[0].join(shuffled(ids), "doc_id", "left_semi")
    out = pa.schema([("doc_id", pa.int64()), ("copy", pa.binary()), ("shingles", pa.list_(pa.int64()))])

    def shingle(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                texts = part.column(1).to_pylist()
                sets = [np.unique(shingle_hashes(t, words)).view(np.int64) for t in texts]
                yield pa.record_batch([part.column(0), _keys(texts), pa.array(sets, out[2].type)], schema=out)

    made = rows.mapInArrow(shingle, "doc_id long, copy binary, shingles array<long>")
    # A row that is there several times gives its set once.
    sets = made.join(shuffled(needed), ["doc_id", "copy"]).select("rep", "shingles")
    sets = sets.dropDuplicates(["rep"]).checkpoint()
    sides = [sets.select(F.col("rep").alias(c), F.col("shingles").alias(f"{c}_set")) for c in "ab"]
    sized = pairs.join(shuffled(sides[0]), "a").join(shuffled(sides[1]), "b")
    # The sizes alone rule some pairs out.
    least, most = (f(F.size("a_set"), F.size("b_set")) for f in (F.least, F.greatest))
    possible = sized.where(least >= F.lit(similarity) * most)

    def check(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("a_set"), batch.column("b_set")):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(common >= similarity * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return possible.mapInArrow(check, "a long, b long")


def _losers(links: DataFrame, texts: DataFrame) -> DataFrame:
    """``rep`` of every linked text but the one of each group with the least doc_id, then key."""
    found = components(links)
    roots = found.select(F.col("root").alias("node"), "root").distinct()
    members = found.union(roots).withColumnRenamed("node", "rep")
    named = members.join(shuffled(texts.select("rep", "doc_id", "copy")), "rep")
    by_id = F.struct("doc_id", "copy", "rep")
    first = named.groupBy("root").agg(F.min(by_id).alias("first")).select(F.col("first.rep").alias("rep"))
    return members.select("rep").join(shuffled(first), "rep", "left_anti")


def _rows_of(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """One row of ``docs`` for each (doc_id, copy) of ``kept``, where ids repeat.

    Of rows with the same id and words the first by the hash of all columns is taken.
    """
    added = [StructField("near copies key", BinaryType()), StructField("near copies order", LongType())]
    schema = StructType([*docs.schema, *added])
    out = to_arrow_schema(schema)

    def keyed(batches):
        for batch in batches:
            keys = _keys(batch.column("text").to_pylist())
            columns = [*batch.columns[:-1], keys, batch.columns[-1]]
            yield pa.record_batch([c.cast(f.type) for c, f in zip(columns, out)], schema=out)

    ids = kept.select(F.col("doc_id").alias("near copies id")).distinct()
    rows = docs.join(ids, docs["doc_id"] == ids["near copies id"], "left_semi")
    rows = rows.withColumn("near copies order", F.xxhash64(F.to_json(F.struct("*"))))
    wanted = kept.select(F.col("doc_id").alias("near copies id"), F.col("copy").alias("near copies kept"))
    same = (F.col("doc_id") == F.col("near copies id")) & (F.col("near copies key") == F.col("near copies kept"))
    place = F.expr("row_number() over (partition by doc_id, `near copies key` order by `near copies order`)")
    found = rows.mapInArrow(keyed, schema).join(wanted, same, "left_semi")
    found = found.withColumn("near copies place", place).where("`near copies place` = 1")
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_copies(
    docs: DataFrame, words: int = 5, similarity: float = 0.8, radius: int = 3
) -> DataFrame:
    """One row of each group of near copies: the one with the smallest doc_id. All columns stay.

    Texts link if they are the same but for A-Z and white space, or if their sets of ``words``-word
    shingles have a Jaccard similarity of at least ``similarity``; groups are what links connect.
    Null, empty and wordless texts are copies of each other. Rows without doc_id take no part and
    stay. An id that repeats with another text links nothing: its texts are grouped each by itself,
    and each group keeps a row. Of a group's texts with one smallest doc_id the one with the smallest
    key stays, of repeated rows one. Other columns are neither read nor changed.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    marked = sketches(docs, words).checkpoint()
    texts = _distinct_texts(marked)
    shared = _shared_buckets(texts).checkpoint()
    pairs = _hub_pairs(shared).union(_simhash_pairs(texts, radius)).distinct().checkpoint()
    links = _similar(pairs, docs, texts, words, similarity).checkpoint()
    left_open = _open_pairs(shared, texts, components(links), similarity)
    left_open = left_open.join(shuffled(pairs), ["a", "b"], "left_anti").checkpoint()
    links = links.union(_similar(left_open, docs, texts, words, similarity)).checkpoint()
    kept = texts.select("rep", "doc_id", "copy").join(shuffled(_losers(links, texts)), "rep", "left_anti")
    kept = kept.checkpoint()
    # An id that is there once and kept keeps its row. Only rows of the others are shuffled.
    stays = kept.select("doc_id", F.lit(True).alias("stays")).distinct()
    times = marked.groupBy("doc_id").agg(F.count("*").alias("n"))
    unsure = times.join(shuffled(stays), "doc_id", "left").where("n > 1 or stays is null").checkpoint()
    looked_up, others = _by_ids(docs, unsure)
    if unsure.where("n > 1").isEmpty():
        kept = kept.select(F.col("doc_id").alias("_kept_id"))
        rows = looked_up.join(shuffled(kept), looked_up["doc_id"] == kept["_kept_id"], "left_semi")
    else:
        rows = _rows_of(looked_up, kept)
    return rows.unionByName(others)
