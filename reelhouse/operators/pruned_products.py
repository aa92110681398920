"""Exact top lists of inner products without multiplying every pair.

Items are ordered by the length of their vector and cut into blocks; each block knows its largest
length and the least and greatest value of every component. By Cauchy-Schwarz no product of a block
exceeds the user's length times the block's, and none exceeds the sum of each component's best end.
A user goes through the blocks in order and multiplies only those whose bound reaches the score in
last place so far; once the lengths alone rule a block out, they rule out all that follow.

Users are dealt to groups of bounded size. Each group gets a copy of the items by shuffle, longest
first, and its task takes them in chunks as they arrive: nothing passes through the driver, and a task
holds one group and one chunk. A group is done with its items once lengths rule out the rest for all.

``beaten_places`` holds given lists against a scan of all pairs, dealt in the same way.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_ITEMS = 256
#: Users that are multiplied by a block at once: 1 MB of products, which a core's cache holds.
BATCH_USERS = 512
#: Blocks whose bounds are worked out together.
BOUND_BLOCKS = 64
#: Items that are multiplied together: at 100 doubles each, about 13 MB.
CHUNK_ITEMS = 1 << 14
#: Vectors and lists of one group of users.
GROUP_BYTES = 128 * 1024**2
#: A group smaller than this is not worth a copy of the items.
GROUP_USERS = 1_024
#: Share that covers the rounding of a bound.
SLACK = 1e-9
#: The id of a free place in a list.
FREE = np.iinfo(np.int64).max
_STATE = "user long, items array<long>, scores array<double>, multiplied long"
#: Users and items of a scan's tile, and tiles that are made together: 0.5 MB, which a core's cache
#: holds. BLAS has faster code for products of less than a million multiplications.
SCAN_USERS, SCAN_ITEMS, SCAN_TILES = 512, 64, 4
#: Products that are checked again together, and one tile's more at most.
SCAN_HITS = 1 << 16
_PLACES = "user long, listed int, beaten int"


class Blocks:
    """A chunk of items, longest first, with the bounds of each block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        length = np.sqrt((vectors**2).sum(axis=1))
        order = np.lexsort((ids, -length))
        self.ids, self.vectors = ids[order], vectors[order]
        starts = np.arange(0, len(ids), BLOCK_ITEMS)
        self.starts, self.longest = starts, length[order][starts]
        self.low = np.minimum.reduceat(self.vectors, starts, axis=0)
        self.high = np.maximum.reduceat(self.vectors, starts, axis=0)
        self.widest = np.maximum(np.abs(self.low), np.abs(self.high)).max(axis=1)

    def bounds(self, users: np.ndarray, first: int, last: int) -> np.ndarray:
        """What no product of a user exceeds in each of the blocks ``first`` to ``last`` - 1."""
        part = slice(first, last)
        best = np.maximum(users, 0) @ self.high[part].T + np.minimum(users, 0) @ self.low[part].T
        return best + SLACK * np.abs(users).sum(axis=1)[:, None] * self.widest[part]

    def block(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.starts[n], self.starts[n] + BLOCK_ITEMS)
        return self.ids[part], self.vectors[part]


def products(users: np.ndarray, items: np.ndarray) -> np.ndarray:
    """All inner products, each summed up component by component from the first on."""
    total = np.zeros((len(users), len(items)))
    for j in range(users.shape[1]):
        total += users[:, j, None] * items[None, :, j]
    return total


def improve(
    users: np.ndarray, blocks: Blocks, k: int, ids: np.ndarray, scores: np.ndarray
) -> np.ndarray:
    """Better the lists ``ids`` and ``scores`` (users x k, best first) in place by ``blocks``.

    Free places hold -inf and the largest id. Returns how many items each user multiplied.
    """
    length = np.sqrt((users**2).sum(axis=1))
    multiplied = np.zeros(len(users), np.int64)
    active = np.arange(len(users))
    for n, longest in enumerate(blocks.longest):
        if n % BOUND_BLOCKS == 0:
            reach = length[active] * longest
            active = active[reach + SLACK * np.abs(reach) >= scores[active, k - 1]]
            if not len(active):
                break
            bounds = blocks.bounds(users[active], n, n + BOUND_BLOCKS)
        # Not "at least": a bound that overflows to no number rules nothing out.
        some = active[~(bounds[:, n % BOUND_BLOCKS] < scores[active, k - 1])]
        if not len(some):
            continue
        item_ids, vectors = blocks.block(n)
        multiplied[some] += len(item_ids)
        least = scores[some, k - 1]
        # A fast product, off by less than the slack, says which are worth the exact one.
        near = users[some] @ vectors.T
        slack = SLACK * longest * length[some]
        near += slack[:, None]
        if k < len(item_ids) and np.isneginf(least).any():
            # The best of the block itself rule out the others while the lists are filling.
            least = np.fmax(least, np.partition(near, -k, axis=1)[:, -k] - 2 * slack)
        row, column = _true_places(~(near < least[:, None]))
        found = _pairwise(users[some], vectors, row, column)
        better = found >= scores[some[row], k - 1]
        row, column, found = row[better], column[better], found[better]
        hit = np.unique(row)
        if not len(hit):
            continue
        # The old lists of users with a hit, and the hits, ordered together.
        number = np.r_[np.repeat(hit, k), row]
        score = np.r_[scores[some[hit]].ravel(), found]
        item = np.r_[ids[some[hit]].ravel(), item_ids[column]]
        order = np.lexsort((item, -score, number))
        number = number[order]
        begin = np.flatnonzero(np.r_[True, number[1:] != number[:-1]])
        first = order[begin[:, None] + np.arange(k)]
        scores[some[hit]], ids[some[hit]] = score[first], item[first]
    return multiplied


def _pairwise(users: np.ndarray, items: np.ndarray, row: np.ndarray, column: np.ndarray) -> np.ndarray:
    """The products of users ``row`` and items ``column``, each summed up as ``products`` does."""
    total = np.zeros(len(row))
    for j in range(users.shape[1]):
        total += users[row, j] * items[column, j]
    return total


class _Group:
    """The lists of a group's users, bettered by chunk after chunk of items."""

    def __init__(self, k: int, chunk_items: int):
        self.k, self.chunk_items = k, chunk_items
        self.waiting, self.held, self.users = [], 0, None

    def _matrix(self) -> tuple[np.ndarray, np.ndarray]:
        rows = pa.Table.from_batches(self.waiting)
        self.waiting, self.held = [], 0
        vectors = rows["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return rows["id"].to_numpy(), vectors.astype(np.float64).reshape(rows.num_rows, -1)

    def _begin(self) -> None:
        self.users, self.vectors = self._matrix() if self.waiting else (np.zeros(0, np.int64), None)
        shape = (len(self.users), self.k)
        self.ids, self.scores = np.full(shape, FREE), np.full(shape, -np.inf)
        self.multiplied = np.zeros(len(self.users), np.int64)

    def _take(self) -> None:
        blocks = Blocks(*self._matrix())
        for at in range(0, len(self.users), BATCH_USERS):
            part = slice(at, at + BATCH_USERS)
            self.multiplied[part] += improve(self.vectors[part], blocks, self.k, self.ids[part], self.scores[part])

    def add(self, rows: pa.RecordBatch, are_items: bool) -> None:
        """Take in users, all of them before the first item, or items."""
        if are_items and self.users is None:
            self._begin()
        for at in range(0, rows.num_rows, self.chunk_items):
            part = rows.slice(at, self.chunk_items)
            self.waiting.append(part)
            self.held += part.num_rows
            if are_items and self.held >= self.chunk_items:
                self._take()

    def lists(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        if self.users is None:
            self._begin()
        elif self.waiting:
            self._take()
        for at in range(0, len(self.users), BATCH_USERS):
            part = slice(at, at + BATCH_USERS)
            filled = self.ids[part] < FREE
            ends = pa.array(np.r_[0, np.cumsum(filled.sum(axis=1))].astype(np.int32))
            picks = [pa.ListArray.from_arrays(ends, pa.array(x[part][filled])) for x in (self.ids, self.scores)]
            columns = [pa.array(self.users[part]), *picks, pa.array(self.multiplied[part])]
            yield pa.record_batch(columns, schema=schema)


def beating(users: np.ndarray, items: np.ndarray, own: np.ndarray, better: np.ndarray) -> None:
    """Add to ``better``, for each user and place, the items whose product is above the score ``own``.

    All pairs are multiplied, in single precision; those that come within its error of the user's least
    score, or above, are multiplied again as ``products`` does.
    """
    length = np.sqrt((users**2).sum(axis=1))
    longest = np.sqrt((items**2).sum(axis=1)).max(initial=0)
    widest = max(length.max(initial=0), longest, length.max(initial=0) * longest)
    kind = np.float32 if widest < np.finfo(np.float32).max / 4 else np.float64
    # The least score is one more component, so that the sum's sign says whether a pair is near it.
    least = own.min(axis=1)
    size = length * longest + np.abs(np.where(np.isinf(least), 0, least))
    least = least - (users.shape[1] + 6) * np.finfo(kind).eps * size
    left = np.c_[users, -least].astype(kind)
    # The longest first, as most pairs near a score are theirs: few tiles hold any.
    items = items[np.argsort(-(items**2).sum(axis=1))]
    tiles = _tiles(np.c_[items, np.ones(len(items))], kind)
    room = _on_a_line((SCAN_TILES, SCAN_USERS, SCAN_ITEMS), kind)
    for at in range(0, len(users), SCAN_USERS):
        part = slice(at, at + SCAN_USERS)
        for row, column in _not_negative(left[part], tiles, len(items), room):
            beats = _pairwise(users[part], items, row, column)[:, None] > own[part][row]
            np.add.at(better[part], row, beats)


def _on_a_line(shape: tuple[int, ...], kind: type) -> np.ndarray:
    """An empty array that begins on a cache line, where products are stored faster."""
    size = math.prod(shape) * np.dtype(kind).itemsize
    room = np.empty(size + 64, np.uint8)
    begin = -room.ctypes.data % 64
    return room[begin : begin + size].view(kind).reshape(shape)


def _tiles(items: np.ndarray, kind: type) -> np.ndarray:
    """The items in tiles of SCAN_ITEMS columns; the last is filled up with the last item."""
    number = math.ceil(len(items) / SCAN_ITEMS)
    filled = np.pad(items, ((0, number * SCAN_ITEMS - len(items)), (0, 0)), "edge")
    tiles = _on_a_line((number, items.shape[1], SCAN_ITEMS), kind)
    tiles[:] = filled.reshape(number, SCAN_ITEMS, -1).swapaxes(1, 2)
    return tiles


def _not_negative(
    left: np.ndarray, tiles: np.ndarray, columns: int, room: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and columns of the products that are not negative, about SCAN_HITS at a time."""
    rows, places, held = [], [], 0
    for first in range(0, len(tiles), SCAN_TILES):
        some = tiles[first : first + SCAN_TILES]
        shape = len(some), len(left), SCAN_ITEMS
        made = room.reshape(-1)[: math.prod(shape)].reshape(shape)
        np.matmul(left, some, out=made)
        for n, highest in enumerate(np.maximum.reduce(made.reshape(len(some), -1), axis=1).tolist()):
            if highest < 0:
                continue
            row, column = _true_places(made[n] >= 0)
            column += (first + n) * SCAN_ITEMS
            known = column < columns
            rows.append(row[known])
            places.append(column[known])
            held += len(row)
            if held >= SCAN_HITS:
                yield np.concatenate(rows), np.concatenate(places)
                rows, places, held = [], [], 0
    if held:
        yield np.concatenate(rows), np.concatenate(places)


def _true_places(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the few true values; eight at a time are looked at where they fit."""
    if matrix.shape[1] % 8:
        return np.nonzero(matrix)
    eight = np.flatnonzero(matrix.view(np.uint64))
    which, place = np.nonzero(matrix.reshape(-1, 8)[eight])
    return np.divmod(eight[which] * 8 + place, matrix.shape[1])


def _lengths(lists: pa.ListArray) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


class _Scan(_Group):
    """How many items beat each place of the given lists of a group's users, over all items."""

    def _begin(self) -> None:
        self.users, self.vectors, self.n_items = np.zeros(0, np.int64), np.zeros((0, 1)), 0
        self.listed, self.strangers = np.zeros(0, np.int64), []
        scores = pa.array([], pa.float64())
        if self.waiting:
            rows = pa.Table.from_batches(self.waiting)
            known = pc.is_valid(rows["vector"])
            self.strangers = rows.filter(pc.invert(known)).select(["id", "scores"]).to_batches()
            self.waiting = rows.filter(known).to_batches()
        if self.waiting:
            column = pa.Table.from_batches(self.waiting)["scores"].combine_chunks()
            self.listed, scores = _lengths(column), pc.list_flatten(column)
            self.users, self.vectors = self._matrix()
        self.places = np.arange(max(self.k, self.listed.max(initial=0)))
        # Any item is better than a place without a score.
        self.own = np.full((len(self.users), len(self.places)), -np.inf)
        self.own[self.places < self.listed[:, None]] = scores.to_numpy(zero_copy_only=False)
        self.own[np.isnan(self.own)] = -np.inf
        self.better = np.zeros(self.own.shape, np.int64)

    def _take(self) -> None:
        ids, items = self._matrix()
        self.n_items += len(ids)
        if len(self.users) and len(ids):
            beating(self.vectors, items, self.own, self.better)

    def lists(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        if self.users is None:
            self._begin()
        elif self.waiting:
            self._take()
        # The first place is beaten by one better item, the second by two; a place beyond all items is one too many.
        beaten = (self.better > self.places) & (self.places < self.k)
        beaten |= (self.places >= min(self.k, self.n_items)) & (self.places < self.listed[:, None])
        for at in range(0, len(self.users), BATCH_USERS):
            part = slice(at, at + BATCH_USERS)
            counts = [x.astype(np.int32) for x in (self.listed[part], beaten[part].sum(axis=1))]
            yield pa.record_batch([pa.array(x) for x in (self.users[part], *counts)], schema=schema)
        for rows in self.strangers:
            listed = pa.array(_lengths(rows["scores"]).astype(np.int32))
            yield pa.record_batch([rows["id"], listed, listed], schema=schema)


def _lists(k: int, chunk_items: int):
    """Top lists of a partition's users."""
    kinds = [("user", pa.int64()), ("items", pa.list_(pa.int64())), ("scores", pa.list_(pa.float64()))]
    return _by_group(lambda: _Group(k, chunk_items), pa.schema([*kinds, ("multiplied", pa.int64())]))


def _places(k: int, chunk_items: int):
    """Beaten places of a partition's users."""
    kinds = [("user", pa.int64()), ("listed", pa.int32()), ("beaten", pa.int32())]
    return _by_group(lambda: _Scan(k, chunk_items), pa.schema(kinds))


def _by_group(new_group: Callable[[], _Group], schema: pa.Schema):
    """What each group of a partition gives; rows come by group, its users first, then items."""

    def run(batches):
        number, group = None, None
        for batch in batches:
            groups = batch.column("group").to_numpy()
            items = batch.column("item").to_numpy(zero_copy_only=False)
            changes = (groups[1:] != groups[:-1]) | (items[1:] != items[:-1])
            edges = np.r_[0, np.flatnonzero(changes) + 1, len(groups)]
            for at, end in zip(edges[:-1], edges[1:]):
                if at == end:
                    continue
                if groups[at] != number:
                    if group:
                        yield from group.lists(schema)
                    number, group = groups[at], new_group()
                group.add(batch.slice(at, end - at), bool(items[at]))
        if group:
            yield from group.lists(schema)

    return run


def _groups(users: DataFrame, k: int) -> int:
    """How many groups of users there are: as many as cores, and as GROUP_BYTES asks for.

    Groups take equally long, so more groups than cores are a multiple of the cores: none idles at the end.
    """
    sizes = users.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("width")).first()
    needed = math.ceil(sizes.n * 8 * ((sizes.width or 0) + 2 * k) / GROUP_BYTES)
    cores = users.sparkSession.sparkContext.defaultParallelism
    if needed > cores:
        return math.ceil(needed / cores) * cores
    return max(needed, min(cores, math.ceil(sizes.n / GROUP_USERS)), 1)


def top_products(
    users: DataFrame, items: DataFrame, k: int = 10, chunk_items: int = CHUNK_ITEMS
) -> DataFrame:
    """Each user's ``k`` items with the largest inner product, and how many were multiplied.

    ``users`` and ``items`` have id and vector, all vectors of one length. Returned are user, items,
    scores (both best first) and multiplied. Ties go to the smaller item; with fewer items than ``k``
    all are listed. Null ids or vectors, and vectors with null or non-finite components, take no part;
    ids must not repeat. Without items every user has empty lists.
    """
    users, items = _usable(users, items)
    groups = _groups(users, k)
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x))
    rows = _dealt(users, items.withColumn("length", length), groups)
    ordered = rows.sortWithinPartitions("group", "item", F.desc("length"), "id")
    return ordered.drop("length").mapInArrow(_lists(k, chunk_items), _STATE)


def beaten_places(
    lists: DataFrame, users: DataFrame, items: DataFrame, k: int = 10, chunk_items: int = CHUNK_ITEMS
) -> DataFrame:
    """How many scores each list has, and how many of its ``k`` places a scan of all pairs beats.

    ``lists`` has user and scores, best first, as ``top_products`` gives them; ``users`` and ``items`` are
    as there. A place is beaten if more items than there are places before it have a product above its
    score, if it has no score though there are items for it, or if there are no items for it. A list of
    no known user has all its places beaten, and so has a user without a list.

    Every user is multiplied by every item, so the work grows with users times items. A task holds one
    group of users with the scores of their lists, and one chunk of items.
    """
    users, items = _usable(users, items)
    groups = _groups(users, k)
    listed = users.join(lists.select(F.col("user").alias("id"), "scores"), "id", "full")
    rows = _dealt(listed, items, groups).sortWithinPartitions("group", "item")
    # Arrow's writer goes back over all nulls of a batch for each null list: items get empty ones.
    rows = rows.withColumn("scores", F.coalesce("scores", F.array().cast("array<double>")))
    return rows.mapInArrow(_places(k, chunk_items), _PLACES)


def _usable(users: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    usable = F.col("id").isNotNull() & F.col("vector").isNotNull() & finite
    # Single precision is sent as it is, and multiplied in double.
    single = all(side.schema["vector"].dataType == T.ArrayType(T.FloatType()) for side in (users, items))
    vector = F.col("vector").cast("array<float>" if single else "array<double>").alias("vector")
    return tuple(side.where(usable).select(F.col("id").cast("long").alias("id"), vector) for side in (users, items))


def _dealt(users: DataFrame, items: DataFrame, groups: int) -> DataFrame:
    """A partition for each group of users, with a copy of the items."""
    number = F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int")
    copy = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    dealt = users.select(number.alias("group"), F.lit(False).alias("item"), "*")
    copies = items.select(copy.alias("group"), F.lit(True).alias("item"), "*")
    return dealt.unionByName(copies, allowMissingColumns=True).repartitionById(groups, "group")
