"""Byte-level BPE: vectorised pre-tokenisation, cached pair merging, decoding.

Texts of a batch are laid end to end as an array of code points. Each code point gets a class
(letter, number, space, other, and a few that look one to three characters ahead). A class is a
transition function on the scanner's states; functions are composed over blocks, block by block
their composition gives the state in which the next block starts, and a last pass marks where
pieces begin. The pieces are the matches of ``public_tokenizers.PATTERN``. Each distinct piece is
merged once and kept in a bounded cache.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

# Letters and numbers of Unicode 16 that Python 3.13's tables, Unicode 15.1, lack.
LETTERS_OF_16 = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3),
    (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389),
    (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
    (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA),
    (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED),
    (0x1E5F0, 0x1E5F0),
]
NUMBERS_OF_16 = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139),
    (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
]
#: Code points of the Unicode property White_Space.
WHITE_SPACE = [
    (0x09, 0x0D), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
    (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
]

# Classes of a character. The last space before a word is apart from other white space, and an
# apostrophe that a contraction may start at knows how many letters that contraction takes.
LETTER, NUMBER, OTHER, SPACE, LAST_BLANK, LAST_SPACE, TAKES_1, TAKES_2, NEW_TEXT = range(9)
# States: what the next character may continue.
NOTHING, LETTERS, NUMBERS, OTHERS, SPACES, BLANK, ONE_MORE, TWO_MORE = range(8)

CHUNK_CHARS = 1 << 19
BATCH_ROWS = 1_024
BLOCK = 64
CACHE_PIECES = 1 << 18
LONG_PIECE = 64
MERGE_ROWS = 8_192


def _class_table() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.array(
        [kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8
    )
    ranges = ((LETTERS_OF_16, LETTER), (NUMBERS_OF_16, NUMBER), (WHITE_SPACE, SPACE))
    for spans, kind in ranges:
        for first, last in spans:
            table[first : last + 1] = kind
    return table


def _transitions() -> tuple[np.ndarray, np.ndarray]:
    """next state[class, state], and whether a piece begins[class, state]."""
    after = np.empty((9, 8), np.uint8)
    begins = np.ones((9, 8), bool)
    after[LETTER], begins[LETTER, [LETTERS, BLANK]] = LETTERS, False
    after[LETTER, [ONE_MORE, TWO_MORE]] = [NOTHING, ONE_MORE]
    begins[LETTER, [ONE_MORE, TWO_MORE]] = False
    after[NUMBER], begins[NUMBER, [NUMBERS, BLANK]] = NUMBERS, False
    after[OTHER], begins[OTHER, [OTHERS, BLANK]] = OTHERS, False
    after[SPACE], begins[SPACE, SPACES] = SPACES, False
    after[LAST_BLANK] = BLANK
    after[LAST_SPACE] = NOTHING
    for kind, state in ((TAKES_1, ONE_MORE), (TAKES_2, TWO_MORE)):
        after[kind] = state
        after[kind, BLANK], begins[kind, BLANK] = OTHERS, False
    # A text ends with a mark that belongs to no piece and is cut off by its caller.
    after[NEW_TEXT] = NOTHING
    return after, begins


AFTER, BEGINS = _transitions()
_TABLE: list[np.ndarray] = []


def _classes(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Class of each character; ``ends`` are the places of the marks that end texts."""
    if not _TABLE:
        _TABLE.append(_class_table())
    kind = _TABLE[0][points]
    kind[ends] = NEW_TEXT
    ahead = np.full(len(kind) + 3, NEW_TEXT, np.uint8)
    ahead[: len(kind)] = kind
    follows = ahead[1 : len(kind) + 1]
    last = (kind == SPACE) & (follows < SPACE)
    quotes = np.flatnonzero((points == ord("'")) & (follows == LETTER))
    out = kind
    out[last] = np.where(points[last] == ord(" "), LAST_BLANK, LAST_SPACE)
    if len(quotes):
        padded = np.r_[points, np.zeros(2, points.dtype)]
        one, two = padded[quotes + 1], padded[quotes + 2]
        is_ = lambda a, c: a == ord(c)
        short = is_(one, "s") | is_(one, "t") | is_(one, "m") | is_(one, "d")
        long = (is_(one, "r") | is_(one, "v")) & is_(two, "e") | is_(one, "l") & is_(two, "l")
        long &= ahead[quotes + 2] == LETTER
        # Inside a run of other characters an apostrophe starts nothing.
        fresh = (quotes == 0) | (kind[quotes - 1] != OTHER)
        out[quotes[short & fresh]] = TAKES_1
        out[quotes[long & fresh]] = TAKES_2
    return out


def piece_starts(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places at which pieces begin, the texts' end marks among them."""
    n = len(points)
    if not n:
        return np.empty(0, np.int64)
    blocks = -(-n // BLOCK)
    kinds = np.full(blocks * BLOCK, NEW_TEXT, np.uint8)
    kinds[:n] = _classes(points, ends)
    kinds = np.ascontiguousarray(kinds.reshape(blocks, BLOCK).T)
    flat = AFTER.ravel()
    # Composition of each block's transition functions, for all states at once.
    whole = np.tile(np.arange(8, dtype=np.uint8), (blocks, 1))
    for column in kinds:
        whole = flat[(column[:, None] << 3) | whole]
    # The functions of doubling runs of blocks, until each reaches back to the start.
    reach = 1
    while reach < blocks:
        whole[reach:] = np.take_along_axis(whole[reach:], whole[:-reach], axis=1)
        reach *= 2
    state = np.r_[np.uint8(NOTHING), whole[:-1, NOTHING]]
    begins = np.empty(kinds.shape, bool)
    for j, column in enumerate(kinds):
        at = (column << 3) | state
        begins[j] = BEGINS.ravel()[at]
        state = flat[at]
    return np.flatnonzero(begins.T.ravel()[:n])


class BytePairs:
    """Pair merging by ranks: the pair of lowest rank first, the leftmost of equals."""

    def __init__(self, rank_file: bytes):
        pairs = (line.split() for line in rank_file.splitlines() if line)
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.none = max(self.tokens) + 1
        self.lengths = np.zeros(self.none, np.int64)
        for rank, token in self.tokens.items():
            self.lengths[rank] = len(token)
        self.bytes_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        # Two tokens merge if their bytes together are a token.
        joins = {}
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                left, right = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if left is not None and right is not None:
                    joins[left * (self.none + 1) + right] = rank
        self.join_keys = np.array(sorted(joins), np.int64)
        self.join_ranks = np.array([joins[k] for k in self.join_keys.tolist()], np.int64)
        self.cache: dict[str, tuple[int, ...]] = {}
        #: Long pieces, which the cache keeps for one batch only.
        self.long: list[str] = []

    def _joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids; ``none`` where they don't merge."""
        keys = left * (self.none + 1) + right
        at = np.minimum(np.searchsorted(self.join_keys, keys), len(self.join_keys) - 1)
        return np.where(self.join_keys[at] == keys, self.join_ranks[at], self.none)

    def merge_short(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Merge many pieces side by side, one pair of each piece at a time.

        The last column of each row is a dead place that both ends of a piece point to.
        """
        n, lengths = len(pieces), np.array([len(p) for p in pieces])
        width = int(lengths.max(initial=0))
        places = np.arange(width)
        ids = np.full((n, width + 1), self.none, np.int64)
        ids[:, :width][places < lengths[:, None]] = self.bytes_ids[
            np.frombuffer(b"".join(pieces), np.uint8)
        ]
        after = np.tile(np.r_[places + 1, width], (n, 1))
        after[np.arange(n), lengths - 1] = width
        before = np.tile(np.r_[width, places], (n, 1))
        rank = np.full((n, width + 1), self.none, np.int64)
        rank[:, :width] = self._joined(ids[:, :width], ids[:, 1:])
        rows = np.arange(n)
        while len(rows):
            at = rank[rows].argmin(axis=1)
            best = rank[rows, at]
            left = best < self.none
            rows, at, best = rows[left], at[left], best[left]
            gone = after[rows, at]
            then, prior = after[rows, gone], before[rows, at]
            ids[rows, at], ids[rows, gone] = best, self.none
            after[rows, at], before[rows, then] = then, at
            rank[rows, gone] = self.none
            rank[rows, at] = self._joined(best, ids[rows, then])
            rank[rows, prior] = self._joined(ids[rows, prior], best)
            rank[rows, width] = self.none
        alive = ids < self.none
        flat, stops = ids[alive].tolist(), np.cumsum(alive.sum(axis=1)).tolist()
        return [tuple(flat[a:b]) for a, b in zip([0, *stops], stops)]

    def merge_long(self, piece: bytes) -> tuple[int, ...]:
        """Merge one piece of any length with a heap of pairs."""
        n, rank = len(piece), self.ranks.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        end, alive = list(range(1, n + 1)), [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if j >= n or end[j] != stop:
                continue
            alive[j], end[i], after[i] = False, stop, after[j]
            if after[i] < n:
                before[after[i]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and (r := rank(piece[left : end[right]])) is not None:
                    heapq.heappush(heap, (r, left, end[right]))
        return tuple(self.ranks[piece[i : end[i]]] for i in range(n) if alive[i])

    def learn(self, pieces: list[str]) -> None:
        """Put new pieces into the cache; a full one starts anew."""
        if len(self.cache) > CACHE_PIECES:
            self.cache.clear()
        new = sorted(set(pieces).difference(self.cache), key=len)
        coded = [p.encode("utf-8") for p in new]
        short = [(p, b) for p, b in zip(new, coded) if len(b) <= LONG_PIECE]
        for at in range(0, len(short), MERGE_ROWS):
            part = short[at : at + MERGE_ROWS]
            self.cache.update(zip([p for p, _ in part], self.merge_short([b for _, b in part])))
        for piece, b in zip(new, coded):
            if len(b) > LONG_PIECE:
                self.cache[piece] = self.merge_long(b)
                self.long.append(piece)

    def encode(self, texts: list[str]) -> Iterator[tuple[list[int], np.ndarray]]:
        """For each text its ids, and the byte at which each id's token begins."""
        joined = "\0".join(texts) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        starts = piece_starts(points, ends)
        cuts = np.r_[starts, len(points)].tolist()
        per_text = np.searchsorted(starts, ends).tolist()
        pieces = [joined[a:b] for a, b in zip(cuts, cuts[1:])]
        for end in reversed(per_text):
            del pieces[end]
        self.learn(pieces)
        begin = 0
        for n, stop in enumerate(per_text):
            ids = list(chain.from_iterable(map(self.cache.__getitem__, pieces[begin : stop - n])))
            yield ids, self.offsets(ids)
            begin = stop - n
        while self.long:
            self.cache.pop(self.long.pop(), None)

    def offsets(self, ids: list[int]) -> np.ndarray:
        lengths = self.lengths[np.array(ids, np.int64)]
        return np.cumsum(lengths) - lengths

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.tokens[i] for i in ids])


_LOADED: dict[int, tuple[bytes, BytePairs]] = {}


def _loaded(ranks) -> BytePairs:
    """One merger for each worker process and vocabulary."""
    key = id(ranks.value)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = (ranks.value, BytePairs(ranks.value))
    return _LOADED[key][1]


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Runs of texts of about CHUNK_CHARS characters; a longer text is a run of its own."""
    begin, chars = 0, 0
    for i, text in enumerate(texts):
        if chars and chars + len(text) > CHUNK_CHARS:
            yield begin, i
            begin, chars = i, 0
        chars += len(text) + 1
    if begin < len(texts):
        yield begin, len(texts)


def read_bytes(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(
    docs: DataFrame, rank_file: str, id_column: str = "doc_id", decoded: bool = False
) -> DataFrame:
    """Every text as ids: (``id_column``, ids array<int>, offsets array<long>).

    ``offsets`` holds the byte of the text at which each id's token begins. With ``decoded``, the
    ids are decoded again by the same worker, into a further binary column. The vocabulary is read
    on the driver, which sends its fixed few hundred kilobytes to each executor once. A null text
    counts as empty and has no ids; other columns are not read; repeated rows stay.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(read_bytes(rank_file))
    rows = docs.select(id_column, "text")
    key = rows.schema[id_column].dataType
    fields = [("key", to_arrow_type(key)), ("ids", pa.list_(pa.int32()))]
    fields.append(("offsets", pa.list_(pa.int64())))
    names = f"key {key.simpleString()}, ids array<int>, offsets array<long>"
    if decoded:
        fields.append(("decoded", pa.binary()))
        names += ", decoded binary"
    out = pa.schema(fields)

    def run(batches):
        bpe = _loaded(ranks)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                texts = ["" if t is None else t for t in part.column(1).to_pylist()]
                for a, b in _slices(texts):
                    ids, offsets = map(list, zip(*bpe.encode(texts[a:b])))
                    columns = [part.column(0).slice(a, b - a), pa.array(ids, out[1].type)]
                    columns.append(pa.array(offsets, out[2].type))
                    if decoded:
                        columns.append(pa.array([bpe.decode(i) for i in ids], out[3].type))
                    yield pa.record_batch(columns, schema=out)

    return rows.mapInArrow(run, names).withColumnRenamed("key", id_column)


def decode(tokens: DataFrame, rank_file: str) -> DataFrame:
    """Add ``decoded``, the bytes that ``ids`` stand for; null ids give null."""
    ranks = tokens.sparkSession.sparkContext.broadcast(read_bytes(rank_file))

    @F.pandas_udf("binary")
    def bytes_of(ids):
        bpe = _loaded(ranks)
        return ids.map(lambda x: None if x is None else bpe.decode(x.tolist()))

    return tokens.withColumn("decoded", bytes_of("ids"))
