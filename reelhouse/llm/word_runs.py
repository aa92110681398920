"""Periodic runs of words by string synchronising sets.

A run is a stretch of words with a smallest period q, at least 2 q long, that can't be extended. For a
scale t every place gets the hash of the t words from it. A place is synchronising if that hash, or
the one t places on, is the least of the t + 1 hashes between them, where places whose t words have a
period of at most t / 3 are left out. Whether a place is chosen depends on 2 t words only, so a run
of period q chooses the same places one period on: any two chosen places with equal contexts,
between 3 t and 6 t apart, propose their distance as a period. Doubling scales cover all periods.

Where the first q words of a run have a period p of at most t / 3 themselves, nothing may be chosen in
them. Both of its halves are then highly periodic: runs of period p found before, neighbours
that meet, and each distance at which their words agree is proposed. Periods up to SMALL, which are
below the first scale, are found by comparing all words that far apart. Proposals are checked on the
words themselves, so hashes decide what is looked at, never what is found.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Periods up to it are found directly; the first scale is 2, for periods from 6 on.
SMALL = 5
BATCH_ROWS = 256
#: Words of neighbouring texts that are searched together; a longer text is searched by itself.
WORDS_AT_ONCE = 1 << 16
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
_NEVER = np.uint64((1 << 64) - 1)


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of two hashes in order, below the mark of places that are left out."""
    made = (left ^ (left >> np.uint64(29))) * _FACTORS[0] + right * _FACTORS[1]
    return (made ^ (made >> np.uint64(32))) >> np.uint64(1)


def _window_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    reach, least = 1, values
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(least[:-rest], least[rest:]) if rest else least


def _stretches(codes: np.ndarray, period: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of all runs that have ``period``, their smallest or not."""
    same = np.r_[False, codes[period:] == codes[:-period], False].view(np.int8)
    edges = np.flatnonzero(np.diff(same))
    begin, end = edges[::2], edges[1::2]
    whole = end - begin >= period
    return begin[whole], end[whole] + period


def _agreeing(codes: np.ndarray, i: int, j: int, step: int) -> int:
    """How many words from places i < j on agree, going up or, with ``step`` -1, down."""
    most = len(codes) - j if step > 0 else i + 1
    done, size = 0, 16
    while done < most:
        size = min(size, most - done)
        if step > 0:
            unequal = codes[i + done : i + done + size] != codes[j + done : j + done + size]
        else:
            unequal = (
                codes[i - done - size + 1 : i - done + 1] != codes[j - done - size + 1 : j - done + 1]
            )[::-1]
        first = int(unequal.argmax())
        if unequal[first]:
            return done + first
        done, size = done + size, 4 * size
    return most


def _extended(codes: np.ndarray, places: np.ndarray, periods: np.ndarray) -> np.ndarray:
    """Rows (begin, end, period) of the runs that the proposals belong to.

    A stretch of one period is extended once, however many of its places propose it.
    """
    order = np.lexsort((places, periods))
    found, last_period, last_end = [], 0, 0
    for i, q in zip(places[order].tolist(), periods[order].tolist()):
        if q == last_period and i + q < last_end:
            continue
        begin = i - _agreeing(codes, i - 1, i - 1 + q, -1) if i else 0
        last_period, last_end = q, i + q + _agreeing(codes, i, i + q, 1)
        if last_end - begin >= 2 * q:
            found.append((begin, last_end, q))
    return np.array(found, np.int64).reshape(-1, 3)


def _smallest(runs: np.ndarray) -> np.ndarray:
    """One row for each stretch, with its smallest period, by begin and period.

    A stretch with several periods has their common divisor as well, so the run of its smallest
    period is the same stretch.
    """
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.r_[True, (runs[1:, :2] != runs[:-1, :2]).any(axis=1)][: len(runs)]
    return runs[new]


def _from_neighbours(codes: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Runs whose two halves lie in two meeting runs of one period that is at most a ninth of theirs."""
    runs = runs[runs[:, 1] - runs[:, 0] >= 9 * runs[:, 2]]
    runs = runs[np.lexsort((runs[:, 0], runs[:, 2]))]
    if len(runs) < 2:
        return runs[:0]
    left, right = runs[:-1], runs[1:]
    meet = (left[:, 2] == right[:, 2]) & (right[:, 0] <= left[:, 1])
    places, periods = [], []
    for (begin, end, p), (then, stop, _) in zip(left[meet].tolist(), right[meet].tolist()):
        root, first = codes[then : then + p], codes[begin : begin + 2 * p - 1]
        windows = np.lib.stride_tricks.sliding_window_view(first, p)
        fits = np.flatnonzero((windows == root).all(axis=1))
        if len(fits):
            # Distances at which the right one's words are those of the left one, a period apart.
            far = np.arange((then - begin - int(fits[0])) % p, min(end - begin, stop - then) + 1, p)
            far = far[far >= 9 * p]
            # Such a run begins with the left one, or its second half with the right one.
            places.append(np.maximum(begin, then - far))
            periods.append(far)
    if not places:
        return runs[:0]
    return _extended(codes, np.concatenate(places), np.concatenate(periods))


def _proposals(
    codes: np.ndarray, hashes: np.ndarray, contexts: np.ndarray, runs: np.ndarray, scale: int
) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of the chosen places with equal contexts, 3 to 6 scales apart."""
    periodic = runs[(runs[:, 2] * 3 <= scale) & (runs[:, 1] - runs[:, 0] >= scale)]
    change = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(change, periodic[:, 0], 1)
    np.add.at(change, periodic[:, 1] - scale + 1, -1)
    hashes = np.where(np.cumsum(change[:-1]) > 0, _NEVER, hashes)
    least = _window_least(hashes, scale + 1)
    chosen = ((least == hashes[: len(least)]) | (least == hashes[scale:])) & (least != _NEVER)
    places = np.flatnonzero(chosen)
    places = places[np.argsort(contexts[places], kind="stable")]
    context = contexts[places]
    here, step, found = np.arange(len(places)), 0, []
    # Places with equal contexts are more than a third of a scale apart, so few are within reach.
    while len(here):
        step += 1
        here = here[here + step < len(places)]
        here = here[context[here] == context[here + step]]
        apart = places[here + step] - places[here]
        here, apart = here[apart < 6 * scale], apart[apart < 6 * scale]
        far = apart >= 3 * scale
        found.append((places[here[far]], apart[far]))
    if not found:
        return places[:0], places[:0]
    return tuple(np.concatenate(side) for side in zip(*found))


def find_runs(codes: np.ndarray, longest: int | None = None) -> np.ndarray:
    """All runs of ``codes``: rows (begin, end, smallest period), by begin and period.

    ``longest`` is the length of the longest part without a separator, a code that occurs once; no
    run crosses one.
    """
    none = np.empty((0, 3), np.int64)
    longest = len(codes) if longest is None else longest
    found = [none]
    for q in range(1, min(SMALL, longest // 2) + 1):
        begin, end = _stretches(codes, q)
        found.append(np.stack([begin, end, np.full(len(begin), q)], axis=1))
    runs = _smallest(np.concatenate(found))
    if longest < 2 * (SMALL + 1):
        return runs
    runs = np.concatenate([runs, _from_neighbours(codes, runs)])
    hashes = _mixed(codes.astype(np.uint64), codes.astype(np.uint64))
    hashes, scale = _mixed(hashes[:-1], hashes[1:]), 2
    while 6 * scale <= longest:
        contexts = _mixed(hashes[:-scale], hashes[scale:])
        made = _extended(codes, *_proposals(codes, hashes, contexts, runs, scale))
        runs = _smallest(np.concatenate([runs, made]))
        near = _from_neighbours(codes, made)
        runs = _smallest(np.concatenate([runs, near])) if len(near) else runs
        hashes, scale = contexts, 2 * scale
    return _smallest(runs)


class Numbers(dict):
    """Words numbered in the order of their first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _groups(texts: list[list[bytes]]) -> Iterator[tuple[int, int]]:
    begin, words = 0, 0
    for i, text in enumerate(texts):
        if words and words + len(text) > WORDS_AT_ONCE:
            yield begin, i
            begin, words = i, 0
        words += len(text) + 1
    if begin < len(texts):
        yield begin, len(texts)


def text_runs(texts: list[list[bytes]], shortest: int = 1) -> Iterator[tuple[np.ndarray, bytes]]:
    """For each list of words its runs of at least ``shortest`` words, and the words without repeats.

    Runs are rows (start, length, period) by start and period. A word that any run holds after its
    first period is a repeat.
    """
    for a, b in _groups(texts):
        part = texts[a:b]
        sizes = np.array([len(t) for t in part])
        starts = np.r_[0, np.cumsum(sizes + 1)]
        known = Numbers()
        codes = np.empty(int(starts[-1]), np.int64)
        for n, text in enumerate(part):
            at = starts[n]
            codes[at : at + len(text)] = list(map(known.__getitem__, text))
            # A separator of its own after each text.
            codes[at + len(text)] = -1 - n
        runs = find_runs(codes, int(sizes.max()))
        runs = runs[runs[:, 1] - runs[:, 0] >= shortest]
        change = np.zeros(len(codes) + 1, np.int64)
        np.add.at(change, runs[:, 0] + runs[:, 2], 1)
        np.add.at(change, runs[:, 1], -1)
        repeated = np.cumsum(change) > 0
        cuts = np.searchsorted(runs[:, 0], starts)
        for n, text in enumerate(part):
            own = runs[cuts[n] : cuts[n + 1]]
            own = np.stack([own[:, 0] - starts[n], own[:, 1] - own[:, 0], own[:, 2]], axis=1)
            gone = repeated[starts[n] : starts[n] + len(text)]
            kept = list(compress(text, (~gone).tolist())) if len(own) else text
            yield own, b" ".join(kept)


def repeat_words(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """One document in ten, by the checksum of its id, with its end made periodic.

    From a word a on, the p words there are repeated; both follow from the checksum. A null id changes
    nothing.
    """
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


def _slices(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(at, BATCH_ROWS)


def words_of(text: str | None) -> list[bytes]:
    """Runs of anything but ASCII white space."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def with_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with ``repeat_words`` done to the words of every text, one space between them.

    A null text becomes an empty one.
    """
    out = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches):
        for part in _slices(batches):
            pairs = zip(part.column(0).to_pylist(), part.column(1).to_pylist())
            made = [b" ".join(repeat_words(words_of(t), i)).decode("utf-8", "surrogatepass") for i, t in pairs]
            yield pa.record_batch([part.column(0), pa.array(made, pa.string())], schema=out)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, text string")


RUNS = "array<struct<start:long,length:long,period:long>>"


def find_document_runs(docs: DataFrame, shortest: int = 12) -> DataFrame:
    """doc_id, runs and collapsed of every row of ``docs`` (doc_id, text).

    ``runs`` holds start, length and period, counted in words, of each maximal stretch that has a
    smallest period of at most half its length and is at least ``shortest`` words long, by start and
    period. ``collapsed`` is the words that no run repeats, one space between them. A null, empty or
    wordless text has no runs and collapses to nothing. Whole texts are read; null ids and repeated
    rows stay; other columns are not read. Each row is searched by itself, in a time that grows with
    n log n and the number of proposals, and in memory of about 100 bytes a word.
    """
    schema = StructType.fromDDL(f"doc_id long, runs {RUNS}, collapsed string")
    out = to_arrow_schema(schema)

    def run(batches):
        for part in _slices(batches):
            texts = [words_of(t) for t in part.column(1).to_pylist()]
            runs, kept = [], []
            for own, collapsed in text_runs(texts, shortest):
                runs.append([dict(zip(("start", "length", "period"), r)) for r in own.tolist()])
                kept.append(collapsed.decode("utf-8", "surrogatepass"))
            columns = [part.column(0), pa.array(runs, out[1].type), pa.array(kept, pa.string())]
            yield pa.record_batch(columns, schema=out)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, schema)


def longest(runs: str) -> Column:
    """The run with the greatest length, of equals the first, then the smallest period; null of none."""
    keyed = F.transform(
        runs, lambda r: F.struct((-r["length"]).alias("below"), r["start"], r["period"], r["length"])
    )
    return F.array_min(keyed).dropFields("below")
