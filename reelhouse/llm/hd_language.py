"""Language identification by hyperdimensional profiles.

Every letter has a random vector of -1 and 1, drawn from its code point. A letter n-gram binds its
letters' vectors, each rotated by its place, by componentwise product. A text bundles (adds up) the
vectors of all its n-grams, a language prototype those of all its training texts. A text gets the
language whose prototype has the largest cosine with it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

DIMENSIONS = 1_024
GAP = 32
BATCH_ROWS = 128
#: A longer run of text is counted piece by piece.
PIECE_CHARS = 1 << 20
UNKNOWN = "und"


def held_out(doc_id: Column) -> Column:
    """The quarter that nothing is learned from. A null id is not in it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


@lru_cache(maxsize=4_096)
def _letter_vector(point: int) -> np.ndarray:
    bits = np.random.Generator(np.random.Philox(key=point)).integers(0, 2, DIMENSIONS, np.int8)
    return 2 * bits - 1


def _symbols(text: str) -> np.ndarray:
    """Lower-case letters as code points, each run of anything else as one gap, a gap at each end."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(_letters()[points], points, GAP)
    repeated = (points[1:] == GAP) & (points[:-1] == GAP)
    return points[np.r_[True, ~repeated]]


def bundles(texts: list[str]) -> np.ndarray:
    """One vector for each text; zero without a letter."""
    out = np.zeros((len(texts), DIMENSIONS))
    batch: list[tuple[int, np.ndarray]] = []
    size = 0
    for row, text in enumerate(texts):
        symbols = _symbols(text)
        for at in range(0, max(len(symbols) - 2, 0), PIECE_CHARS):
            piece = symbols[at : at + PIECE_CHARS + 2]
            if size + len(piece) > PIECE_CHARS and batch:
                _bundle(batch, out)
                batch, size = [], 0
            batch.append((row, piece))
            size += len(piece)
    if batch:
        _bundle(batch, out)
    return out


def _bundle(batch: list[tuple[int, np.ndarray]], out: np.ndarray) -> None:
    """Add the n-gram vectors of the pieces to their rows of ``out``."""
    symbols = np.concatenate([s for _, s in batch])
    points, code = np.unique(symbols, return_inverse=True)
    n = len(points)
    grams = (code[:-2] * n + code[1:-1]) * n + code[2:]
    owner = np.repeat(np.arange(len(batch)), [len(s) for _, s in batch])
    inside = owner[:-2] == owner[2:]
    grams, owner = grams[inside], owner[:-2][inside]
    if n**3 <= 1 << 24:
        used = np.flatnonzero(np.bincount(grams, minlength=n**3))
        place = np.zeros(n**3, np.int32)
        place[used] = np.arange(len(used))
        column = place[grams]
    else:
        used, column = np.unique(grams, return_inverse=True)
    letters = np.stack([_letter_vector(int(p)) for p in points])
    first, second = np.roll(letters, 2, axis=1), np.roll(letters, 1, axis=1)
    rows = np.array([row for row, _ in batch])
    step = max(1, (1 << 22) // len(batch))
    order = np.argsort(column, kind="stable") if len(used) > step else None
    if order is not None:
        column, owner = column[order], owner[order]
    for at in range(0, len(used), step):
        part = used[at : at + step]
        vectors = first[part // (n * n)] * second[part // n % n] * letters[part % n]
        if order is None:
            cells = owner * len(part) + column
        else:
            a, b = np.searchsorted(column, [at, at + len(part)])
            cells = owner[a:b] * len(part) + column[a:b] - at
        counts = np.bincount(cells, minlength=len(batch) * len(part)).reshape(len(batch), -1)
        # Sums below 2**24 are exact in single precision; a piece has at most 2**20 n-grams.
        np.add.at(out, rows, counts.astype(np.float32) @ vectors.astype(np.float32))


@dataclass(frozen=True)
class Prototypes:
    """Language names in order, and one vector of whole numbers for each."""

    languages: list[str]
    vectors: np.ndarray


def learn(docs: DataFrame, rows_per_language: int = 10_000) -> Prototypes:
    """Prototypes from text and lang of ``docs``.

    Rows with a null text or lang teach nothing. At most about ``rows_per_language`` rows of a
    language are used, drawn by a hash of id and text; the counts that set the rates cover all rows.
    Tasks add up whole numbers, so the result does not depend on how rows are dealt. The driver
    gets one vector for each language.
    """
    rows = docs.where("lang is not null and text is not null").select("lang", "text", "doc_id")
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return Prototypes([], np.zeros((0, DIMENSIONS)))
    rates = F.create_map(
        *[F.lit(x) for lang, n in counts.items() for x in (lang, rows_per_language / n)]
    )
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = rows.where(draw < F.element_at(rates, F.col("lang"))).drop("doc_id")
    names = sorted(counts)

    def add_up(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                langs = np.array(part.column(0).to_pylist(), object)
                made = bundles(part.column(1).to_pylist())
                for lang in set(langs.tolist()):
                    vector = made[langs == lang].sum(axis=0)
                    total[lang] = total.get(lang, 0) + vector
        if total:
            yield pa.record_batch(
                [
                    pa.array(np.repeat(list(total), DIMENSIONS).tolist(), pa.string()),
                    pa.array(np.tile(np.arange(DIMENSIONS, dtype=np.int32), len(total))),
                    pa.array(np.concatenate(list(total.values())).astype(np.int64)),
                ],
                names=["lang", "place", "value"],
            )

    added = sample.mapInArrow(add_up, "lang string, place int, value long")
    vectors = np.zeros((len(names), DIMENSIONS))
    for r in added.groupBy("lang", "place").agg(F.sum("value").alias("value")).collect():
        vectors[names.index(r.lang), r.place] = r.value
    return Prototypes(names, vectors)


def has_letters(texts: list[str]) -> np.ndarray:
    """Has each text a letter?"""
    return np.array([bool(_letters()[np.unique(_symbols(t))].any()) for t in texts], bool)


def predict(
    texts: list[str], prototypes: Prototypes, lettered: np.ndarray | None = None
) -> tuple[list[str], np.ndarray]:
    """Language and cosine, not below 0, of each text; ``und`` and 0 without a letter."""
    lettered = has_letters(texts) if lettered is None else lettered
    made = bundles(texts)
    lengths = np.sqrt((made**2).sum(axis=1))
    if not prototypes.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    norms = np.sqrt((prototypes.vectors**2).sum(axis=1))
    unit = prototypes.vectors / np.where(norms > 0, norms, 1)[:, None]
    cosines = made @ unit.T / np.where(lengths > 0, lengths, 1)[:, None]
    best = cosines.argmax(axis=1)
    names = [prototypes.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered)]
    score = np.clip(cosines[np.arange(len(texts)), best], 0, 1)
    return names, np.where(lettered, score, 0.0)


def identify(docs: DataFrame, prototypes: Prototypes, lettered: bool = False) -> DataFrame:
    """All columns of ``docs`` but lang_pred and score, and those two for each whole text.

    A null text, or one without a letter, gets ``und`` and 0, as does every text if no language was
    learned; equal cosines go to the first language by name. Repeated rows stay. With ``lettered``, a
    third column of that name says whether the text has a letter.
    """
    added = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    added += [StructField("lettered", BooleanType())] if lettered else []
    fields = [f for f in docs.schema if f.name not in [a.name for a in added]]
    schema = StructType([*fields, *added])
    names, out = [f.name for f in fields], to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                texts = [t or "" for t in part.column(names.index("text")).to_pylist()]
                letters = has_letters(texts)
                langs, scores = predict(texts, prototypes, letters)
                columns = [*part.columns, pa.array(langs, pa.string()), pa.array(scores)]
                columns += [pa.array(letters)] if lettered else []
                yield pa.record_batch(
                    [c.cast(f.type) for c, f in zip(columns, out)], schema=out
                )

    return docs.select(*[F.col(f"`{n}`") for n in names]).mapInArrow(run, schema)
