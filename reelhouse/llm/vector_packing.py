"""Documents as token pieces, packed into sequences by vector best fit.

A sequence has three capacities: tokens, documents, and attention cost (the sum of squared
lengths). Pieces are placed from long to short. Among the sequences whose residual covers a piece
in all three, either the one left with the smallest residual norm takes it, or the one whose
residual points most in the piece's direction (weighted dot product).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

CACHE_WORDS = 1 << 18
CACHE_CHUNKS = 1 << 19
LONG_CHUNK = 256
BATCH_ROWS = 256
#: A Latin-1 word with marks behind it: its own pre-token, then one of marks.
_PLAIN = re.compile(r"([A-Za-zªµºÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)").fullmatch


class ChunkIds(dict):
    """Ids of chunks between white space, worked out when first seen.

    A plain word goes to the library's BPE model directly, any other chunk through the whole
    tokenizer. A full cache starts anew.
    """

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer = tokenizer
        self.words: dict[str, bytes] = {}
        self.coded = [i.to_bytes(4, "little") for i in range(tokenizer.get_vocab_size())]
        # Byte-level letters: printable Latin-1 bytes stand for themselves, the others are
        # numbered from 256 on.
        own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        moved = [b for b in range(256) if b not in set(own)]
        letters = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(moved)}
        self.letters = "".join(letters[b] for b in range(256))

    def _word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            shown = word
            if not word.isascii():
                shown = word.encode("utf-8").decode("latin-1").translate(self.letters)
            ids = b"".join([self.coded[t.id] for t in self.tokenizer.model.tokenize(shown)])
            if len(self.words) >= CACHE_WORDS:
                self.words.clear()
            self.words[word] = ids
        return ids

    def __missing__(self, chunk: str) -> bytes:
        plain = _PLAIN(chunk)
        if plain is None:
            ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
            ids = b"".join([self.coded[i] for i in ids])
        else:
            word, marks = plain.groups()
            ids = self._word(word.lower())
            if marks:
                ids += self._word(marks)
        if len(self) >= CACHE_CHUNKS:
            self.clear()
        if len(chunk) <= LONG_CHUNK:
            self[chunk] = ids
        return ids


class WordTokenizer:
    """Ids of whole texts by a word-level BPE tokenizer that drops white space.

    White space always ends a word, so a text's ids are its chunks' ids in a row.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.chunks = ChunkIds(self.tokenizer)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        chunks = text.replace("\n", " ").split(" ")
        return b"".join(map(self.chunks.__getitem__, chunks))


_TOKENIZERS: dict[int, tuple[str, WordTokenizer]] = {}


def _tokenizer(definition) -> WordTokenizer:
    key = id(definition.value)
    if key not in _TOKENIZERS:
        _TOKENIZERS.clear()
        _TOKENIZERS[key] = (definition.value, WordTokenizer(definition.value))
    return _TOKENIZERS[key][1]


def token_pieces(
    docs: DataFrame, tokenizer_file: str, max_tokens: int = 4096, end_id: int = 1
) -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids (binary, uint32).

    A document's ids are its text's and ``end_id``; a null text is empty, so each row gives at
    least one piece. Documents over ``max_tokens`` are cut every ``max_tokens`` ids. Repeated rows
    and null ids are kept as they are; other columns are not read.
    """
    with open(tokenizer_file, encoding="utf-8") as file:
        definition = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kinds = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64()}
    out = pa.schema([*kinds.items(), ("ids", pa.binary())])
    end = np.array([end_id], "<u4").tobytes()

    def cut(ids, codes):
        made = [[], [], [], [], []]
        for doc, code in zip(ids, codes):
            whole = code + end
            for n, at in enumerate(range(0, len(whole), 4 * max_tokens)):
                part = whole[at : at + 4 * max_tokens]
                for column, value in zip(made, (doc, n, at // 4, len(part) // 4, part)):
                    column.append(value)
        columns = [pa.array(c, t) for c, t in zip(made, out.types)]
        return pa.record_batch(columns, schema=out)

    def run(batches):
        coder = _tokenizer(definition)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                texts = ["" if t is None else t for t in part.column(1).to_pylist()]
                yield cut(part.column(0).to_pylist(), map(coder.encode, texts))

    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary")


@dataclass(frozen=True)
class Capacities:
    """What one sequence may hold."""

    tokens: int = 4096
    documents: int = 4096
    attention: int = 4096**2


def best_fit(
    lengths: np.ndarray,
    limits: Capacities = Capacities(),
    weights: tuple[float, float, float] = (1.0, 1e-3, 1e-6),
    rule: str = "norm",
) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece.

    ``rule`` is ``norm`` (least weighted norm of what stays free) or ``dot`` (largest weighted dot
    product of need and residual); ties go to the oldest sequence. A piece that alone breaks a
    limit is refused.
    """
    lengths = np.asarray(lengths, np.int64)
    needs = np.stack([lengths, np.ones_like(lengths), lengths**2], axis=1)
    most = np.array([limits.tokens, limits.documents, limits.attention], np.int64)
    if (needs > most).any():
        raise ValueError("a piece is larger than a sequence")
    scale = np.sqrt(np.array(weights)) / most
    order = np.lexsort((np.arange(len(lengths)), -lengths))
    sequence, offset = np.empty_like(lengths), np.empty_like(lengths)
    left = np.empty((max(len(lengths), 1), 3), np.int64)
    number = np.empty(max(len(lengths), 1), np.int64)
    opened = used = 0
    shortest = int(lengths.min(initial=limits.tokens))
    for step, item in enumerate(order):
        need = needs[item]
        at = -1
        if used:
            free = left[:used]
            fits = np.flatnonzero(
                (free[:, 0] >= need[0]) & (free[:, 1] >= 1) & (free[:, 2] >= need[2])
            )
            if len(fits):
                if rule == "norm":
                    cost = (((free[fits] - need) * scale) ** 2).sum(axis=1)
                else:
                    cost = -((free[fits] * scale) * (need * scale)).sum(axis=1)
                at = int(fits[cost.argmin()])
        if at < 0:
            at, number[used], left[used] = used, opened, most
            opened, used = opened + 1, used + 1
        sequence[item], offset[item] = number[at], limits.tokens - left[at, 0]
        left[at] -= need
        if left[at, 0] < shortest or step % 1024 == 1023:
            # Sequences that no piece can enter any more leave the search.
            useful = (left[:used, 0] >= shortest) & (left[:used, 1] > 0)
            useful &= left[:used, 2] >= shortest**2
            if not useful.all():
                kept = int(useful.sum())
                left[:kept], number[:kept] = left[:used][useful], number[:used][useful]
                used = kept
    return sequence, offset


def pack(
    pieces: DataFrame,
    documents: int,
    limits: Capacities = Capacities(),
    group_documents: int = 8_192,
    **choice,
) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, piece, length, any others).

    Pieces are dealt to groups of about ``group_documents`` of the ``documents`` documents, and each
    group is packed by itself, at the cost of at most a few part-filled sequences a group. The deal
    is by a hash of the piece's position in the input, so no id, null or repeated row makes a large
    group; the input must be a scan, whose tasks give the same rows in the same order again. Only a
    document's last piece can be shorter than a whole sequence, so ``documents`` bounds the pieces
    that take a search.
    """
    groups = max(1, -(-documents // group_documents))
    fields = [f for f in pieces.schema if f.name not in ("sequence_id", "offset")]
    added = [StructField("sequence_id", LongType()), StructField("offset", LongType())]
    schema = StructType([*fields, *added])
    names, out = [f.name for f in fields], to_arrow_schema(schema)

    def pack_group(table: pa.Table) -> pa.Table:
        group = table["pack_group"][0].as_py()
        # The same order whenever a lost task runs again.
        table = table.sort_by([(c, "ascending") for c in ("doc_id", "piece", "length")])
        lengths = table["length"].to_numpy()
        whole = lengths == limits.tokens
        sequence, offset = np.arange(len(lengths)), np.zeros(len(lengths), np.int64)
        rest, at = best_fit(lengths[~whole], limits, **choice)
        sequence[~whole], offset[~whole] = rest + len(lengths), at
        columns = [*(table[n] for n in names), pa.array(sequence + (group << 40)), pa.array(offset)]
        return pa.table([c.cast(f.type) for c, f in zip(columns, out)], schema=out)

    group = F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()), F.lit(groups))
    dealt = pieces.select(*names, group.alias("pack_group"))
    return dealt.groupBy("pack_group").applyInArrow(pack_group, schema)
