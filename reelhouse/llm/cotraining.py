"""Document quality by co-training two views.

The text view sees the words and characters of a document: how words end and repeat, which kinds of
characters fill it, how far it compresses. The metadata view sees its record alone: language, source and
recorded length. Each round, each view's logistic model scores all documents without a label, and passes
those that it is surest of on to the other view, which trains on them as well. Both are calibrated on
labelled rows that neither was trained on, in every round: a weak view is seldom sure. Given the label the views count as independent, so their
calibrated log-odds are added, less those of the labels' own share.

All documents are measured once and their features stored; a round reads these, and only the rows
that it passes on reach the driver.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from reelhouse.session import new_work_path

TAILS = 256
FIELDS = 32
BATCH_ROWS = 256
MARKS = [b for b in range(0x21, 0x7F) if not chr(b).isalnum()]
ADDED = ("text_score", "metadata_score", "score", "keep")


def _slot(name: str, slots: int, known: dict[str, int]) -> int:
    at = known.get(name)
    if at is None:
        if len(known) > 1 << 16:
            known.clear()
        at = known[name] = zlib.crc32(name.encode("utf-8", "surrogatepass")) % slots
    return at


def text_features(text: str, known: dict[str, int]) -> np.ndarray:
    """Shares of word endings (hashed), repeats, capitals, marks; variety of words; characters and lines."""
    out = np.zeros(TAILS + 5)
    raw = text.encode("utf-8", "surrogatepass")
    size = max(len(raw), 1)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) / size
    lines = raw.count(b"\n") + 1
    characters = [
        math.log1p(lines),
        math.log1p(size / lines),
        counts[ord("A") : ord("Z") + 1].sum(),
        counts[ord("a") : ord("z") + 1].sum(),
        counts[ord("0") : ord("9") + 1].sum(),
        counts[0x80:].sum(),
        counts[ord(" ")],
        len(zlib.compress(raw, 1)) / size,
    ]
    words = text.split()
    n = len(words)
    if n:
        for tail, count in Counter([w[-3:] for w in words]).items():
            out[_slot(tail, TAILS, known)] += count / n
        kinds = Counter(words)
        out[TAILS] = sum(map(str.__eq__, words, words[1:])) / n
        out[TAILS + 1] = sum(c for w, c in kinds.items() if len(w) > 1 and w.isupper()) / n
        out[TAILS + 2] = sum(c for w, c in kinds.items() if not any(map(str.isalnum, w))) / n
        out[TAILS + 3] = len(kinds) / n
        out[TAILS + 4] = max(kinds.values()) / n
    return np.r_[out, characters, counts[MARKS]]


def metadata_features(lang, source, n_chars, known: dict[str, int]) -> np.ndarray:
    """Source and language (hashed), recorded length. Nothing of the text."""
    out = np.zeros(2 + 2 * FIELDS)
    out[0] = math.log1p(max(n_chars, 0)) if n_chars is not None else 0.0
    out[1] = n_chars is None
    out[2 + _slot(f"lang {lang}", FIELDS, known)] = 1
    out[2 + FIELDS + _slot(f"source {source}", FIELDS, known)] = 1
    return out


@dataclass
class Logistic:
    """Logistic regression with an L2 penalty on standardised features, and Platt scaling."""

    penalty: float = 1.0
    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    scale: np.ndarray = field(default_factory=lambda: np.zeros(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    slope: float = 1.0
    shift: float = 0.0

    def _design(self, x: np.ndarray) -> np.ndarray:
        # Beyond five deviations a value says no more.
        z = np.clip((x - self.mean) / self.scale, -5, 5)
        return np.hstack([z, np.ones((len(z), 1))])

    @staticmethod
    def _newton(design: np.ndarray, y: np.ndarray, penalty: np.ndarray) -> np.ndarray:
        w = np.zeros(design.shape[1])
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
            slope = design.T @ (p - y) + penalty * w
            curve = (design.T * np.maximum(p * (1 - p), 1e-6)) @ design + np.diag(penalty + 1e-9)
            step = np.linalg.solve(curve, slope)
            w -= step / max(1.0, np.abs(step).max() / 5)
            if np.abs(step).max() < 1e-6:
                break
        return w

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Logistic":
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0)
        self.scale = np.where(self.scale > 1e-9, self.scale, np.inf)
        penalty = np.full(x.shape[1] + 1, self.penalty)
        penalty[-1] = 0
        self.weights = self._newton(self._design(x), y, penalty)
        self.slope, self.shift = 1.0, 0.0
        return self

    def odds(self, x: np.ndarray) -> np.ndarray:
        """Log-odds; calibrated once ``calibrate`` has run."""
        return self.slope * (self._design(x) @ self.weights) + self.shift

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        if len(np.unique(y)) < 2:
            return
        self.slope, self.shift = 1.0, 0.0
        raw = np.clip(self.odds(x), -12, 12)
        # Platt's targets keep a perfectly separated set from infinite odds.
        good = y.sum()
        target = np.where(y > 0, (good + 1) / (good + 2), 1 / (len(y) - good + 2))
        design = np.stack([raw, np.ones_like(raw)], axis=1)
        slope, shift = self._newton(design, target, np.array([1e-3, 0.0]))
        if slope > 0:
            self.slope, self.shift = float(slope), float(shift)


@dataclass(frozen=True)
class Model:
    """The two calibrated views; None where the labels hold fewer than two classes.

    ``prior`` is the log-odds of a good label.
    """

    text: Logistic | None
    metadata: Logistic | None
    prior: float = 0.0

    def odds(self, text: np.ndarray, metadata: np.ndarray) -> list[np.ndarray]:
        """Log-odds of the views, and of both together."""
        own = [self.text.odds(text), self.metadata.odds(metadata)]
        return [*own, sum(own) - self.prior]


def _text_view(texts: list[str | None], known: dict[str, int]) -> np.ndarray:
    return np.array([text_features(t or "", known) for t in texts])


def _metadata_view(records: list[list], known: dict[str, int]) -> np.ndarray:
    return np.array([metadata_features(*r, known) for r in zip(*records)])


def _parts(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(at, BATCH_ROWS)


_RECORD = [("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())]
_MEASURED = pa.schema([("doc_id", pa.int64()), ("given", pa.float64()), *_RECORD, ("text_view", pa.list_(pa.float64()))])
_PASSED = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("sure", pa.float64()), *_RECORD, _MEASURED[5]])
#: Teacher, learner and label of what is passed on; views are 0 text, 1 metadata.
KINDS = ((0, 1, 1), (0, 1, 0), (1, 0, 1), (1, 0, 0))


def _measured(docs: DataFrame, given: DataFrame) -> DataFrame:
    """Every document with an id, its label or null, its record and its text view, stored."""
    rows = docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        *[F.col(c).cast(k).alias(c) for c, k in (("lang", "string"), ("source", "string"), ("n_chars", "long"))],
    )
    rows = rows.join(given, "doc_id", "left").withColumn("given", F.col("given").cast("double"))

    def measure(batches):
        known: dict[str, int] = {}
        for part in _parts(batches):
            views = _text_view(part.column("text").to_pylist(), known)
            columns = [part.column(n) for n in ("doc_id", "given", "lang", "source", "n_chars")]
            yield pa.record_batch([*columns, pa.array(list(views), _MEASURED[5].type)], schema=_MEASURED)

    spark = docs.sparkSession
    folder = new_work_path(spark, "measured")
    kinds = "doc_id long, given double, lang string, source string, n_chars long, text_view array<double>"
    rows.mapInArrow(measure, kinds).write.parquet(folder)
    return spark.read.parquet(folder)


def _views(rows: pa.Table | pa.RecordBatch, known: dict[str, int]) -> list[np.ndarray]:
    """Both views of measured rows."""
    text = np.stack([np.asarray(v.values) for v in rows["text_view"]]) if rows.num_rows else np.zeros((0, 0))
    return [text, _metadata_view([rows[n].to_pylist() for n, _ in _RECORD], known)]


def _surest(measured: DataFrame, models: list[Logistic], wanted: list[int], passed: list[set[int]], least: float) -> pa.Table:
    """The ``wanted`` documents of each of KINDS that the teacher is surest of, for the learner.

    ``least`` is the log-odds needed, ``passed`` holds the ids that each view has been given. Every task keeps its own best of each kind
    first, and an id counts once.
    """
    def pick(batches):
        best: list[dict[int, tuple]] = [{} for _ in KINDS]
        known: dict[str, int] = {}
        for part in _parts(batches):
            ids = part.column("doc_id").to_pylist()
            views = _views(part, known)
            odds = [m.odds(v) for m, v in zip(models, views)]
            records = None
            for own, (teacher, learner, label), most in zip(best, KINDS, wanted):
                sure = odds[teacher] if label else -odds[teacher]
                rows = [n for n in np.flatnonzero(sure >= least).tolist() if ids[n] not in passed[learner]]
                if not rows:
                    continue
                records = records or part.select([n for n, _ in _RECORD]).to_pylist()
                for n in rows:
                    entry = (float(sure[n]), *records[n].values(), views[0][n])
                    if ids[n] not in own or own[ids[n]][0] < entry[0]:
                        own[ids[n]] = entry
                if len(own) > 2 * most:
                    _cut(own, most)
        for kind, (own, most) in enumerate(zip(best, wanted)):
            _cut(own, most)
            if own:
                columns = list(zip(*own.values()))
                made = [[kind] * len(own), list(own), *map(list, columns)]
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(made, _PASSED)], schema=_PASSED)

    found = measured.where("given is null").mapInArrow(
        pick, "kind int, doc_id long, sure double, lang string, source string, n_chars long, text_view array<double>"
    )
    entry = F.struct("sure", "lang", "source", "n_chars", "text_view")
    single = found.groupBy("kind", "doc_id").agg(F.max(entry).alias("e")).select("kind", "doc_id", "e.*")
    most = F.element_at(F.array(*map(F.lit, wanted)), F.col("kind") + 1)
    place = F.expr("row_number() over (partition by kind order by sure desc, doc_id)")
    chosen = single.withColumn("place", place).where(F.col("place") <= most)
    return chosen.toArrow().sort_by([("kind", "ascending"), ("place", "ascending")])


def _cut(own: dict[int, tuple], most: int) -> None:
    """Leave the ``most`` surest; of equals the smaller id."""
    kept = sorted(own.items(), key=lambda item: (-item[1][0], item[0]))[:most]
    own.clear()
    own.update(kept)


def learn(
    docs: DataFrame,
    labels: DataFrame,
    max_labelled: int = 4_000,
    rounds: int = 4,
    growth: int = 400,
    confidence: float = 0.99,
    label: str = "quality",
) -> Model:
    """Train on at most about ``max_labelled`` labelled documents, and on all others by co-training.

    The labelled ones are drawn by a hash of the id, at a rate set by a count of all labels. In each of
    ``rounds`` each view scores all documents without a label, and passes on the ``growth`` it is surest
    of, with a calibrated confidence of at least ``confidence``, in the classes' labelled proportions. A null label is none; an id
    with several labels has the least. Documents without an id teach nothing; of rows that repeat one,
    the surest counts. A labelled document that is not drawn is one without a label.
    """
    given = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    given = given.groupBy("doc_id").agg(F.min(label).alias("given"))
    n_labelled = given.count()
    if not n_labelled:
        return Model(None, None)
    # At most about max_labelled rows of two numbers: bounded, whatever the tables' size.
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(n_labelled)) < max_labelled
    measured = _measured(docs, F.broadcast(given.where(drawn)))
    # Copies of a row are one example, and the order is the same on any cluster.
    entry = F.struct("given", "lang", "source", "n_chars", "text_view")
    known = measured.where("given is not null").groupBy("doc_id").agg(F.max(entry).alias("e"))
    table = known.select("doc_id", "e.*").toArrow().sort_by("doc_id")
    y = (table["given"].to_numpy() > 0).astype(float)
    if len(np.unique(y)) < 2:
        return Model(None, None)
    slots: dict[str, int] = {}
    views = _views(table, slots)
    # Every fourth labelled row of each class calibrates and is never trained on.
    held = np.concatenate([np.flatnonzero(y == c)[3::4] for c in (0, 1)])
    train = np.setdiff1d(np.arange(len(y)), held)
    rows, targets = [v[train] for v in views], [y[train], y[train]]
    passed: list[set[int]] = [set(), set()]
    share = y[train].mean()
    wanted = [max(1, round(growth * (share if label_ else 1 - share))) for _, _, label_ in KINDS]

    def fitted() -> list[Logistic]:
        models = [Logistic().fit(x, t) for x, t in zip(rows, targets)]
        for model, view in zip(models, views):
            if len(held):
                model.calibrate(view[held], y[held])
        return models

    for _ in range(rounds):
        models = fitted()
        found = _surest(measured, models, wanted, passed, math.log(confidence / (1 - confidence)))
        for kind, (_, learner, label_) in enumerate(KINDS):
            part = found.filter(pc.equal(found["kind"], kind))
            if part.num_rows:
                rows[learner] = np.vstack([rows[learner], _views(part, slots)[learner]])
                targets[learner] = np.r_[targets[learner], np.full(part.num_rows, float(label_))]
                passed[learner].update(part["doc_id"].to_pylist())
    return Model(*fitted(), prior=math.log(y.mean() / (1 - y.mean())))


def score(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """All columns of ``docs``, and text_score, metadata_score, score and keep for each row.

    Scores are probabilities of good quality; ``keep`` is score >= threshold. Null and empty texts
    are scored by what else is known. Without a trained view, scores are null and all rows are kept.
    Columns of ``docs`` named like an added one are replaced.
    """
    fields = [f for f in docs.schema if f.name not in ADDED]
    kinds = (DoubleType(), DoubleType(), DoubleType(), BooleanType())
    schema = StructType([*fields, *[StructField(n, k) for n, k in zip(ADDED, kinds)]])
    names = [f.name for f in fields]
    rows = docs.select(*[F.col(f"`{n}`") for n in names])
    if model.text is None or model.metadata is None:
        nothing = [F.lit(None).cast("double").alias(n) for n in ADDED[:3]]
        return rows.select("*", *nothing, F.lit(True).alias("keep"))
    out = to_arrow_schema(schema)
    text, *record = [names.index(n) for n in ("text", "lang", "source", "n_chars")]

    def run(batches):
        known: dict[str, int] = {}
        for part in _parts(batches):
            texts = _text_view(part.column(text).to_pylist(), known)
            around = _metadata_view([part.column(i).to_pylist() for i in record], known)
            made = [1 / (1 + np.exp(-np.clip(o, -30, 30))) for o in model.odds(texts, around)]
            columns = [*part.columns, *map(pa.array, made), pa.array(made[2] >= threshold)]
            yield pa.record_batch([c.cast(f.type) for c, f in zip(columns, out)], schema=out)

    return rows.mapInArrow(run, schema)
