"""Quality classifier by co-training.

Two views of a document are scored by two logistic models: its text (hashed words and shares of character classes)
and its metadata (source, language, stated length, and how these lie in the corpus; nothing is read from the text).
Both start from the same labelled rows. In every round each model labels all other documents and hands rows of both
classes to the other model's training set. A view's surest rows are those beyond a cut found on held-out labelled rows:
the lowest one from which on its labels are right often enough or, for a view that never gets there, its surest tenth.
A handed label counts with the lift of that cut: 1 if held-out labels beyond it are always right, 0 (nothing is
handed over) if they are no better than the class's share. At the end both views are calibrated on held-out rows and
combined into one log-odds score, which is computed for every document.

Texts are read once: features are staged in the shared folder, rounds and scores read them there. The labelled rows are
bounded: at most ``MAX_LABELLED`` of them, chosen by hash, reach the driver as features. The rows to label are all
others: every document outside the labelled sample, copies once, is a candidate in each round, and of those beyond the
cut ``HANDED`` per view and round are taken in the order of a hash of their text. Figures of the corpus cover all rows.

Defined cases: null text, source, language and n_chars count as empty or 0; a document or text with contradicting
labels is not trained on; without labels of both classes every score is 0.5 and everything is kept; equal rows get equal
scores; copies of a text are trained on once, with the least of their metadata; rows that tie at a cut are all candidates; an
empty table gives an empty result; extra columns are left alone whatever their names. Very long texts take memory in
proportion to the longest one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meldspark.llm.spans import bound_batches, chunks, row_sums, span_hashes
from meldspark.session import stage

MAX_LABELLED = 6_000
ROUNDS, HANDED = 3, 600
PRECISION, EVIDENCE = 0.98, 30
CONFIDENT_SHARE, FEWEST = 0.1, 8
HELD_OUT = 0.25
WORD_BUCKETS, SOURCE_BUCKETS, LANGUAGE_BUCKETS, LENGTH_KNOTS = 128, 64, 16, 16
KEEP_AT = 0.4

_CLASS = np.zeros(256, np.uint8)
for _kind, _bytes in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:!?'\"()-", b" \t\n\v\f\r"), 1):
    _CLASS[list(_bytes)] = _kind
_CLASS[128:] = 6
CLASSES = 7
TEXT_WIDTH = WORD_BUCKETS + CLASSES + 2


def _starts(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    first, last = offsets[:-1][offsets[:-1] < len(inside)], offsets[1:][offsets[1:] > 0] - 1
    begins[first], stops[last] = inside[first], inside[last]
    return np.flatnonzero(begins), np.flatnonzero(stops) + 1


def text_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hashed word shares, character class shares, mean word length, share of distinct words."""
    rows = len(offsets) - 1
    result = np.zeros((rows, TEXT_WIDTH), np.float32)
    if not len(data):
        return result
    kinds = _CLASS[data]
    owner = np.repeat(np.arange(rows), np.diff(offsets))
    size = np.maximum(np.diff(offsets), 1)
    shares = np.bincount(owner * CLASSES + kinds, minlength=rows * CLASSES).reshape(rows, CLASSES) / size[:, None]
    result[:, WORD_BUCKETS : WORD_BUCKETS + CLASSES] = shares
    starts, ends = _starts(kinds != 5, offsets)
    if len(starts):
        row = np.searchsorted(offsets, starts, side="right") - 1
        hashes = span_hashes(data, starts, ends)
        words = np.maximum(np.bincount(row, minlength=rows), 1)
        cells = row * WORD_BUCKETS + (hashes % np.uint64(WORD_BUCKETS)).astype(np.int64)
        result[:, :WORD_BUCKETS] = np.bincount(cells, minlength=rows * WORD_BUCKETS).reshape(rows, WORD_BUCKETS)
        result[:, :WORD_BUCKETS] = np.sqrt(result[:, :WORD_BUCKETS] / words[:, None])
        distinct = np.unique(np.stack([row.astype(np.uint64), hashes]), axis=1)[0].astype(np.int64)
        result[:, -2] = np.log1p(row_sums(ends - starts, row, rows) / words)
        result[:, -1] = np.bincount(distinct, minlength=rows) / words
    return result


class Corpus(NamedTuple):
    """Figures of the whole corpus by source and language bucket: rows, and mean and spread of the stated length."""

    rows: np.ndarray
    mean: np.ndarray
    spread: np.ndarray


def corpus_figures(features: DataFrame) -> Corpus:
    """One partial aggregate to at most 1,024 rows, over whole numbers, so that the order of rows doesn't matter."""
    length = F.col("length").cast("long")
    found = features.groupBy("source", "language").agg(
        F.count("*").alias("n"), F.sum(length).alias("s"), F.sum(length * length).alias("q")
    )
    rows, sums, squares = (np.zeros((SOURCE_BUCKETS, LANGUAGE_BUCKETS)) for _ in range(3))
    for r in found.collect():
        at = r.source, r.language
        rows[at], sums[at], squares[at] = r.n, r.s, r.q
    n = np.maximum(rows, 1)
    return Corpus(rows, sums / n, np.sqrt(np.maximum(squares / n - (sums / n) ** 2, 1.0)))


def metadata_features(source: np.ndarray, language: np.ndarray, length: np.ndarray, corpus: Corpus) -> np.ndarray:
    """Source and language buckets, stated length as a piecewise linear curve, and its place among the rows of that
    source and language; the share of the source in the corpus and of the language in the source."""
    at = np.arange(len(source))
    buckets = np.zeros((len(source), SOURCE_BUCKETS + LANGUAGE_BUCKETS), np.float32)
    buckets[at, source] = 1
    buckets[at, SOURCE_BUCKETS + language] = 1
    doublings = np.clip(length / 100 / math.log(2), 0, LENGTH_KNOTS - 1)
    curve = np.maximum(0, 1 - np.abs(doublings[:, None] - np.arange(LENGTH_KNOTS)))
    of_source = corpus.rows.sum(axis=1)
    place = (length - corpus.mean[source, language]) / corpus.spread[source, language]
    shares = (
        np.log1p(of_source[source]) - math.log1p(float(of_source.sum())),
        np.log1p(corpus.rows[source, language]) - np.log1p(of_source[source]),
    )
    return np.concatenate([buckets, curve, np.stack([place, *shares], axis=1)], axis=1).astype(np.float32)


class Model(NamedTuple):
    """A logistic model on standardised features; ``scale`` and ``shift`` calibrate its log-odds."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    bias: float
    scale: float = 1.0
    shift: float = 0.0

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        raw = (x - self.mean) / self.spread @ self.weights + self.bias
        return self.scale * np.clip(raw, -30, 30) + self.shift


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _newton(x: np.ndarray, y: np.ndarray, penalty: float, counts: np.ndarray | None = None, steps: int = 12) -> np.ndarray:
    """Weights of a penalised logistic regression of rows that count ``counts`` each; the last one, not penalised, is the bias."""
    counts = np.ones(len(y)) if counts is None else counts
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1).astype(np.float64)
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    for _ in range(steps):
        p = _sigmoid(x @ w)
        gradient = x.T @ (counts * (p - y)) + ridge * w
        hessian = (x * (counts * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(ridge)
        move = np.linalg.solve(hessian, gradient)
        w -= move * min(1.0, 5.0 / max(float(np.abs(move).max()), 1e-12))
        if float(np.abs(move).max()) < 1e-5:
            break
    return w


def train(x: np.ndarray, y: np.ndarray, counts: np.ndarray) -> Model:
    mean, spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
    w = _newton((x - mean) / spread, y, 0.01 * float(counts.sum()), counts)
    return Model(mean, spread, w[:-1].astype(np.float32), float(w[-1]))


class Cut(NamedTuple):
    """From which distance to the class's prior log-odds on a view hands over rows of a class, and what each counts."""

    distance: float
    count: float


def cut_of(model: Model, view: np.ndarray, y: np.ndarray, label: int, prior: float) -> Cut:
    """The cut for one class from held-out rows. It is above 0, so no row can be beyond those of both classes; a view
    that is right often enough labels nothing below even odds either."""
    away = model.log_odds(view) - prior
    away = away if label else -away
    right = y == label
    order = np.argsort(-away, kind="stable")
    number = np.arange(1, len(order) + 1)
    enough = np.flatnonzero((np.cumsum(right[order]) / number >= PRECISION) & (number >= EVIDENCE) & (away[order] > 0))
    if len(enough):
        even = -prior if label else prior
        distance = max(float(away[order[enough[-1]]]), even)
    else:
        surest = max(FEWEST, math.ceil(CONFIDENT_SHARE * float(right.sum())))
        distance = float(away[order[min(surest, len(order)) - 1]])
    distance = max(distance, 1e-6)
    beyond, share = away >= distance, float(right.mean())
    precision = (float(right[beyond].sum()) + 2 * share) / (float(beyond.sum()) + 2)
    return Cut(distance, max(0.0, (precision - share) / max(1 - share, 1e-9)))


def beyond_cut(model: Model, view: np.ndarray, cut: Cut, label: int, prior: float) -> np.ndarray:
    away = model.log_odds(view) - prior
    return (away if label else -away) >= cut.distance


class Handed(NamedTuple):
    """Rows that the teacher labels for the other view: keys of their texts and their features in that view."""

    teacher: int
    label: int
    keys: np.ndarray
    view: np.ndarray


class ArrayPool:
    """Unlabelled rows in memory, told apart by their place, for small tables and tests."""

    def __init__(self, text: np.ndarray, metadata: np.ndarray):
        self.views = text, metadata

    def confident(
        self, models: list[Model], cuts: list[list[Cut]], prior: float, known: list[np.ndarray], most: tuple[int, int]
    ) -> list[Handed]:
        result = []
        for teacher in range(2):
            for label in range(2):
                if cuts[teacher][label].count > 0:
                    found = np.flatnonzero(beyond_cut(models[teacher], self.views[teacher], cuts[teacher][label], label, prior))
                    keys = found[~np.isin(found, known[1 - teacher])][: most[label]]
                    result.append(Handed(teacher, label, keys, self.views[1 - teacher][keys]))
        return result


class CoTrained(NamedTuple):
    views: tuple[Model, Model]
    mix: np.ndarray  # weights of both calibrated views, then the bias
    exchanged: tuple = ()  # (round, teaching view, label, rows handed over, what each counts)

    def score(self, text: np.ndarray, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, b = self.views[0].log_odds(text), self.views[1].log_odds(metadata)
        return _sigmoid(a), _sigmoid(b), _sigmoid(self.mix[0] * a + self.mix[1] * b + self.mix[2])


def co_train(labelled: tuple[np.ndarray, np.ndarray], y: np.ndarray, pool, rounds: int = ROUNDS) -> CoTrained | None:
    """Both views, trained in turns; None if a class is missing. ``pool`` finds confident rows among the unlabelled ones: the
    two feature matrices of an ``ArrayPool``, or a ``CorpusPool``."""
    pool = ArrayPool(*pool) if isinstance(pool, tuple) else pool
    held = np.arange(len(y)) % max(2, round(1 / HELD_OUT)) == 0
    if len({*y[~held].tolist()}) < 2 or len({*y[held].tolist()}) < 2:
        return None
    sets = [(view[~held], y[~held], np.ones(int((~held).sum()))) for view in labelled]
    good = float(y[~held].mean())
    prior = math.log(good / (1 - good))
    most = max(1, round(HANDED * (1 - good))), max(1, round(HANDED * good))
    known = [np.zeros(0, np.int64), np.zeros(0, np.int64)]  # keys already handed to each view
    models, exchanged = [train(*s) for s in sets], []
    for number in range(rounds):
        cuts = [[cut_of(m, v[held], y[held], label, prior) for label in range(2)] for m, v in zip(models, labelled)]
        for handed in pool.confident(models, cuts, prior, known, most):
            learner, count = 1 - handed.teacher, cuts[handed.teacher][handed.label].count
            x, labels, counts = sets[learner]
            n = len(handed.keys)
            sets[learner] = (
                np.concatenate([x, handed.view]),
                np.concatenate([labels, np.full(n, float(handed.label))]),
                np.concatenate([counts, np.full(n, count)]),
            )
            known[learner] = np.concatenate([known[learner], handed.keys])
            exchanged.append((number, handed.teacher, handed.label, n, round(count, 4)))
        models = [train(*s) for s in sets]
    calibrated = []
    for model, view in zip(models, labelled):
        w = _newton(model.log_odds(view[held])[:, None], y[held], penalty=1.0)
        calibrated.append(model._replace(scale=max(float(w[0]), 0.0), shift=float(w[1])))
    both = np.stack([m.log_odds(v[held]) for m, v in zip(calibrated, labelled)], axis=1)
    return CoTrained((calibrated[0], calibrated[1]), _newton(both, y[held], penalty=1.0), tuple(exchanged))


FEATURES = "doc_id long, key long, source int, language int, length int, x binary"


def features_of(docs: DataFrame) -> DataFrame:
    """(doc_id, key, source, language, length, x) of every document, written once: a hash of the text, the buckets,
    hundredths of the logarithm of the stated length, and the text features as float32."""
    bound_batches(docs.sparkSession)
    chars = F.greatest(F.coalesce(F.col("n_chars").cast("double"), F.lit(0.0)), F.lit(0.0))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"),
        F.pmod(F.xxhash64(F.coalesce("source", F.lit(""))), F.lit(SOURCE_BUCKETS)).cast("int").alias("source"),
        F.pmod(F.xxhash64(F.coalesce("lang", F.lit(""))), F.lit(LANGUAGE_BUCKETS)).cast("int").alias("language"),
        F.floor(F.log1p(chars) * 100).cast("int").alias("length"),
        "text",
    )

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in chunks(batches, "text"):
            x = pa.array([row.tobytes() for row in text_features(data, offsets)], pa.binary())
            names = ["doc_id", "key", "source", "language", "length"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), x], [*names, "x"])

    return stage(rows.mapInArrow(compute, FEATURES), "quality-features")


def _views(batch: pa.RecordBatch, corpus: Corpus) -> tuple[np.ndarray, np.ndarray]:
    """Both feature matrices of staged rows."""
    text = np.frombuffer(b"".join(batch.column("x").to_pylist()), np.float32).reshape(-1, TEXT_WIDTH)
    return text, metadata_features(*(batch.column(n).to_numpy() for n in ("source", "language", "length")), corpus)


CANDIDATES = "teacher int, label int, key long, source int, language int, length int, x binary"


class CorpusPool:
    """All staged rows whose text is not among the labelled ones."""

    def __init__(self, features: DataFrame, corpus: Corpus, labelled: np.ndarray):
        self.features, self.corpus, self.labelled = features, corpus, labelled

    def confident(
        self, models: list[Model], cuts: list[list[Cut]], prior: float, known: list[np.ndarray], most: tuple[int, int]
    ) -> list[Handed]:
        """Of the rows beyond a cut those with the smallest keys. Every task keeps its own smallest; the same text from
        several tasks counts once; only then the smallest of all are taken. A text labelled both ways is left out."""
        corpus, out = self.corpus, [np.union1d(self.labelled, k) for k in known]
        kinds = [(t, label) for t in range(2) for label in range(2) if cuts[t][label].count > 0]

        def nominate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = {}
            for batch in batches:
                if not batch.num_rows:
                    continue
                views = _views(batch, corpus)
                fresh = [~np.isin(batch.column("key").to_numpy(), keys) for keys in out]
                for teacher, label in kinds:
                    sure = beyond_cut(models[teacher], views[teacher], cuts[teacher][label], label, prior)
                    found = pa.Table.from_batches([batch.filter(pa.array(sure & fresh[1 - teacher]))])
                    if (teacher, label) in best:
                        found = pa.concat_tables([best[teacher, label], found])
                    best[teacher, label] = _smallest(found, most[label])
            for (teacher, label), rows in best.items():
                for batch in rows.combine_chunks().to_batches():
                    marks = [pa.array(np.full(batch.num_rows, mark, np.int32)) for mark in (teacher, label)]
                    names = ["key", "source", "language", "length", "x"]
                    yield pa.RecordBatch.from_arrays(
                        [*marks, *(batch.column(n) for n in names)], ["teacher", "label", *names]
                    )

        rows = self.features.mapInArrow(nominate, CANDIDATES)
        rows = rows.groupBy("teacher", "label", "key").agg(F.min(F.struct("source", "language", "length", "x")).alias("row"))
        place = F.row_number().over(Window.partitionBy("teacher", "label").orderBy("key"))
        rows = rows.withColumn("place", place).filter(
            F.col("place") <= F.when(F.col("label") == 1, most[1]).otherwise(most[0])
        )
        chosen = sorted(rows.select("teacher", "label", "key", "row.*").collect(), key=lambda r: (r.teacher, r.label, r.key))
        sides = {}
        for r in chosen:
            sides.setdefault((r.teacher, r.key), set()).add(r.label)
        result = []
        for teacher, label in kinds:
            mine = [r for r in chosen if (r.teacher, r.label) == (teacher, label) and len(sides[teacher, r.key]) == 1]
            keys = np.array([r.key for r in mine], np.int64)
            result.append(Handed(teacher, label, keys, _collected(mine, corpus)[1 - teacher]))
        return result


def _smallest(rows: pa.Table, most: int) -> pa.Table:
    """The rows of the ``most`` smallest keys, one a key: the one with the least metadata."""
    rows = rows.sort_by([(n, "ascending") for n in ("key", "source", "language", "length")])
    keys = rows.column("key").to_numpy()
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    return rows.take(pa.array(np.flatnonzero(first)[:most]))


def _collected(rows: list, corpus: Corpus) -> tuple[np.ndarray, np.ndarray]:
    text = np.frombuffer(b"".join(bytes(r.x) for r in rows), np.float32).reshape(-1, TEXT_WIDTH)
    parts = (np.array([r[n] for r in rows], np.int64) for n in ("source", "language", "length"))
    return text, metadata_features(*parts, corpus)


def labelled_rows(features: DataFrame, labels: DataFrame, label: str) -> list:
    """At most ``MAX_LABELLED`` labelled rows, one a text, in an order fixed by hashes. Documents are chosen by a hash of
    their id; if ids repeat, the rows by a hash of all they hold."""
    known = labels.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.min(label).alias("label"), F.max(label).alias("_other"))
    known = known.filter((F.col("label") == F.col("_other")) & F.col("_id").isNotNull()).drop("_other")
    chosen = known.orderBy(F.xxhash64(F.lit(5), "_id"), "_id").limit(MAX_LABELLED)  # ids and labels only, so it is broadcast
    rows = features.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    rows = rows.select("key", F.col("label").cast("double").alias("label"), "source", "language", "length", "x")
    rows = rows.groupBy("key").agg(
        F.min("label").alias("label"), F.max("label").alias("_other"), F.min(F.struct("source", "language", "length", "x")).alias("row")
    )
    rows = rows.filter(F.col("label") == F.col("_other")).select("key", "label", "row.*")
    rows = rows.orderBy(F.xxhash64(F.lit(11), "key"), "key").limit(MAX_LABELLED)
    return rows.collect()


def fit(features: DataFrame, corpus: Corpus, labels: DataFrame, label: str = "quality") -> CoTrained | None:
    """The classifier, trained on a bounded sample of the labels and on rows handed over from all other documents."""
    seen = labelled_rows(features, labels, label)
    if len(seen) < 8:
        return None
    pool = CorpusPool(features, corpus, np.array([r.key for r in seen], np.int64))
    return co_train(_collected(seen, corpus), np.array([r.label for r in seen]), pool)


SCORE_SCHEMA = "doc_id long, text_score double, metadata_score double, score double, kept boolean"


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality", keep_at: float = KEEP_AT) -> DataFrame:
    """(doc_id, text_score, metadata_score, score, kept) of every document; scores are probabilities of quality 1."""
    features = features_of(docs)
    corpus = corpus_figures(features)
    model = fit(features, corpus, labels, label)
    if model is None:
        even = [F.lit(0.5).alias(name) for name in ("text_score", "metadata_score", "score")]
        return features.select("doc_id", *even, F.lit(0.5 >= keep_at).alias("kept"))
    shared = docs.sparkSession.sparkContext.broadcast((model, corpus))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, corpus = shared.value
        for batch in batches:
            views = model.score(*_views(batch, corpus))
            scores = [pa.array(np.round(v, 9).astype(np.float64)) for v in views]
            kept = pa.array(np.asarray(views[2]) >= keep_at)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *scores, kept], ["doc_id", "text_score", "metadata_score", "score", "kept"]
            )

    return features.mapInArrow(score, SCORE_SCHEMA)
