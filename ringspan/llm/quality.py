"""Text quality from random-indexing word vectors and a small neural network.

Every word has a sparse random index vector; its word vector is the sum of the index vectors of the words
near it, over all documents. A document is the mean of its words' vectors, beside the largest means of its
stretches. A two-layer network learns from a bounded sample of labelled documents, and its outputs are
scaled by a temperature fitted on documents it has not learned from, so that scores are probabilities.

Words are hashed to a fixed number of rows, so the vectors have a fixed size whatever the corpus; counting
is exact in integers and does not depend on how the rows are split into tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringspan.llm.common import documents_of, small_batches
from ringspan.llm.hashing import byte_table, mix, words

ROWS = 1 << 14  # word vectors
DIMENSIONS = 48
NONZERO = 4  # of an index vector
NEAR = 2  # words on either side
STRETCH = 100  # words of a stretch
SAMPLE = 20_000  # labelled documents the network learns from, at most
THRESHOLD = 0.7
_CHUNK = 256  # word vectors in one row between tasks

_LETTERS = bytes(b for b in range(256) if chr(b).isalnum() and b < 0x80 or b >= 0x80 or b == 0x5F)
_SIGNS = bytes(b for b in range(0x21, 0x7F) if b not in _LETTERS)
_KINDS = byte_table(word=_LETTERS, sign=_SIGNS)
# Upper case is kept: shouting is a matter of quality.
_AS_IS = np.arange(256, dtype=np.uint8)
_AGAIN = np.uint64(0x5851F42D4C957F2D)  # marks a word that repeats the one before


def _tokens(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For blocks of texts: each word's document, row of the vectors and piece. A repeated word has its own row."""
    for rows, hashes, _, pieces in words(column, _KINDS, _AS_IS):
        again = np.zeros(len(hashes), bool)
        again[1:] = (hashes[1:] == hashes[:-1]) & (pieces[1:] == pieces[:-1])
        yield rows, (np.where(again, _AGAIN, hashes) % np.uint64(ROWS)).astype(np.int64), pieces


def _index_vectors(seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero elements of every row's index vector."""
    numbers = mix(np.arange(ROWS * NONZERO, dtype=np.uint64) + np.uint64(seed << 32)).reshape(ROWS, NONZERO)
    places = (numbers % np.uint64(DIMENSIONS)).astype(np.int64)
    return places, np.where(numbers >> np.uint64(63), 1, -1)


def _contexts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's sums of index vectors, in rows of ``_CHUNK`` word vectors each."""
    places, signs = _index_vectors()
    sums = np.zeros(ROWS * DIMENSIONS, np.int64)
    counts = np.zeros(ROWS, np.int64)
    for batch in small_batches(batches, 2 << 20):
        for _, ids, pieces in _tokens(batch.column("text")):
            counts += np.bincount(ids, minlength=ROWS)
            for step in range(1, NEAR + 1):
                near = pieces[step:] == pieces[:-step]
                left, right = ids[:-step][near], ids[step:][near]
                for word, other in ((left, right), (right, left)):
                    for n in range(NONZERO):
                        added = np.bincount(
                            word * DIMENSIONS + places[other, n], signs[other, n], minlength=len(sums)
                        )
                        sums += added.astype(np.int64)
    table = np.column_stack([counts, sums.reshape(ROWS, DIMENSIONS)]).reshape(ROWS // _CHUNK, -1)
    used = np.flatnonzero(table.any(axis=1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(used, pa.int32()), pa.array([table[at].tobytes() for at in used], pa.binary())],
        names=["chunk", "sums"],
    )


def _add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums per chunk of all rows of a task, one row at a time."""
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, sums in zip(batch.column("chunk").to_pylist(), batch.column("sums")):
            added = np.frombuffer(sums.as_buffer(), np.int64)
            if chunk in totals:
                totals[chunk] += added
            else:
                totals[chunk] = added.copy()
    yield pa.RecordBatch.from_arrays(
        [pa.array(totals.keys(), pa.int32()), pa.array([t.tobytes() for t in totals.values()], pa.binary())],
        names=["chunk", "sums"],
    )


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The word vectors of all documents, ``ROWS`` by ``DIMENSIONS``, of unit length (or zero).

    What reaches the driver has a fixed size. Vectors are scaled by what is expected of a frequent word's
    neighbours, so that words common everywhere do not hide the rest.
    """
    chunk = "chunk int, sums binary"
    parts = docs.select(F.col(f"`{text_col}`").cast("string").alias("text")).where("text <> ''")
    sums = parts.mapInArrow(_contexts, chunk)
    # Two steps, so that a task adds up the rows of some tasks only, and each chunk's few totals after that.
    some = sums.repartition("chunk", F.pmod(F.xxhash64("sums"), F.lit(8))).mapInArrow(_add_up, chunk)
    totals = some.repartition("chunk").mapInArrow(_add_up, chunk)
    table = np.zeros((ROWS, DIMENSIONS + 1))
    for row in totals.toLocalIterator():
        table[row["chunk"] * _CHUNK : (row["chunk"] + 1) * _CHUNK] += np.frombuffer(row["sums"], np.int64).reshape(
            _CHUNK, DIMENSIONS + 1
        )
    counts, vectors = table[:, :1], table[:, 1:]
    common = vectors.sum(axis=0) / max(1.0, counts.sum())
    vectors = vectors - counts * common
    lengths = np.sqrt((vectors**2).sum(axis=1, keepdims=True))
    return (vectors / np.where(lengths > 0, lengths, 1)).astype(np.float32)


FEATURES = 3 * DIMENSIONS + 1


def features(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """A row per text: mean, largest and smallest stretch means of its words' vectors, log of its words."""
    size = len(column)
    total, count = np.zeros((size, DIMENSIONS)), np.zeros(size)
    high, low = np.full((size, DIMENSIONS), -np.inf), np.full((size, DIMENSIONS), np.inf)
    for rows, ids, pieces in _tokens(column):
        if not len(ids):
            continue
        # Stretches of equal length, counted from the beginning of each piece of a text.
        firsts = np.flatnonzero(np.diff(pieces, prepend=-1))
        inside = np.arange(len(ids)) - np.repeat(firsts, np.diff(np.append(firsts, len(ids))))
        starts = np.flatnonzero(inside % STRETCH == 0)
        sums = np.add.reduceat(vectors[ids], starts, axis=0)
        lengths = np.diff(np.append(starts, len(ids)))
        owner = rows[starts]
        np.add.at(total, owner, sums)
        np.add.at(count, owner, lengths)
        # A short last stretch says little: it is drawn towards zero.
        means = sums / np.maximum(lengths, STRETCH // 4)[:, None]
        np.maximum.at(high, owner, means)
        np.minimum.at(low, owner, means)
    empty = count == 0
    high[empty] = low[empty] = 0
    mean = total / np.maximum(count, 1)[:, None]
    return np.column_stack([mean, high, low, np.log1p(count)]).astype(np.float32)


@dataclass
class Network:
    """Two layers over standardised features; ``temperature`` divides the output before the logistic."""

    mean: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum(((x - self.mean) / self.scale) @ self.first + self.first_bias, 0)
        return hidden @ self.second + self.second_bias

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def train(x: np.ndarray, y: np.ndarray, hidden: int = 24, epochs: int = 40, seed: int = 5) -> Network:
    """Fit on four fifths of the rows, keep the best epoch for the rest, and fit the temperature there.

    Without rows all scores are 0.5; with one class only they tend to its share.
    """
    rng = np.random.default_rng(seed)
    x, y = x.astype(np.float64), y.astype(np.float64)
    share = (y.sum() + 0.5) / (len(y) + 1)
    net = Network(
        x.mean(axis=0) if len(x) else np.zeros(FEATURES),
        x.std(axis=0) + 1e-3 if len(x) else np.ones(FEATURES),
        rng.normal(0, np.sqrt(2 / FEATURES), (FEATURES, hidden)),
        np.zeros(hidden),
        np.zeros(hidden),
        float(np.log(share / (1 - share))),
    )
    if len(set(y.tolist())) < 2:
        return net
    net.second = rng.normal(0, np.sqrt(1 / hidden), hidden)
    order = rng.permutation(len(x))
    held, used = order[: len(x) // 5], order[len(x) // 5 :]
    weights = [net.first, net.first_bias, net.second, np.array([net.second_bias])]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    standard = (x - net.mean) / net.scale
    best, best_weights, step = np.inf, [w.copy() for w in weights], 0
    for _ in range(epochs):
        rng.shuffle(used)
        for at in range(0, len(used), 128):
            rows = used[at : at + 128]
            inner = standard[rows] @ weights[0] + weights[1]
            active = np.maximum(inner, 0)
            error = (1 / (1 + np.exp(-np.clip(active @ weights[2] + weights[3][0], -40, 40))) - y[rows]) / len(rows)
            back = np.outer(error, weights[2]) * (inner > 0)
            slopes = [
                standard[rows].T @ back + 1e-4 * weights[0],
                back.sum(axis=0),
                active.T @ error + 1e-4 * weights[2],
                np.array([error.sum()]),
            ]
            step += 1
            for w, slope, (m, v) in zip(weights, slopes, moments):
                m += 0.1 * (slope - m)
                v += 0.001 * (slope**2 - v)
                w -= 2e-3 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        net.second_bias = float(weights[3][0])
        loss = _loss(net.logits(x[held]), y[held]) if len(held) else 0.0
        if loss < best:
            best, best_weights = loss, [w.copy() for w in weights]
    net.first, net.first_bias, net.second, bias = best_weights
    net.second_bias = float(bias[0])
    if len(held):
        logits = net.logits(x[held])
        net.temperature = float(min(np.geomspace(0.25, 8, 61), key=lambda t: _loss(logits / t, y[held])))
    return net


def _loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - y * logits))


@dataclass
class QualityModel:
    vectors: np.ndarray
    network: Network

    def score(self, column: pa.Array) -> np.ndarray:
        return self.network.scores(features(column, self.vectors))


def _is_held_out(doc_id: F.Column) -> F.Column:
    """Whether the id belongs to the documents that labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample: int = SAMPLE,
) -> QualityModel:
    """Word vectors from all documents, the network from at most ``sample`` labelled ones outside the fold.

    The sample is the labelled ids with the smallest hashes; a document with several labels counts by the
    lowest. Rows with NULL ids or labels teach nothing.
    """
    vectors = word_vectors(docs, text_col)
    doc_id, label = F.col(f"`{id_col}`").cast("long"), F.col(f"`{label_col}`").cast("int")
    chosen = (
        labels.where(doc_id.isNotNull() & label.isin(0, 1) & ~_is_held_out(doc_id))
        .groupBy(doc_id.alias("doc_id"))
        .agg(F.min(label).alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def pooled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 2 << 20):
            x = features(batch.column("text"), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array([r.tobytes() for r in x], pa.binary())],
                names=["doc_id", "label", "x"],
            )

    # At most ``sample`` small rows are broadcast.
    rows = documents_of(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")
    # One row per id, whatever repeats there are, in an order that does not depend on the tasks.
    learned = (
        rows.mapInArrow(pooled, "doc_id long, label int, x binary")
        .groupBy("doc_id")
        .agg(F.min(F.struct("x", "label")).alias("row"))
        .orderBy("doc_id")
        .select("row.label", "row.x")
        .collect()
    )
    x = np.frombuffer(b"".join(r["x"] for r in learned), np.float32).reshape(-1, FEATURES)
    return QualityModel(vectors, train(x, np.array([r["label"] for r in learned], np.float64)))


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    threshold: float = THRESHOLD,
    sample: int = SAMPLE,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row; a NULL text is scored as an empty one."""
    model = fit(docs, labels, id_col, text_col, label_col, sample)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 2 << 20):
            scores = shared.value.score(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"]
            )

    scored = documents_of(docs, id_col, text_col).mapInArrow(score, "doc_id long, score double")
    return scored.select(
        "doc_id",
        _is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    threshold: float = THRESHOLD,
    sample: int = SAMPLE,
) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with their columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col, label_col, sample))
    # The whole row travels as one value, so no column name can clash; a text goes in it and not once more beside it,
    # which would double the batches that Spark and Python hold at the same time.
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    inside = text_col in docs.columns and docs.schema[text_col].dataType.typeName() == "string"
    place = docs.columns.index(text_col) if inside else None
    rows = docs.select(whole, *([] if inside else [F.col(f"`{text_col}`").cast("string").alias("text")]))

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1 << 20 if inside else 2 << 20):
            columns = batch.column("row").flatten()
            texts = columns[place] if inside else batch.column("text")
            scores = shared.value.score(texts.fill_null(""))
            yield pa.RecordBatch.from_arrays(columns, names=docs_columns).filter(pa.array(scores >= threshold))

    docs_columns = docs.columns
    return rows.mapInArrow(keep, docs.schema)
