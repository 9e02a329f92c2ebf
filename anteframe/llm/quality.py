"""Text quality by nearest-neighbour voting in a latent-semantic space.

Terms of a text are hashed trigrams of its letters and of its character kinds, and how often words
and lines repeat. A singular value decomposition of the labelled sample gives the latent space.
The labelled vectors, a bounded number, go to every task; each document's exact cosine with all of
them is computed in blocks, and the labels of the nearest are weighted by similarity.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._sample import labelled
from ._store import ready
from ._text import BLANKS, LOWER, Words, pieces, previous, text_bytes

#: Labelled documents of each label that are learned from.
SAMPLE = 3000
DIMENSIONS = 48
NEIGHBOURS = 15
LETTER_TERMS, KIND_TERMS = 1024, 1024
TERMS = LETTER_TERMS + KIND_TERMS + 3

_KIND = np.full(256, 39, np.int64)
_KIND[128:] = 38
_KIND[ord("a") : ord("z") + 1] = 1
_KIND[ord("A") : ord("Z") + 1] = 2
_KIND[ord("0") : ord("9") + 1] = 3
_KIND[ord(" ")], _KIND[ord("\n")] = 4, 5
for _at, _c in enumerate("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"):
    _KIND[ord(_c)] = 6 + _at


def trigrams(codes: np.ndarray, off: np.ndarray, base: int, size: int) -> np.ndarray:
    """A term for each place: this code and the two before it, in the same text."""
    last = previous(codes, off, 0)
    return ((codes + base * (last + base * previous(last, off, 0))) * 2654435761 >> 12) % size


def term_counts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Logarithmic term counts, one row for each text."""
    n = len(off) - 1
    row = np.repeat(np.arange(n), np.diff(off))
    out = np.zeros((n, TERMS), np.float32)
    letters = row * LETTER_TERMS + trigrams(LOWER[data].astype(np.int64), off, 256, LETTER_TERMS)
    out[:, :LETTER_TERMS] = np.bincount(letters, minlength=n * LETTER_TERMS).reshape(n, -1)
    kinds = row * KIND_TERMS + trigrams(_KIND[data], off, 40, KIND_TERMS)
    out[:, LETTER_TERMS:-3] = np.bincount(kinds, minlength=n * KIND_TERMS).reshape(n, -1)
    words = Words(data, off, BLANKS)
    of = np.repeat(np.arange(n), words.counts)
    same = np.zeros(len(of), bool)
    same[1:] = (words.hash[1:] == words.hash[:-1]) & (of[1:] == of[:-1])
    out[:, -3] = np.bincount(of, same, n)
    order = np.lexsort((words.hash, of))
    again = np.zeros(len(of), bool)
    again[1:] = (words.hash[order][1:] == words.hash[order][:-1]) & (of[order][1:] == of[order][:-1])
    out[:, -2] = np.bincount(of[order], again, n)
    out[:, -1] = words.counts
    return np.log1p(out)


@dataclass
class Model:
    """What a task needs: weights of terms, the latent space, and the labelled vectors in it."""

    weight: np.ndarray
    space: np.ndarray
    vectors: np.ndarray
    votes: np.ndarray
    labels: np.ndarray
    prior: float

    def project(self, counts: np.ndarray) -> np.ndarray:
        seen = counts[:, -1] > 0
        rows = counts * self.weight
        rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)
        rows = rows @ self.space
        rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)
        return np.where(seen[:, None], rows, 0).astype(np.float32)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Weighted share of label 1 among the nearest; the prior where no neighbour is near."""
        out = np.full(len(counts), self.prior)
        rows = self.project(counts)
        k = min(NEIGHBOURS, len(self.labels))
        if not k:
            return out
        for i in range(0, len(rows), 256):
            near = rows[i : i + 256] @ self.vectors.T
            best = np.argpartition(near, len(self.labels) - k, axis=1)[:, -k:]
            weight = np.maximum(np.take_along_axis(near, best, 1), 0) ** 4 * self.votes[best]
            total = weight.sum(axis=1)
            found = (weight * self.labels[best]).sum(axis=1)
            out[i : i + 256] = np.where(total > 0, found / np.where(total > 0, total, 1), self.prior)
        return out


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Model:
    """Learns from about ``sample`` rows of each label; labels 0 and 1, others are not looked at."""
    ready(docs.sparkSession)
    drawn, counts = labelled(docs, labels.where(F.col(label).isin(0, 1)), label, sample)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            rows = term_counts(*text_bytes(batch.column("text")))
            at = [np.flatnonzero(r) for r in rows]
            yield pa.record_batch(
                [batch.column("label"), pa.array([x.astype(np.int32) for x in at], pa.list_(pa.int32())),
                 pa.array([r[x] for r, x in zip(rows, at, strict=True)], pa.list_(pa.float32()))],
                ["label", "at", "count"],
            )

    found = drawn.select("text", F.col("label").cast("int").alias("label")).mapInArrow(run, "label int, at array<int>, count array<float>").toArrow()
    rows = np.zeros((found.num_rows, TERMS), np.float32)
    for i, (at, count) in enumerate(zip(found.column("at"), found.column("count"), strict=True)):
        rows[i, at.values.to_numpy()] = count.values.to_numpy()
    y = found.column("label").to_numpy().astype(float) if found.num_rows else np.zeros(0)
    total = sum(counts.values())
    prior = counts.get(1, 0) / total if total else 0.5
    weight = np.log((1 + len(rows)) / (1 + (rows > 0).sum(axis=0))).astype(np.float32) + 0.1
    scaled = rows * weight
    scaled /= np.maximum(np.linalg.norm(scaled, axis=1, keepdims=True), 1e-9)
    space = np.linalg.eigh((scaled.T @ scaled).astype(np.float64))[1][:, ::-1][:, :DIMENSIONS].astype(np.float32)
    seen = {v: max(1, int((y == v).sum())) for v in (0, 1)}
    votes = np.where(y == 1, counts.get(1, 0) / seen[1], counts.get(0, 0) / seen[0])
    model = Model(weight, space, np.zeros((0, DIMENSIONS), np.float32), votes, y, prior)
    model.vectors = model.project(rows)
    return model


def scored(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.3) -> DataFrame:
    """One row per document: doc_id, score (0 to 1), predicted (1 if score >= threshold).

    A null or blank text has no neighbours and gets the share of label 1 among all labels, as does
    every text if nothing was learned (0.5 then). Rows that repeat are returned as often as they
    come. Other columns are not looked at.
    """
    ready(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            score = model.score(term_counts(*text_bytes(batch.column("text"))))
            yield pa.record_batch([batch.column("doc_id"), pa.array(np.clip(score, 0.0, 1.0))], ["doc_id", "score"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    out = rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def accepted(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, with all columns, whose text scores at least ``threshold``."""
    ready(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            yield batch.filter(pa.array(model.score(term_counts(*text_bytes(batch.column(text)))) >= threshold))

    return docs.mapInArrow(run, docs.schema)
