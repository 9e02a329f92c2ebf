"""Toxicity of texts: gradient-boosted trees over dense features, with isotonic calibration.

The lexicon is learned: words and word beginnings that toxic texts of the labelled sample hold far
more often than others. Features are how dense lexicon words are, how strong, and how near the
second person; shares of capitals, exclamation and other marks; and words whose letters are mixed
with digits or marks. Trees grow on feature bins; isotonic regression on texts the trees have not
seen turns their sum into a probability.
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
from ._text import BLANKS, LOWER, NOT_ALNUM, Words, pieces, span_hash, text_bytes

#: Labelled documents of each label that are learned from, and lexicon entries.
SAMPLE = 5000
LEXICON = 3000
#: Bytes of a word's beginning that count as an entry of their own; 0 is the whole word.
BEGINNINGS = (0, 4, 5, 6, 7)
#: Words of the second person that come before or after what is said to somebody. Fixed values.
SECOND_PERSON = "you your you're u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre tú ti tus usted ustedes vosotros"
NEAR = 5
TREES, DEPTH, RATE, BINS = 80, 3, 0.2, 32

_MARK = np.zeros(256, bool)
_MARK[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
_PLAIN_MARK = np.zeros(256, bool)
_PLAIN_MARK[[ord(c) for c in ".,;:'\"()?-!"]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[c for c in range(128) if chr(c).isalpha()]] = True
_LETTER[128:] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[ord("A") : ord("Z") + 1] = True


def entry_hashes(data: np.ndarray, words: Words) -> Iterator[np.ndarray]:
    """For each kind of entry a hash of each word; a word no longer than a beginning has none (0)."""
    low = LOWER[data]
    for kind, size in enumerate(BEGINNINGS):
        ends = words.ends if size == 0 else np.minimum(words.starts + size, words.ends)
        found = (words.hash if size == 0 else span_hash(low, words.starts, ends)) ^ np.uint64(kind)
        yield found if size == 0 else np.where(words.ends - words.starts > size, found, np.uint64(0))


def per_text(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0.0], np.cumsum(mask, dtype=np.float64)))
    return sums[off[1:]] - sums[off[:-1]]


@dataclass
class Lexicon:
    hashes: np.ndarray
    weights: np.ndarray

    def features(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        words = Words(data, off, NOT_ALNUM)
        n = np.maximum(words.counts, 1)
        size = np.maximum(np.diff(off), 1)
        weight = np.zeros(len(words.hash))
        if len(self.hashes):
            for found in entry_hashes(data, words):
                at = np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)
                np.maximum(weight, np.where(self.hashes[at] == found, self.weights[at], 0), out=weight)
        strong = np.concatenate(([0.0], np.cumsum(weight > 0)))
        person = np.flatnonzero(np.isin(words.hash, _person()))
        of = np.searchsorted(words.off, person, "right") - 1
        around = strong[np.minimum(person + NEAR + 1, words.off[of + 1])] - strong[np.maximum(person - NEAR, words.off[of])]
        near = np.bincount(of, around, len(off) - 1) if len(of) else np.zeros(len(off) - 1)
        hits, force = per_text(weight > 0, words.off), per_text(weight, words.off)
        peak = np.zeros(len(off) - 1)
        filled = words.counts > 0
        if filled.any():
            peak[filled] = np.maximum.reduceat(weight, words.off[:-1][filled])
        letters = np.maximum(per_text(_LETTER[data], off), 1)
        inner = np.zeros(len(data), bool)
        if len(data) > 2:
            inner[1:-1] = ~_LETTER[data[1:-1]] & ~BLANKS[data[1:-1]] & ~_PLAIN_MARK[data[1:-1]] & _LETTER[data[:-2]] & _LETTER[data[2:]]
        return np.stack(
            [
                hits, hits / n, force, force / n, peak, near, near / n,
                per_text(person_mask(len(words.hash), person), words.off) / n,
                per_text(_CAPITAL[data], off) / letters, per_text(data == ord("!"), off) / size,
                per_text(_MARK[data], off) / size, per_text(inner, off) / n, np.log1p(n),
            ],
            axis=1,
        )


def person_mask(n: int, at: np.ndarray) -> np.ndarray:
    mask = np.zeros(n, bool)
    mask[at] = True
    return mask


def _person() -> np.ndarray:
    data, off = text_bytes(pa.array([SECOND_PERSON]))
    return Words(data, off, NOT_ALNUM).hash


class Trees:
    """Boosted trees of one depth for a 0/1 target, grown on bins of each feature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        n, width = x.shape
        self.edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)]
        bins = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(self.edges)], 1)
        mean = np.clip((y * weight).sum() / weight.sum(), 0.01, 0.99)
        self.start = float(np.log(mean / (1 - mean)))
        self.feature, self.cut, self.leaf = [], [], []
        total = np.full(n, self.start)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-total))
            pull, curve = (y - p) * weight, np.maximum(p * (1 - p), 1e-6) * weight
            node = np.zeros(n, int)
            feature, cut = np.zeros(2**DEPTH - 1, int), np.full(2**DEPTH - 1, np.inf)
            for level in range(DEPTH):
                nodes, first = 2**level, 2**level - 1
                best = np.zeros(nodes)
                for f in range(width):
                    at = (node - first) * BINS + bins[:, f]
                    g = np.bincount(at, pull, nodes * BINS).reshape(nodes, BINS).cumsum(1)
                    h = np.bincount(at, curve, nodes * BINS).reshape(nodes, BINS).cumsum(1)
                    left, right = g**2 / (h + 1), (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + 1)
                    gain = left + right - g[:, -1:] ** 2 / (h[:, -1:] + 1)
                    gain = gain[:, : len(self.edges[f])]
                    if not gain.shape[1]:
                        continue
                    where = gain.argmax(1)
                    for k in np.flatnonzero(gain.max(1) > best + 1e-9):
                        best[k] = gain[k, where[k]]
                        feature[first + k], cut[first + k] = f, self.edges[f][where[k]]
                node = 2 * node + 1 + (x[np.arange(n), feature[node]] > cut[node])
            leaf = node - (2**DEPTH - 1)
            value = RATE * np.bincount(leaf, pull, 2**DEPTH) / (np.bincount(leaf, curve, 2**DEPTH) + 1)
            self.feature.append(feature)
            self.cut.append(cut)
            self.leaf.append(value)
            total += value[leaf]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.start), np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), int)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - (2**DEPTH - 1)]
        return total


def isotonic(value: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising steps nearest to ``y``: neighbours that fall are pooled."""
    order = np.argsort(value, kind="stable")
    at, start = np.unique(value[order], return_index=True)
    mass = np.add.reduceat(weight[order], start)
    mean = np.add.reduceat((y * weight)[order], start) / mass
    pools: list[list[float]] = []
    for v, m, w in zip(at, mean, mass, strict=True):
        pools.append([m, w, v, v])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            m1, w1, _, high = pools.pop()
            m0, w0, low, _ = pools.pop()
            pools.append([(m0 * w0 + m1 * w1) / (w0 + w1), w0 + w1, low, high])
    return np.array([x for p in pools for x in p[2:]]), np.repeat([p[0] for p in pools], 2)


@dataclass
class Model:
    lexicon: Lexicon
    trees: Trees | None
    steps: tuple[np.ndarray, np.ndarray]
    prior: float

    def score(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(off) - 1, self.prior)
        return np.clip(np.interp(self.trees(self.lexicon.features(data, off)), *self.steps), 0, 1)


def learn_lexicon(drawn: DataFrame) -> Lexicon:
    """Entries that are in at least three toxic texts and far more often there, with log odds."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            data, off = text_bytes(batch.column("text"))
            words = Words(data, off, NOT_ALNUM)
            label = batch.column("label").to_numpy()
            seen, toxic = [], []
            for found in entry_hashes(data, words):
                for r in range(batch.num_rows):
                    own = np.unique(found[words.off[r] : words.off[r + 1]])
                    own = own[own != 0]
                    seen.append(own)
                    toxic.append(np.full(len(own), label[r]))
            entry, at = np.unique(np.concatenate(seen), return_inverse=True)
            yes = np.bincount(at, np.concatenate(toxic), len(entry)).astype(np.int64)
            every = np.bincount(at, minlength=len(entry))
            yield pa.record_batch([pa.array(entry.view(np.int64)), pa.array(yes), pa.array(every - yes)], ["entry", "toxic", "clean"])

    n = {r.label: r.n for r in drawn.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = max(1, n.get(1, 0)), max(1, n.get(0, 0))
    counted = drawn.mapInArrow(run, "entry long, toxic long, clean long").groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    odds = F.log((F.col("toxic") + 0.1) / (toxic + 0.2)) - F.log((F.col("clean") + 0.1) / (clean + 0.2))
    best = counted.where("toxic >= 3").withColumn("odds", odds).where("odds > 2").orderBy(F.desc(F.col("odds") * F.sqrt("toxic")), "entry").limit(LEXICON)
    found = best.select("entry", "odds").toArrow()
    hashes = found.column("entry").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return Lexicon(hashes[order], found.column("odds").to_numpy()[order])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> Model:
    """Learns from about ``sample`` rows of each label; labels 0 and 1, others are not looked at.

    The lexicon comes from one half of the sample, the trees from the other, and the calibration
    from two halves of trees that each score what the other has learned from.
    """
    ready(docs.sparkSession)
    drawn, counts = labelled(docs, labels.where(F.col(label).isin(0, 1)), label, sample)
    total = sum(counts.values())
    prior = counts.get(1, 0) / total if total else 0.0
    if len(counts) < 2:
        return Model(Lexicon(np.zeros(0, np.uint64), np.zeros(0)), None, (np.zeros(1), np.zeros(1)), prior)
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2))
    drawn = drawn.select("text", F.col("label").cast("int").alias("label"), half.alias("half"))
    lexicon = learn_lexicon(drawn.where("half = 0").select("text", "label"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            rows = lexicon.features(*text_bytes(batch.column("text")))
            yield pa.record_batch([batch.column("label"), pa.array(list(rows), pa.list_(pa.float64()))], ["label", "row"])

    found = drawn.where("half = 1").select("text", "label").mapInArrow(run, "label int, row array<double>").toArrow()
    y = found.column("label").to_numpy().astype(float)
    if not 0 < y.sum() < len(y):
        return Model(lexicon, None, (np.zeros(1), np.zeros(1)), prior)
    x = np.array(found.column("row").to_pylist())
    weight = np.where(y == 1, counts[1] / y.sum(), counts[0] / (len(y) - y.sum()))
    weight *= len(y) / weight.sum()
    order = np.lexsort((*x.T, y))
    x, y, weight = x[order], y[order], weight[order]
    part = np.arange(len(y)) % 2
    value = np.zeros(len(y))
    for i in (0, 1):
        if 0 < y[part != i].sum() < (part != i).sum():
            value[part == i] = Trees(x[part != i], y[part != i], weight[part != i])(x[part == i])
    return Model(lexicon, Trees(x, y, weight), isotonic(value, y, weight), prior)


def scored(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row per document: doc_id, score (0 to 1), predicted (1 if score >= threshold).

    A null or wordless text is scored like any text without lexicon words. If only one label was
    learned from, every text gets the share of label 1 (0 without labels). Rows that repeat are
    returned as often as they come. Other columns are not looked at.
    """
    ready(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            yield pa.record_batch([batch.column("doc_id"), pa.array(model.score(*text_bytes(batch.column("text"))))], ["doc_id", "score"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    out = rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
