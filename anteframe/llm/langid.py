"""Language of a text by error-correcting output codes.

Each language has a code word. For each bit a binary classifier over hashed letter n-grams is
trained; a text gets the language whose word costs least, bits weighted by how well they were
learned. A text whose two cheapest words cost nearly the same is flagged.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._sample import draw, held_out, label_counts
from ._store import ready
from ._text import LOWER, pieces, previous, text_bytes

#: Documents of each language that are learned from, and of all languages together.
SAMPLE, SAMPLE_ALL = 1500, 24_000
TERMS = 2048
STEPS = 150
#: Difference of the two least costs, as a share of all, under which a text is ambiguous.
MARGIN = 0.1

_LETTER = LOWER.astype(np.int64)
_LETTER[[c for c in range(128) if not chr(c).isalpha()]] = 0x20


def ngrams(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Letter bigrams and trigrams of each text, hashed, as unit rows of logarithmic counts."""
    n = len(off) - 1
    row = np.repeat(np.arange(n), np.diff(off)) * TERMS
    code = _LETTER[data]
    last = previous(code, off, 0x20)
    two = code + 256 * last
    three = two + 65536 * previous(last, off, 0x20)
    out = np.bincount(row + ((two * 2654435761 >> 9) % TERMS), minlength=n * TERMS)
    out += np.bincount(row + ((three * 2246822519 >> 9) % TERMS), minlength=n * TERMS)
    out = np.log1p(out.reshape(n, TERMS).astype(np.float32))
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def code_words(n: int) -> np.ndarray:
    """A word of +1 and -1 for each of ``n`` languages: all splits of few, else the best of many draws."""
    if n <= 5:
        splits = [[1 if i == 0 or (s >> (i - 1)) & 1 else -1 for i in range(n)] for s in range(2 ** (n - 1) - 1)]
        return np.array(splits, float).T.reshape(n, -1)
    rng = np.random.default_rng(n)
    bits = int(np.ceil(12 * np.log2(n)))
    best, most = None, -1
    for _ in range(300):
        words = rng.choice([-1.0, 1.0], (n, bits))
        words[:, np.abs(words.sum(axis=0)) == n] *= np.where(np.arange(n) % 2, 1, -1)[:, None]
        apart = ((bits - words @ words.T) / 2 + np.eye(n) * bits).min()
        if apart > most:
            best, most = words, apart
    return best


@dataclass
class Model:
    languages: list[str]
    words: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def decode(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cheapest language, how probable it is, and whether the next one is close."""
        margin = rows @ self.weights + self.bias
        cost = (np.logaddexp(0, -margin[:, None, :] * self.words[None]) * self.trust).sum(axis=2)
        best = cost.argmin(axis=1)
        share = np.exp(cost.min(axis=1, keepdims=True) - cost)
        score = 1 / share.sum(axis=1)
        two = np.sort(cost, axis=1)[:, :2]
        close = two[:, -1] - two[:, 0] < MARGIN * self.trust.sum() if cost.shape[1] > 1 else np.zeros(len(rows), bool)
        return best, score, close


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE, sample_all: int = SAMPLE_ALL) -> Model | None:
    """Learns from about ``sample`` rows of each language, of all together ``sample_all``; None if no row has one."""
    ready(docs.sparkSession)
    known = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("label"))
    known = known.where(F.col("label").isNotNull() & F.col("text").isNotNull() & ~held_out())
    counts = label_counts(known, "label")
    if not counts:
        return None
    languages = sorted(counts)
    drawn = known.where(draw("label", counts, min(sample, sample_all // len(counts))))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            rows = (ngrams(*text_bytes(batch.column("text"))) * 65535).astype(np.uint16)
            yield pa.record_batch([batch.column("label"), pa.array([r.tobytes() for r in rows], pa.binary())], ["label", "row"])

    found = drawn.select("text", "label").mapInArrow(run, "label string, row binary").toArrow()
    x = np.frombuffer(b"".join(found.column("row").to_pylist()), np.uint16).reshape(-1, TERMS).astype(np.float32) / 65535
    at = {v: i for i, v in enumerate(languages)}
    y = np.array([at[v] for v in found.column("label").to_pylist()], int)
    words = code_words(len(languages))
    target = words[y] if len(y) else np.zeros((0, words.shape[1]))
    weights, bias = np.zeros((TERMS, words.shape[1]), np.float32), np.zeros(words.shape[1], np.float32)
    ahead, last = weights, weights
    for step in range(STEPS if len(y) else 0):
        margin = x @ ahead + bias
        pull = (-target / (1 + np.exp(margin * target)) / len(y)).astype(np.float32)
        weights = ahead - 60.0 * (x.T @ pull + 1e-6 * ahead)
        bias = bias - 2.0 * pull.sum(axis=0)
        ahead = weights + step / (step + 3) * (weights - last)
        last = weights
    right = ((x @ weights + bias) * target > 0).mean(axis=0) if len(y) else np.ones(words.shape[1])
    return Model(languages, words, weights, bias, np.maximum(2 * right - 1, 0.05))


def predicted(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, lang_pred, score (0 to 1), ambiguous.

    A text that is null or has no letter of any script is ``und`` with score 0, as is every text if
    nothing was learned. Rows that repeat are returned as often as they come. Other columns are
    not looked at.
    """
    ready(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = rows.withColumn("letters", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            letters = batch.column("letters").to_numpy(zero_copy_only=False)
            best, score, close = model.decode(ngrams(*text_bytes(batch.column("text")))) if model else (np.zeros(len(letters), int),) * 3
            known = letters & bool(model)
            names = [model.languages[b] if k else "und" for b, k in zip(best.tolist(), known.tolist(), strict=True)]
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(np.where(known, score, 0.0).astype(float)), pa.array(known & (close > 0))],
                ["doc_id", "lang_pred", "score", "ambiguous"],
            )

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, ambiguous boolean")
