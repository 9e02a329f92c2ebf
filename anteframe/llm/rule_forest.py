"""Quality rules: an isolation forest over the statistics that such rules look at.

Every text becomes a few rates that do not depend on its length or language. Trees cut a random
rate at a random place again and again; a text that is alone after few cuts is unlike the others.
The mean path length over all trees is its score, and the labelled rows say from which score on a
text is rejected. Texts that are too short or mostly repeat themselves fail before that.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._sample import held_out
from ._store import ready, stored
from ._text import BLANKS, mix, pieces, run_hash, span_hash, text_bytes

#: Documents the trees are grown from, trees, and documents of one tree.
SAMPLE, TREES, EACH = 20_000, 200, 256
#: Share of the labelled good documents that the threshold has to keep.
KEEP = 0.98
#: Scores are told apart to one in so many for the threshold.
STEPS = 1 << 14
SEED = 11

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RATES = ["length", "symbols", "dup_lines", "repeats", "capitals", "unlettered", "echoes", "calls", "stops", "digits", "doubled", "bars"]


def _bytes(chars: str) -> np.ndarray:
    mask = np.zeros(256, bool)
    mask[[ord(c) for c in chars]] = True
    return mask


_SYMBOL = _bytes("#*$%&|<>")
_CAPITAL = _bytes("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _CAPITAL | _bytes("abcdefghijklmnopqrstuvwxyz")
_LETTER[128:] = True
_DIGIT = _bytes("0123456789")
_STOP = _bytes(".,;:?")
_MARK = ~_LETTER & ~_DIGIT & ~BLANKS


def _sums(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[off[1:]] - total[off[:-1]]


def _seen_before(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each key: whether it occurs twice or more, and whether this is not its first place."""
    _, first, inverse, n = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    return n[inverse] > 1, first[inverse] != np.arange(len(keys))


def statistics(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(counts, rates) of each text, in the order of ``COUNTS`` and ``RATES``.

    Equality of words and lines is that of 64-bit hashes.
    """
    n = len(off) - 1
    inside = ~BLANKS[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    starts = np.flatnonzero(inside & (edge[:-1] | ~before))
    ends = np.flatnonzero(inside & (edge[1:] | ~after)) + 1
    words = np.searchsorted(starts, off)
    count = np.diff(words)
    of = np.repeat(np.arange(n), count)
    salt = mix(np.arange(n, dtype=np.uint64) + np.uint64(1))
    word = span_hash(data, starts, ends)

    # Places covered by a window of three words that its text holds twice or more.
    window = run_hash(word, 3)
    whole = np.flatnonzero(of[: len(window)] == of[2:][: len(window)])
    twice = whole[_seen_before(window[whole] ^ salt[of[whole]])[0]] if len(whole) else whole
    covered = np.zeros(len(word) + 1, np.int64)
    np.add.at(covered, twice, 1)
    np.add.at(covered, twice + 3, -1)
    repeated = np.cumsum(covered)[: len(word)] > 0

    # Lines with a word that equal an earlier one of their text.
    cut = np.flatnonzero(data == 10)
    begin = np.union1d(off[:-1][np.diff(off) > 0], (cut + 1)[~edge[cut + 1]]).astype(np.int64)
    text_of = np.searchsorted(off, begin, "right") - 1
    stop = np.minimum(np.append(begin[1:], len(data)), off[text_of + 1])
    stop = stop - ((stop > begin) & (data[np.maximum(stop - 1, 0)] == 10)) if len(stop) else stop
    filled = np.searchsorted(starts, begin) < np.searchsorted(starts, stop)
    begin, stop, text_of = begin[filled], stop[filled], text_of[filled]
    again = _seen_before(span_hash(data, begin, stop) ^ salt[text_of])[1] if len(begin) else np.zeros(0, bool)
    lines, dup_lines = np.bincount(text_of, minlength=n), np.bincount(text_of[again], minlength=n)

    point = inside & ((data & 0xC0) != 0x80)
    symbols = _sums(_SYMBOL[data], off)
    repeats = _sums(repeated, words)
    chars = _sums(point, off)
    counts = np.stack([count, chars, symbols, dup_lines, repeats], 1).astype(np.int64)

    letters = np.concatenate(([0], np.cumsum(_LETTER[data])))
    echo = np.zeros(len(word), bool)
    echo[1:] = (word[1:] == word[:-1]) & (of[1:] == of[:-1])
    double = np.zeros(len(data), bool)
    double[1:] = _MARK[data[1:]] & (data[1:] == data[:-1]) & ~edge[1:-1]
    alone = (ends - starts == 1) & _MARK[data[starts]] if len(starts) else np.zeros(0, bool)
    w, b = np.maximum(count, 1), np.maximum(_sums(_LETTER[data], off), 1)
    rates = [
        chars / w, symbols / w, dup_lines / np.maximum(lines, 1), repeats / w, _sums(_CAPITAL[data], off) / b,
        _sums(letters[ends] == letters[starts], words) / w, _sums(echo, words) / w, _sums(data == 33, off) / w,
        _sums(_STOP[data], off) / w, _sums(_DIGIT[data], off) / w, _sums(double, off) / w, _sums(alone, words) / w,
    ]
    return counts, np.stack(rates, 1).astype(np.float64)


def _rest(n: np.ndarray) -> np.ndarray:
    """Mean length of the path that ``n`` rows of one leaf would still need."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649015329) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


class Forest:
    """Trees of random cuts, each grown from ``each`` of the rows."""

    def __init__(self, rows: np.ndarray, trees: int = TREES, each: int = EACH, seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        each = min(each, len(rows))
        self.depth = int(np.ceil(np.log2(max(each, 2))))
        nodes = 2 ** (self.depth + 1) - 1
        self.feature = np.full((trees, nodes), -1, np.int16)
        self.cut, self.path = np.zeros((trees, nodes)), np.zeros((trees, nodes))
        self.norm = max(float(_rest(each)), 1e-9)
        for t in range(trees):
            todo = [(0, 0, rows[rng.choice(len(rows), each, replace=False)])] if each else []
            while todo:
                node, level, own = todo.pop()
                low, high = own.min(0), own.max(0)
                free = np.flatnonzero(high > low)
                if level == self.depth or not len(free):
                    self.path[t, node] = level + float(_rest(len(own)))
                    continue
                f = rng.choice(free)
                at = rng.uniform(low[f], high[f])
                self.feature[t, node], self.cut[t, node] = f, at
                left = own[:, f] <= at
                todo += [(2 * node + 1, level + 1, own[left]), (2 * node + 2, level + 1, own[~left])]

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Between 0 and 1, higher for rows that are alone after fewer cuts."""
        total, every = np.zeros(len(rows)), np.arange(len(rows))
        for feature, cut, path in zip(self.feature, self.cut, self.path, strict=True):
            node = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                f = feature[node]
                node = np.where(f < 0, node, 2 * node + 1 + (rows[every, f] > cut[node]))
            total += path[node]
        return np.exp2(-total / len(self.path) / self.norm)


@dataclass
class Model:
    forest: Forest
    threshold: float


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text's counts and rates: doc_id, ``COUNTS``, rates. A null text counts as an empty one."""
    ready(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            counts, rates = statistics(*text_bytes(batch.column("text")))
            flat = pa.FixedSizeListArray.from_arrays(pa.array(rates.ravel()), len(RATES)).cast(pa.list_(pa.float64()))
            yield pa.record_batch([batch.column("doc_id"), *map(pa.array, counts.T.copy()), flat], ["doc_id", *COUNTS, "rates"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, rates array<double>")


def _rates(batch: pa.RecordBatch | pa.Table) -> np.ndarray:
    cells = batch.column("rates")
    cells = cells.combine_chunks() if isinstance(cells, pa.ChunkedArray) else cells
    return cells.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(RATES))


def base_failed() -> Column:
    """Fewer than 50 words, or more than half of them in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def fit(rows: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, keep: float = KEEP) -> Model:
    """Forest and threshold for what ``measured`` gave.

    The trees are grown without labels from about ``sample`` rows that pass the base rules, drawn by
    their ids. The threshold is set by all labelled rows that are not held out and pass the base
    rules: of the scores that keep at least the share ``keep`` of label 1, the one that parts both
    labels best, of equal ones the highest. A document with several rows in ``labels`` counts once, as good if any row says
    so. Without rows of both labels no text is rejected by its score. The driver gets the sample
    and two counts for each of at most ``STEPS`` scores.
    """
    passed = rows.where(~base_failed())
    n = passed.count()
    share = min(1.0, sample / n) if n else 1.0
    drawn = passed.where(F.pmod(F.xxhash64("doc_id", F.lit("forest")), F.lit(1 << 30)) < F.lit(share * (1 << 30)))
    found = _rates(drawn.select("rates").toArrow())
    # The order of the rows must not matter to the random draws.
    forest = Forest(found[np.lexsort(found.T)] if len(found) else np.zeros((0, len(RATES))))

    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("good"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = np.floor(forest.score(_rates(batch)) * STEPS).astype(np.int64)
            yield pa.record_batch([batch.column("good"), pa.array(step)], ["good", "step"])

    steps = passed.join(known, "doc_id").select("good", "rates").mapInArrow(run, "good int, step long").groupBy("good", "step").count().collect()
    counts = np.zeros((2, STEPS + 2), np.int64)
    for r in steps:
        counts[r.good, r.step] += r["count"]
    if not counts.sum(1).all():
        return Model(forest, 2.0)
    # Rejected if the score is at least step / STEPS: shares of each label that are rejected.
    bad, good = (c[::-1].cumsum()[::-1] / c.sum() for c in counts)
    gain = np.where(good <= 1 - keep, bad - good, -1)
    return Model(forest, int(np.flatnonzero(gain == gain.max())[-1]) / STEPS)


def judged(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE, keep: float = KEEP) -> DataFrame:
    """One row per document: doc_id, counts, base_failed, kept, score.

    A null, empty or wordless text has no words and fails the base rules; equal texts get equal
    results, and rows that repeat are returned as often as they come. An empty table gives no
    rows. Other columns are not looked at. Texts are read once; what follows works on their
    statistics.
    """
    rows = stored(measured(docs, doc_id, text))
    model = fit(rows, labels, sample=sample, keep=keep)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = pa.array(model.forest.score(_rates(batch)))
            yield pa.record_batch([*(batch.column(c) for c in ("doc_id", *COUNTS)), score], ["doc_id", *COUNTS, "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(run, f"doc_id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, score double")
    return scored.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & (F.col("score") < model.threshold))


def accepted(docs: DataFrame, labels: DataFrame, text: str = "text", sample: int = SAMPLE, keep: float = KEEP) -> DataFrame:
    """The documents that are kept, with their own columns. Each row is judged by its own text."""
    model = fit(stored(measured(docs, text=text)), labels, sample=sample, keep=keep)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            counts, rates = statistics(*text_bytes(batch.column(text)))
            failed = (counts[:, 0] < 50) | (100 * counts[:, 4] > 50 * counts[:, 0])
            yield batch.filter(pa.array(~failed & (model.forest.score(rates) < model.threshold)))

    return docs.mapInArrow(run, docs.schema)
