"""Log-likelihood of whole documents under a gated recurrent language model, trained here.

Counts of all training words are taken by one grouping. The ``WORDS`` most frequent words are
predicted one by one, in classes of similar frequency; all others by a class of their last letters,
and within it by their counts: P(word) = P(group | before) * P(class | group, before) * P(word | class),
in groups of a few classes. So the model gives every word, also one never seen, a probability, and all together sum to one.

The recurrent network is trained by truncated backpropagation on every training text. The texts are
dealt over rounds, more of them the more tokens there are. In a round one task for each core learns
from its part, from a common start; their weights are averaged in a tree, and the next round goes on
from there. Words are looked up once: the rounds and the scoring read their numbers. Scoring carries the state
through a document's windows to its end.

Counts of frequent words go along with the code; rows of rarer words meet their counts by a join.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._sample import held_out
from ._store import ready, stored
from ._text import BLANKS, LOWER, Words, give_back, pieces, span_hash, text_bytes

#: Words predicted one by one (the end of a document is one of them), their classes, classes of the others.
WORDS, CLASSES, ENDINGS = 4096, 64, 64
#: A class is predicted by way of its group of so many classes.
GROUPED = 16
GROUPS = (CLASSES + ENDINGS) // GROUPED
#: Words whose counts all tasks hold.
POPULAR = 65_536
EMBEDDING, STATE = 24, 32
#: Streams and steps of a training window. Where a task has tokens for more than ``WINDOWS`` of these, it
#: takes more streams, at most ``WIDEST``, and longer steps in proportion.
STREAMS, WINDOW = 64, 20
WINDOWS, WIDEST = 300, 256
#: Slopes far below ``CALM`` hardly move a weight: few tokens say little about a rare word.
RATE, MERGED, CALM = 4e-3, 8, 1e-4
#: Rounds at least; further ones are the cube root of how often so many tokens are there.
ROUNDS, ROUND_TOKENS = 2, 500_000
#: Tokens learned from or scored together, at least; a longer document is whole.
TOGETHER = 1_600_000
#: States that are turned into predictions at once, at least.
PREDICTED = 8192
#: Weights that are moved at once.
BLOCK = 1 << 16

END = np.uint64(0xE0F0E0F0E0F0E0F0)


def ending_classes() -> np.ndarray:
    """Ending class by a word's last two bytes as they are written, ``256 * one + other``; a blank before a single one."""
    one, other = (x.astype(np.uint8).reshape(-1) for x in np.mgrid[:256, :256])
    at = np.arange(0, 1 << 17, 2)
    both = np.stack((LOWER[one], LOWER[other]), axis=1).reshape(-1)
    return (span_hash(both, at + (one == 0x20), at + 2) % np.uint64(ENDINGS)).astype(np.int64)


ENDING_OF = ending_classes()


def tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and ending class of each token, the end after each text, and where texts begin."""
    data, off = text_bytes(batch.column("text"))
    words = Words(data, off, BLANKS)
    counts = words.counts
    n, docs = len(words.hash), len(counts)
    at = np.arange(n) + np.repeat(np.arange(docs), counts)
    hashes, ending = np.full(n + docs, END), np.zeros(n + docs, np.int64)
    hashes[at] = words.hash
    before = np.where(words.ends - words.starts > 1, data[words.ends - 2], 0x20)
    ending[at] = ENDING_OF[before.astype(np.int64) * 256 + data[words.ends - 1]]
    return hashes, ending, np.concatenate(([0], np.cumsum(counts + 1)))


def word_counts(texts: DataFrame) -> DataFrame:
    """word, ending, n of all texts; a task puts its own together first."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def together(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            h, e, n = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(h)
            h = h[order]
            first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
            return h[first], e[order[first]], np.add.reduceat(n[order], first)

        for batch in pieces(batches, "text"):
            h, e, _ = tokens(batch)
            # A piece first puts its own together, in a core's cache.
            held.append(together([(h, e, np.ones(len(h), np.int64))]))
            if sum(len(x[0]) for x in held) > 1_000_000:
                held = [together(held)]
                if len(held[0][0]) > 500_000:
                    yield out(*held.pop())
        if held:
            yield out(*together(held))

    def out(word: np.ndarray, ending: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array(word.view(np.int64)), pa.array(ending.astype(np.int32)), pa.array(n)], ["word", "ending", "n"])

    return texts.mapInArrow(run, "word long, ending int, n long").groupBy("word").agg(F.min("ending").alias("ending"), F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Popular words, sorted by hash, with counts and numbers; totals of all training tokens."""

    hashes: np.ndarray
    counts: np.ndarray
    numbers: np.ndarray
    total: int
    distinct: int
    head: np.ndarray
    ending_total: np.ndarray
    ending_distinct: np.ndarray

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place among the popular words, and whether a word is one."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        # From the first one that shares the leading bits on: hashes are spread evenly, so it is few steps away at most.
        at = self.begins[hashes >> np.uint64(48)]
        behind = np.flatnonzero(self.hashes[at] < hashes)
        while len(behind):
            at[behind] += 1
            behind = behind[at[behind] < len(self.hashes) - 1]
            behind = behind[self.hashes[at[behind]] < hashes[behind]]
        at = np.minimum(at, len(self.hashes) - 1)
        return at, self.hashes[at] == hashes

    @cached_property
    def begins(self) -> np.ndarray:
        """Place of the first popular word, or the last of all, whose hash has these leading 16 bits or more."""
        return np.minimum(np.searchsorted(self.hashes, np.arange(1 << 16, dtype=np.uint64) << np.uint64(48)), len(self.hashes) - 1)

    def numbered(self, hashes: np.ndarray, ending: np.ndarray, found: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        """Number of a word predicted by itself, or ``WORDS`` plus its ending. ``found``: what ``find`` gave, if known."""
        at, known = found or self.find(hashes)
        number = np.where(known, self.numbers[at] if len(self.numbers) else 0, -1)
        return np.where(number >= 0, number, WORDS + ending)

    @property
    def base_room(self) -> float:
        return float(np.log10(self.total + 0.1 * (self.distinct + 1)))

    @property
    def ending_room(self) -> np.ndarray:
        return np.log10(self.ending_total + 0.1 * (self.ending_distinct + 1))


def vocabulary(counts: DataFrame) -> Vocabulary:
    popular = counts.orderBy(F.desc("n"), "word").limit(POPULAR).toArrow()
    word = popular.column("word").to_numpy().view(np.uint64)
    n, ending = popular.column("n").to_numpy(), popular.column("ending").to_numpy()
    rank = np.argsort(np.where(word == END, -np.inf, -n.astype(float)), kind="stable")
    number = np.full(len(word), -1)
    number[rank[:WORDS]] = np.arange(min(WORDS, len(word)))
    head = np.zeros(WORDS)
    head[: min(WORDS, len(word))] = n[rank[:WORDS]]
    totals, kinds = np.zeros(ENDINGS), np.zeros(ENDINGS)
    for r in counts.groupBy("ending").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).collect():
        totals[r.ending], kinds[r.ending] = r.n, r.kinds
    total, distinct = int(totals.sum()), int(kinds.sum())
    # Words predicted by themselves do not count in their ending.
    own = number >= 0
    totals -= np.bincount(ending[own], n[own], ENDINGS)
    kinds -= np.bincount(ending[own], minlength=ENDINGS)
    order = np.argsort(word)
    return Vocabulary(word[order], n[order], number[order], total, distinct, head, totals, kinds)


SHAPES = {
    "embedding": (WORDS + ENDINGS, EMBEDDING), "w": (EMBEDDING, 3 * STATE), "u": (STATE, 3 * STATE), "b": (3 * STATE,),
    "group_w": (1, STATE, GROUPS), "group_b": (1, GROUPS), "class_w": (GROUPS, STATE, GROUPED), "class_b": (GROUPS, GROUPED),
    "word_w": (CLASSES, STATE, WORDS // CLASSES), "word_b": (CLASSES, WORDS // CLASSES),
}
SIZE = sum(int(np.prod(s)) for s in SHAPES.values())
#: A word is predicted by way of its group and its class; an ending's class has no words of its own.
LEVELS = ("group", "class", "word")


def views(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in SHAPES.items():
        n = int(np.prod(shape))
        out[name] = flat[at : at + n].reshape(shape)
        at += n
    return out


def start(v: Vocabulary) -> np.ndarray:
    """Small weights, and biases that give every word its share of the counts."""
    flat = (np.random.default_rng(7).normal(size=SIZE) * 0.08).astype(np.float32)
    p = views(flat)
    p["b"][:] = 0
    # An ending's share has room for one word never seen in it.
    room = v.ending_total + 0.1 * (v.ending_distinct + 1)
    head = (v.head + 0.1).reshape(CLASSES, -1)
    p["word_b"][:] = np.log(head)
    classes = np.concatenate((head.sum(axis=1), room)).reshape(GROUPS, -1)
    p["class_b"][:] = np.log(classes)
    p["group_b"][:] = np.log(classes.sum(axis=1))
    for level in LEVELS:
        p[f"{level}_w"][:] *= 0.2
    return flat


def step(p: dict, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """One step of the network for inputs already multiplied: state, gates, candidate, its recurrent part."""
    rec = h @ p["u"]
    # The sigmoid of the gates, by way of tanh.
    gates = x[:, : 2 * STATE] + rec[:, : 2 * STATE]
    gates *= 0.5
    np.tanh(gates, out=gates)
    gates *= 0.5
    gates += 0.5
    r, z = gates[:, :STATE], gates[:, STATE:]
    part = rec[:, 2 * STATE :]
    candidate = r * part
    candidate += x[:, 2 * STATE :]
    np.tanh(candidate, out=candidate)
    new = h - candidate
    new *= z
    new += candidate
    return new, r, z, candidate, part


_ROOMS: dict[tuple[str, str], np.ndarray] = {}


def room(use: str, shape: tuple[int, ...], dtype: np.dtype) -> np.ndarray:
    """An array, not cleared, in memory that the next call for the same use takes again: fresh memory costs more than filling it."""
    key, size = (use, np.dtype(dtype).str), math.prod(shape)
    if key not in _ROOMS or len(_ROOMS[key]) < size:
        _ROOMS[key] = np.empty(size, dtype)
    return _ROOMS[key][:size].reshape(shape)


def class_of(number: np.ndarray) -> np.ndarray:
    return np.where(number < WORDS, number // (WORDS // CLASSES), number - WORDS + CLASSES)


#: Class of each number; the first number of each class and each group, as classes ascend with the numbers.
CLASS_OF = class_of(np.arange(WORDS + ENDINGS))
FIRST = {"class": np.searchsorted(CLASS_OF, np.arange(0, CLASSES + ENDINGS + 1, GROUPED)), "word": np.searchsorted(CLASS_OF, np.arange(CLASSES + 1))}
AT = {"group": CLASS_OF // GROUPED, "class": CLASS_OF % GROUPED, "word": np.arange(WORDS + ENDINGS) % (WORDS // CLASSES)}


def softmax_parts(logits: Callable[[], np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Exponentials of each row's logits, their sum, and by how much the row was lowered before.

    No row needs that while sums stay far from what a number can hold, as they do with trained weights.
    """
    x = logits()
    ones = np.ones(x.shape[1], x.dtype)
    with np.errstate(over="ignore"):
        total = np.exp(x, out=x) @ ones
    if not len(x) or (total.max() < 1e30 and total.min() > 1e-20):
        return x, total, np.zeros(1, x.dtype)
    x = logits()
    top = x.max(axis=1)
    x -= top[:, None]
    return np.exp(x, out=x), x @ ones, top


def levels(p: dict, h: np.ndarray, number: np.ndarray) -> Iterator[tuple[str, list[tuple[int, slice]], np.ndarray, Callable[[], np.ndarray]]]:
    """For tokens in order of their numbers: level, runs that share weights, entries that came, and the logits."""
    for level in LEVELS:
        ends = [0, len(number)] if level == "group" else np.searchsorted(number, FIRST[level]).tolist()
        runs = [(k, slice(a, z)) for k, (a, z) in enumerate(itertools.pairwise(ends)) if a < z]
        w, b = p[f"{level}_w"], p[f"{level}_b"]
        b = b - b.max(axis=1, keepdims=True)

        def logits(w: np.ndarray = w, b: np.ndarray = b, runs: list = runs, n: int = ends[-1]) -> np.ndarray:
            x = room("logits", (n, w.shape[2]), np.result_type(h, w))
            for k, run in runs:
                own = x[run]
                np.matmul(h[run], w[k], out=own)
                own += b[k]
            return x

        yield level, runs, AT[level].take(number[: ends[-1]]), logits


def in_order(h: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.argsort(number.astype(np.uint16), kind="stable")
    return order, h.take(order, axis=0, out=room("states", h.shape, h.dtype), mode="clip"), number.take(order)


def predictions(p: dict, h: np.ndarray, number: np.ndarray, grad: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Natural logarithm of each token's probability after its state; with ``grad`` the slopes too."""
    order, states, numbers = in_order(h, number)
    found = np.zeros(len(h))
    for level, runs, at, logits in levels(p, states, numbers):
        kept: list[np.ndarray] = []

        def noted(logits: Callable = logits, kept: list = kept, at: np.ndarray = at) -> np.ndarray:
            x = logits()
            kept[:] = [x.reshape(-1).take(np.arange(0, x.size, x.shape[1]) + at)]
            return x

        _, total, top = softmax_parts(noted)
        found[: len(at)] += kept[0] - top - np.log(total)
    out = np.empty(len(h))
    out[order] = found
    return out, None if grad is None else slopes(p, h, number, grad)


def slopes(p: dict, h: np.ndarray, number: np.ndarray, grad: dict) -> np.ndarray:
    """Slopes of the tokens' loss by their states; those by the weights go into ``grad``, which holds zeros."""
    order, h, number = in_order(h, number)
    ones, back, own = np.ones(len(h), h.dtype), room("back", h.shape, h.dtype), room("own", h.shape, h.dtype)
    for level, runs, at, logits in levels(p, h, number):
        d, total, _ = softmax_parts(logits)
        d *= (1 / total)[:, None]
        d.reshape(-1)[np.arange(0, d.size, d.shape[1]) + at] -= 1
        w, grad_w, grad_b = p[f"{level}_w"].transpose(0, 2, 1), grad[f"{level}_w"], grad[f"{level}_b"]
        for k, run in runs:
            slope = d[run]
            np.matmul(h[run].T, slope, out=grad_w[k])
            np.matmul(ones[run], slope, out=grad_b[k])
            np.matmul(slope, w[k], out=(back if level == "group" else own)[run])
        if level != "group":
            back[: len(at)] += own[: len(at)]
    out = np.empty_like(back)
    out[order] = back
    return out


def descend(flat: np.ndarray, grad: np.ndarray, m: np.ndarray, v: np.ndarray, n: int, share: float, rate: float = RATE) -> None:
    """The n-th step of Adam along ``share`` of the slopes, in place, in blocks that stay in a core's cache."""
    seen, spread = 1 - 0.9**n, (1 - 0.99**n) ** 0.5
    room = np.empty(min(BLOCK, len(flat)), flat.dtype)
    for at in range(0, len(flat), BLOCK):
        w, g, a, b = flat[at : at + BLOCK], grad[at : at + BLOCK], m[at : at + BLOCK], v[at : at + BLOCK]
        t = room[: len(w)]
        np.multiply(g, 0.1 * share, out=t)
        a *= 0.9
        a += t
        t *= t
        b *= 0.99
        b += t
        np.sqrt(b, out=t)
        t += CALM * spread
        np.divide(a, t, out=t)
        t *= rate * spread / seen
        w -= t


def streams_of(tokens_: int) -> int:
    return min(WIDEST, max(STREAMS, tokens_ // (WINDOW * WINDOWS)))


#: Cells of a step in one product: what the inputs give the candidate, both gates, what the state gives the candidate.
CELLS, GIVEN = 4 * STATE, EMBEDDING + 1


def joined(p: dict) -> np.ndarray:
    """Weights of a step by inputs, one and state together; those of the gates with their sign turned."""
    w, u = np.concatenate((p["w"], p["b"][None])).T, p["u"].T
    a = np.zeros((CELLS, GIVEN + STATE), np.float32)
    a[:STATE, :GIVEN] = w[2 * STATE :]
    np.negative(w[: 2 * STATE], out=a[STATE : 3 * STATE, :GIVEN])
    np.negative(u[: 2 * STATE], out=a[STATE : 3 * STATE, GIVEN:])
    a[3 * STATE :, GIVEN:] = u[2 * STATE :]
    return a


def backward(p: dict) -> np.ndarray:
    """Weights by which slopes of a step's cells become those of its inputs and of the state before."""
    a = np.zeros((EMBEDDING + STATE, CELLS), np.float32)
    a[:EMBEDDING, : 3 * STATE] = np.roll(p["w"], STATE, axis=1)
    a[EMBEDDING:, STATE:] = p["u"]
    return a


def advance(a: np.ndarray, given: np.ndarray, cells: np.ndarray, new: np.ndarray) -> None:
    """One step of ``step`` for many streams, a cell's streams side by side: ``cells`` and ``new`` states are filled."""
    np.matmul(a, given, out=cells)
    now, gates, part = cells[:STATE], cells[STATE : 3 * STATE], cells[3 * STATE :]
    np.exp(gates, out=gates)
    gates += 1
    np.reciprocal(gates, out=gates)
    np.multiply(gates[:STATE], part, out=new)
    now += new
    np.tanh(now, out=now)
    np.subtract(given[GIVEN:], now, out=new)
    new *= gates[STATE:]
    new += now


@np.errstate(over="ignore")
def train(flat: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Weights after one pass over all the tokens: truncated backpropagation with Adam.

    Only what needs the state before goes step by step, in arrays that all windows share and in which
    a step's cells lie together (step, cell, stream); all else is one product for a window.
    """
    flat = flat.copy()
    p = views(flat)
    grad_flat = np.zeros_like(flat)
    grad = views(grad_flat)
    m, v = np.zeros_like(flat), np.zeros_like(flat)
    wide = streams_of(len(numbers))
    streams, rate = min(wide, max(1, len(numbers) // WINDOW)), RATE * wide / STREAMS
    # Where the tokens cannot be dealt evenly, some streams end one place before the others.
    bounds = len(numbers) * np.arange(streams + 1) // streams
    length = -(-len(numbers) // streams)
    places = bounds[:-1] + np.arange(length)[:, None]
    there = places < bounds[1:]
    rows = np.where(there, numbers[np.minimum(places, len(numbers) - 1)], 0) if len(numbers) else places
    last = np.zeros(streams, np.int64)

    def steps(cells: int) -> np.ndarray:
        return np.empty((WINDOW, cells, streams), np.float32)

    given, cells, slope, states, gone, back = (steps(n) for n in (GIVEN + STATE, CELLS, CELLS, STATE, EMBEDDING + STATE, STATE))
    words, by_words, by_state = (np.empty((WINDOW, streams, n), np.float32) for n in (EMBEDDING, EMBEDDING, STATE))
    given[:, EMBEDDING] = 1
    h = np.zeros((STATE, streams), np.float32)
    kept, some = (np.empty((STATE, streams), np.float32) for _ in range(2))
    for n, at in enumerate(range(0, length, WINDOW), 1):
        target = rows[at : at + WINDOW]
        own = np.flatnonzero(there[at : at + WINDOW])
        inputs = np.concatenate((last[None], target[:-1]))
        last = target[-1]
        t = len(target)
        p["embedding"].take(inputs, axis=0, out=words[:t], mode="clip")
        given[:t, :EMBEDDING] = words[:t].transpose(0, 2, 1)
        # Number 0 is the end: the next document begins without a past.
        fresh = (inputs != 0).astype(np.float32)
        a = joined(p)
        for i in range(t):
            np.multiply(h, fresh[i], out=given[i, GIVEN:])
            h = states[i]
            advance(a, given[i], cells[i], h)
        grad_flat[:] = 0
        by_state[:t] = states[:t].transpose(0, 2, 1)
        rows_ = by_state[:t].reshape(-1, STATE)
        if len(own) == len(rows_):
            rows_[:] = slopes(p, rows_, target.reshape(-1), grad)
        else:
            found = slopes(p, rows_[own], target.reshape(-1)[own], grad)
            rows_[:] = 0
            rows_[own] = found
        back[:t] = by_state[:t].transpose(0, 2, 1)
        a = backward(p)
        for i in range(t - 1, -1, -1):
            d, now, r, z, part = back[i], *cells[i].reshape(4, STATE, streams)
            d_now, d_r, d_z, d_part = slope[i].reshape(4, STATE, streams)
            if i + 1 < t:
                d += gone[i + 1, EMBEDDING:]
            np.multiply(d, z, out=kept)
            np.subtract(d, kept, out=d_now)
            np.subtract(given[i, GIVEN:], now, out=d_z)
            d_z *= kept
            np.subtract(1, z, out=some)
            d_z *= some
            np.multiply(now, now, out=some)
            some *= d_now
            d_now -= some
            np.multiply(d_now, r, out=d_part)
            np.subtract(1, r, out=some)
            some *= part
            np.multiply(d_part, some, out=d_r)
            np.matmul(a, slope[i], out=gone[i])
            carry = gone[i, EMBEDDING:]
            carry += kept
            carry *= fresh[i]
        grad["u"][:] = np.matmul(slope[:t, STATE:], given[:t, GIVEN:].transpose(0, 2, 1)).sum(axis=0).T
        # By what the inputs gave: the candidate's cells come before those of the gates.
        by_w = np.roll(np.matmul(slope[:t, : 3 * STATE], given[:t, :GIVEN].transpose(0, 2, 1)).sum(axis=0), -STATE, axis=0).T
        grad["w"][:], grad["b"][:] = by_w[:EMBEDDING], by_w[EMBEDDING]
        order = np.argsort(inputs.reshape(-1).astype(np.uint16), kind="stable")
        ordered = inputs.reshape(-1)[order]
        first = np.flatnonzero(np.diff(ordered, prepend=-1))
        by_words[:t] = gone[:t, :EMBEDDING].transpose(0, 2, 1)
        at_once = by_words[:t].reshape(-1, EMBEDDING).take(order, axis=0, out=words[:t].reshape(-1, EMBEDDING), mode="clip")
        grad["embedding"][ordered[first]] = np.add.reduceat(at_once, first, axis=0)
        norm = float(np.sqrt(np.dot(grad_flat, grad_flat))) / len(own)
        descend(flat, grad_flat, m, v, n, 1 / (len(own) * max(1.0, norm)), rate)
    return flat


NUMBERED = "key long, round int, n_tokens long, known long, base double, within double, numbers binary, words array<long>, times array<int>"


def numbered(rows: DataFrame, v: Vocabulary) -> DataFrame:
    """What is learned from and scored, of rows doc_id, key, learns, text, whose words are read no more after this.

    doc_id, key; round that learns from the text, -1 if none does; n_tokens; known: popular words, base:
    their part of the base score; within: logarithms of the popular ones among those that share an ending;
    numbers of the words, two bytes each; words, times: the others, whose counts are joined later.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log_counts = np.log10(v.counts + 0.1) if len(v.counts) else np.zeros(1)
        ending_room = v.ending_room
        for batch in pieces(batches, "text"):
            hashes, ending, off = tokens(batch)
            n = np.diff(off)
            of = np.repeat(np.arange(len(n)), n)
            at, popular = v.find(hashes)
            number = v.numbered(hashes, ending, (at, popular))
            tail = np.flatnonzero(number >= WORDS)
            logs = log_counts[at] * popular
            known = np.bincount(of, popular, len(n)).astype(np.int64)
            base = np.bincount(of, logs, len(n)) - n * v.base_room
            # Of no rows at all these would be whole numbers.
            within = np.bincount(of[tail], logs[tail] - ending_room[ending[tail]], len(n)).astype(float)
            rare = np.flatnonzero(~popular)
            order = np.lexsort((hashes[rare], of[rare]))
            word, owner = hashes[rare][order], of[rare][order]
            new = np.flatnonzero(np.concatenate(([True], (word[1:] != word[:-1]) | (owner[1:] != owner[:-1])))) if len(word) else np.zeros(0, np.int64)
            times = np.diff(np.append(new, len(word)))
            ends = np.searchsorted(owner[new], np.arange(len(n) + 1)).astype(np.int32)
            raw = pa.py_buffer(number.astype("<u2").tobytes())
            columns = [
                batch.column("doc_id"), batch.column("key"), batch.column("round"), pa.array(n), pa.array(known), pa.array(base), pa.array(within),
                pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer((2 * off).astype(np.int32).tobytes()), raw]),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(word[new].view(np.int64))), pa.ListArray.from_arrays(pa.array(ends), pa.array(times.astype(np.int32))),
            ]
            yield pa.record_batch(columns, ["doc_id", "key", "round", "n_tokens", "known", "base", "within", "numbers", "words", "times"])

    part = F.pmod(F.xxhash64("key", F.lit("network")), F.lit(rounds_of(v.total))).cast("int")
    kind = rows.schema["doc_id"].dataType.simpleString()
    rows = rows.select("doc_id", "key", F.when(F.col("learns"), part).otherwise(-1).alias("round"), "text")
    # In order of the rounds, so that each of them skips what others read.
    return stored(rows.mapInArrow(run, f"doc_id {kind}, {NUMBERED}").sortWithinPartitions("round"))


def rounds_of(tokens_: int) -> int:
    return ROUNDS + int((tokens_ / ROUND_TOKENS) ** (1 / 3))


def trained(texts: DataFrame, v: Vocabulary) -> np.ndarray:
    """Weights learned from the texts of rows key, text."""
    return learned(numbered(texts.select(F.lit(None).cast("long").alias("doc_id"), "key", F.lit(True).alias("learns"), "text"), v), v)


def learned(every: DataFrame, v: Vocabulary) -> np.ndarray:
    """Weights averaged over what tasks have learned from their numbered texts, each with its number of tokens."""
    flat = start(v)
    tasks = every.sparkSession.sparkContext.defaultParallelism
    for turn in range(rounds_of(v.total)):
        begin = flat

        def learn(batches: Iterable[pa.RecordBatch], begin: np.ndarray = begin) -> Iterator[pa.RecordBatch]:
            held, now, waiting, seen = [], begin, 0, 0
            for batch in batches:
                for cell in batch.column("numbers"):
                    held.append(np.frombuffer(cell.as_buffer(), "<u2"))
                    waiting += len(held[-1])
                    if waiting > TOGETHER:
                        now, seen = train(now, np.concatenate(held).astype(np.int64)), seen + waiting
                        held, waiting = [], 0
            if held:
                now, seen = train(now, np.concatenate(held).astype(np.int64)), seen + waiting
            if seen:
                yield row(now, seen)

        def row(weights: np.ndarray, n: int) -> pa.RecordBatch:
            raw = weights.astype(np.float32).tobytes()
            return pa.record_batch([pa.array([n], pa.int64()), pa.array([raw], pa.binary())], ["n", "weights"])

        def mean(pairs: list[tuple[int, bytes]]) -> np.ndarray:
            return sum(np.frombuffer(w, np.float32) * (n / sum(n for n, _ in pairs)) for n, w in pairs)

        def add(key: tuple, rows: pa.Table) -> pa.Table:
            n = rows.column("n").to_pylist()
            return pa.Table.from_batches([row(mean(list(zip(n, rows.column("weights").to_pylist(), strict=True))), sum(n))])

        sums = stored(every.where(F.col("round") == turn).select("numbers").coalesce(tasks).mapInArrow(learn, "n long, weights binary"))
        while (count := sums.count()) > MERGED:
            groups = -(-count // MERGED)
            sums = stored(sums.groupBy(F.pmod(F.xxhash64("n", "weights"), F.lit(groups))).applyInArrow(add, "n long, weights binary"))
        rows = sums.collect()
        if rows:
            flat = mean([(r.n, bytes(r.weights)) for r in rows]).astype(np.float32)
    return flat


@np.errstate(over="ignore")
def likelihoods(p: dict, numbers: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Natural logarithm of each text's probability, its state carried from the first token to the end."""
    counts = np.diff(off)
    order = np.argsort(-counts, kind="stable")
    n = counts[order]
    total = np.zeros(len(order))
    longest = int(n[0]) if len(n) else 0
    # Texts that still go on at each step, the longest first; tokens in the order of the steps.
    live_at = len(n) - np.searchsorted(n[::-1], np.arange(longest), "right")
    begin_at = np.concatenate(([0], np.cumsum(live_at)))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    text = np.repeat(rank, counts)
    place = begin_at[np.arange(len(text)) - np.repeat(off[:-1] - off[0], counts)] + text
    target, of = np.empty(len(text), np.int64), np.empty(len(text), np.int64)
    target[place], of[place] = numbers[off[0] : off[0] + len(text)], text
    a, wide = joined(p), max(1, len(order))
    given_room, cells_room = np.ones((GIVEN + STATE) * wide, np.float32), np.empty(CELLS * wide, np.float32)
    before, now = np.zeros(STATE * wide, np.float32), np.empty(STATE * wide, np.float32)
    states = np.empty((PREDICTED + wide, STATE), np.float32)
    last, begin, had = np.zeros(len(order), np.int64), 0, len(order)
    for i, (at, end) in enumerate(zip(begin_at[:-1].tolist(), begin_at[1:].tolist(), strict=True), 1):
        live = end - at
        given = given_room[: (GIVEN + STATE) * live].reshape(-1, live)
        given[:EMBEDDING] = p["embedding"].take(last[:live], axis=0).T
        given[EMBEDDING] = 1
        given[GIVEN:] = before[: STATE * had].reshape(STATE, had)[:, :live]
        h = now[: STATE * live].reshape(STATE, live)
        advance(a, given, cells_room[: CELLS * live].reshape(-1, live), h)
        states[at - begin : end - begin] = h.T
        before, now, had = now, before, live
        last = target[at:end]
        if end - begin >= PREDICTED or i == longest:
            logs, _ = predictions(p, states[: end - begin], target[begin:end])
            total += np.bincount(of[begin:end], logs, len(total))
            begin = end
    out = np.zeros(len(order))
    out[order] = total
    return out


def scored(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", held: int = 10) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows whose crc32 of doc_id, as text, is no multiple of ``held``. A null or blank
    text is the end alone. Rows that repeat are returned as often, with equal scores. Rows without
    doc_id are told apart by their texts. A doc_id names one text. An empty table gives no rows;
    without training rows all words are unknown. Other columns are not looked at.
    """
    ready(docs.sparkSession)
    key = F.coalesce(F.col(doc_id).cast("long"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    rows = docs.select(F.col(doc_id).alias("doc_id"), key.alias("key"), F.col(text).alias("text")).withColumn("learns", ~held_out(parts=held))
    counts = stored(word_counts(rows.where("learns").select("text")))
    v = vocabulary(counts)
    every = numbered(rows, v)
    flat = learned(every, v)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = views(flat)
        for group in grouped(batches):
            raw = [text_bytes(g.column("numbers")) for g in group]
            off = np.concatenate(([0], np.cumsum(np.concatenate([np.diff(o) for _, o in raw]) // 2)))
            score = likelihoods(p, np.concatenate([data.view("<u2") for data, _ in raw]), off) / np.log(10)
            at = 0
            for g in group:
                model = pc.add(g.column("within"), pa.array(score[at : at + g.num_rows]))
                at += g.num_rows
                yield pa.record_batch([*(g.column(name) for name in kept), model], [*kept, "model"])
        give_back()

    def grouped(batches: Iterable[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
        held_, waiting = [], 0
        for batch in batches:
            # Numbers take two bytes each.
            for part in pieces([batch], "numbers", 2 * TOGETHER):
                held_.append(part)
                waiting += pc.sum(part.column("n_tokens")).as_py()
                if waiting > TOGETHER:
                    yield held_
                    held_, waiting = [], 0
        if held_:
            yield held_

    kept = ["doc_id", "key", "n_tokens", "known", "base"]
    schema = ", ".join(f"{name} {every.schema[name].dataType.simpleString()}" for name in kept)
    part = stored(every.select(*kept, "within", "numbers").mapInArrow(run, f"{schema}, model double"))
    rare = every.select("key", F.explode(F.arrays_zip("words", "times")).alias("w")).select("key", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    met = rare.join(counts.select("word", "n"), "word", "left").groupBy("key").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(0.1))).alias("logs"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("found")
    )
    copies = part.groupBy("key").agg(F.count("*").alias("copies"))
    out = part.join(copies, "key").join(met, "key", "left")
    logs = F.coalesce(F.col("logs") / F.col("copies"), F.lit(0.0))
    found = F.coalesce((F.col("found") / F.col("copies")).cast("long"), F.lit(0))
    return out.select(
        "doc_id",
        held_out(parts=held).alias("held_out"),
        "n_tokens",
        (F.col("known") + found).alias("n_known"),
        F.lit(v.total).cast("long").alias("train_tokens"),
        (F.col("base") + logs).alias("base_score"),
        (F.col("model") + logs).alias("score"),
    )
