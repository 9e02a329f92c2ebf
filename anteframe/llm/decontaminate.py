"""Benchmark passages in training texts, found by winnowing.

Fingerprints are the least of each ``WINDOW - GRAM + 1`` consecutive hashes of ``GRAM`` words, so
every shared run of ``WINDOW`` words has one at the same place of the run, on both sides. Training
fingerprints meet those of the benchmark by a lookup in a sorted table; each hit is then extended
to the windows around it, which are looked up among the distinct windows of the benchmark and
compared word by word. Items shorter than a window are looked up whole: their fingerprint is the
hash of all their words, at each place of a text. A window that many items share is held once, next
to the list of its items, so a hit costs the same however many there are.

The benchmark goes to the tasks in blocks of at most about ``BLOCK_WORDS`` words. One block is the
common case: one pass over the texts, nothing is shuffled. With more blocks each has its pass, and
what they found is put together by doc_id. Items longer than ``ITEM_WORDS`` words are cut into parts
that overlap by a window less one word, so no item is larger than a block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import ready, stored
from ._text import NOT_ALNUM, Words, pieces, run_hash, text_bytes

WINDOW = 10
GRAM = 5
#: Words of benchmark items that a task holds at a time, about 100 MB.
BLOCK_WORDS = 4_000_000
#: Words of an item that stay together.
ITEM_WORDS = 100_000
#: Pairs of a document's window and an item that are listed at a time.
LISTED = 1 << 20

SPANS = "array<struct<start:bigint,stop:bigint>>"


def winnowed(grams: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Places of the last least gram in each window of grams that begins at ``starts``."""
    width = WINDOW - GRAM + 1
    chosen = np.zeros(len(grams), bool)
    for i in range(0, len(starts), 1 << 16):
        part = starts[i : i + (1 << 16)]
        least = grams[part + (width - 1)]
        at = part + (width - 1)
        for j in range(width - 2, -1, -1):
            value = grams[part + j]
            less = value < least
            least = np.where(less, value, least)
            at = np.where(less, part + j, at)
        chosen[at] = True
    return np.flatnonzero(chosen)


def run_starts(off: np.ndarray, k: int) -> np.ndarray:
    """Places from which ``k`` words lie in one text."""
    n = int(off[-1])
    inside = np.zeros(n + 1, np.int64)
    stop = np.maximum(off[1:] - k + 1, off[:-1])
    np.add.at(inside, off[:-1], 1)
    np.add.at(inside, stop, -1)
    return np.flatnonzero(np.cumsum(inside[:n]) > 0)


class Items:
    """A block of benchmark items, ready for lookups."""

    def __init__(self, ids: list[str | None], texts: list[str | None]) -> None:
        data, off = text_bytes(pa.array(texts, pa.string()))
        words = Words(data, off, NOT_ALNUM)
        self.ids, self.hash = ids, words.hash
        item = np.repeat(np.arange(len(ids)), words.counts)
        #: For each number of words of a window: hashes of the distinct windows, sorted, a place of each, and where they are numbered from.
        self.tables: dict[int, tuple[np.ndarray, np.ndarray, int]] = {}
        self.prints = np.zeros(0, np.uint64)
        lists, ends, known = [], [np.zeros(1, np.int64)], 0
        for k in sorted({min(int(c), WINDOW) for c in words.counts if c}):
            if k == WINDOW:
                starts = run_starts(words.off, WINDOW)
                grams = run_hash(self.hash, GRAM)
                self.prints = np.unique(grams[winnowed(grams, starts)])
            else:
                starts = words.off[:-1][words.counts == k]
            windows, place, of = np.unique(run_hash(self.hash, k)[starts], return_index=True, return_inverse=True)
            self.tables[k] = windows, starts[place], known
            # Each window with each of its items once.
            order = np.lexsort((item[starts], of))
            of, mine = of[order], item[starts][order]
            new = np.ones(len(of), bool)
            new[1:] = (of[1:] != of[:-1]) | (mine[1:] != mine[:-1])
            lists.append(mine[new])
            ends.append(ends[-1][-1] + np.cumsum(np.bincount(of[new], minlength=len(windows))))
            known += len(windows)
        self.lists = np.concatenate(lists) if lists else np.zeros(0, np.int64)
        #: Where the items of each window begin in ``lists``, and where the last ones end.
        self.bounds = np.concatenate(ends)

    def hits(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, size and number of each window of a text that occurs in an item, one row for each start and size."""
        start, size, number = [], [], []
        for k, (windows, places, first) in self.tables.items():
            at = run_starts(words.off, k)
            if k == WINDOW:
                valid = np.zeros(len(words.hash) + 1, bool)
                valid[at] = True
                grams = run_hash(words.hash, GRAM)
                at = winnowed(grams, at)
                low = np.minimum(np.searchsorted(self.prints, grams[at]), len(self.prints) - 1)
                at = at[self.prints[low] == grams[at]]
                around = np.unique(at[:, None] - np.arange(WINDOW - GRAM + 1))
                around = around[around >= 0]
                at = around[valid[around]]
            if not len(at):
                continue
            found = run_hash(words.hash, k)[at]
            low = np.minimum(np.searchsorted(windows, found), len(windows) - 1)
            same = windows[low] == found
            at, low = at[same], low[same]
            same = np.ones(len(at), bool)
            for j in range(k):
                same &= words.hash[at + j] == self.hash[places[low] + j]
            start.append(at[same])
            size.append(np.full(same.sum(), k))
            number.append(first + low[same])
        none = np.zeros(0, np.int64)
        return tuple(np.concatenate(x) if x else none for x in (start, size, number))

    def named(self, rows: np.ndarray, windows: np.ndarray) -> np.ndarray:
        """Distinct pairs of a row and an item in which one of the row's windows occurs; lists of bounded size at a time."""
        pairs = np.unique(np.stack((rows, windows), 1), axis=0)
        n = self.bounds[pairs[:, 1] + 1] - self.bounds[pairs[:, 1]]
        done = np.zeros((0, 2), np.int64)
        cuts = np.flatnonzero(np.diff(np.cumsum(n) // LISTED)) + 1
        for part, m in zip(np.split(pairs, cuts), np.split(n, cuts), strict=True):
            item = self.lists[np.repeat(self.bounds[part[:, 1]] - np.cumsum(m) + m, m) + np.arange(m.sum())]
            done = np.unique(np.concatenate((done, np.stack((np.repeat(part[:, 0], m), item), 1))), axis=0)
        return done


def scan(docs: DataFrame, items: Items | None, only_hit: bool = False) -> DataFrame:
    """doc_id, n_words, runs of words that are hit, and the items with windows in the text."""
    spans = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            data, off = text_bytes(batch.column("text"))
            words = Words(data, off, NOT_ALNUM)
            start, size, window = items.hits(words) if items else (np.zeros(0, np.int64),) * 3
            depth = np.zeros(len(words.hash) + 1, np.int64)
            np.add.at(depth, start, 1)
            np.add.at(depth, start + size, -1)
            hit = np.cumsum(depth)[:-1] > 0
            of = np.searchsorted(words.off, start, "right") - 1
            ends = np.zeros(len(hit) + 1, bool)
            ends[words.off] = True
            first = np.flatnonzero(hit & (ends[:-1] | ~np.concatenate(([False], hit[:-1]))))
            last = np.flatnonzero(hit & (ends[1:] | ~np.concatenate((hit[1:], [False])))) + 1
            row = np.searchsorted(words.off, first, "right") - 1
            rows: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for r, a, z in zip(row.tolist(), first.tolist(), last.tolist(), strict=True):
                base = int(words.off[r])
                rows[r].append({"start": a - base, "stop": z - base})
            names: list[set[str]] = [set() for _ in range(batch.num_rows)]
            if len(of):
                for r, i in items.named(of, window).tolist():
                    if items.ids[i] is not None:
                        names[r].add(items.ids[i])
            out = pa.record_batch(
                [batch.column("doc_id"), pa.array(words.counts, pa.int64()), pa.array(rows, spans), pa.array([sorted(x) for x in names], pa.list_(pa.string()))],
                ["doc_id", "n_words", "spans", "items"],
            )
            yield out.filter(pa.array([bool(x) for x in rows], pa.bool_())) if only_hit else out

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, spans {SPANS}, items array<string>")


def blocks(benchmark: DataFrame, item_id: str, text: str) -> Callable[[], Iterator[Items]]:
    """The benchmark as blocks that fit a task."""
    rows = benchmark.select(F.col(item_id).cast("string").alias("item_id"), F.col(text).alias("text"))
    # Equal rows say the same; a long item is cut where the next part begins a window less one word earlier.
    words = F.regexp_extract_all("text", F.lit(r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"))
    first = F.sequence(F.lit(1), F.greatest(F.size("words") - (WINDOW - 1), F.lit(1)), F.lit(ITEM_WORDS))
    part = F.array_join(F.slice("words", F.col("first"), F.lit(ITEM_WORDS + WINDOW - 1)), " ")
    long = F.coalesce(F.length("text"), F.lit(0)) > 2 * ITEM_WORDS
    cut = rows.where(long).select("item_id", words.alias("words")).select("item_id", "words", F.explode(first).alias("first"))
    rows = rows.where(~long).unionByName(cut.select("item_id", part.alias("text"))).distinct()
    size = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first().n
    n = -(-size // (4 * BLOCK_WORDS)) or 1

    def each() -> Iterator[Items]:
        for i in range(n):
            part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).toArrow()
            yield Items(part.column("item_id").to_pylist(), part.column("text").to_pylist())

    each.n = n
    return each


def contamination(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_words, spans of words that are hit, items (ids as text).

    Words are runs of a-z, 0-9 and everything beyond ASCII, A-Z in lower case. A window is ten
    consecutive words of an item, or the whole of a shorter one. Null or wordless texts have no
    windows and are never hit; an item without id hits words but is not named. Rows that repeat
    are returned as often as they come. No benchmark rows: nothing is hit. A doc_id names one text
    (that matters only if the benchmark needs more than one block). Other columns are not looked at.
    """
    ready(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    each = blocks(benchmark, item_id, item_text)
    if each.n == 1:
        return scan(rows, next(each()))
    found = None
    for items in each():
        part = stored(scan(rows, items, only_hit=True).drop("n_words"))
        found = part if found is None else found.unionByName(part)
    return merged(scan(rows, None).select("doc_id", "n_words"), found)


def merged(counted: DataFrame, found: DataFrame) -> DataFrame:
    """What several passes found, put together for each document."""
    together = found.groupBy(F.col("doc_id").alias("of")).agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
    )
    none = F.array().cast(SPANS)
    joined = F.aggregate(
        "spans",
        none,
        lambda done, x: F.when(
            (F.size(done) > 0) & (x["start"] <= F.element_at(done, -1)["stop"]),
            F.concat(
                F.slice(done, F.lit(1), F.size(done) - 1),
                F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["stop"], x["stop"]).alias("stop"))),
            ),
        ).otherwise(F.concat(done, F.array(x))),
    )
    out = counted.join(together, F.col("doc_id").eqNullSafe(F.col("of")), "left")
    return out.select(
        "doc_id", "n_words", F.coalesce(joined, none).alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items")
    )


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, in which no window of the benchmark occurs."""
    ready(docs.sparkSession)

    def without(items: Items) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches, text):
                words = Words(*text_bytes(batch.column(text)), NOT_ALNUM)
                hit = np.zeros(batch.num_rows, bool)
                hit[np.searchsorted(words.off, items.hits(words)[0], "right") - 1] = True
                yield batch.filter(pa.array(~hit))

        return run

    each = blocks(benchmark, item_id, item_text)
    for i, items in enumerate(each()):
        docs = docs.mapInArrow(without(items), docs.schema)
        # A task holds one block at a time.
        docs = stored(docs) if i + 1 < each.n else docs
    return docs


def digest(found: DataFrame) -> DataFrame:
    """Counts and a checksum for each document."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["stop"] - x["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
