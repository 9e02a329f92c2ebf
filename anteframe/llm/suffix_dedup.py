"""Repeated passages removed by a distributed merge sort of suffixes that knows common prefixes.

Only chosen suffixes are sorted: each string of ``SPAN`` bytes belongs to the place of its least
hash of ``GRAM`` bytes, a choice that equal strings make alike. Such a place stands for all strings
that belong to it, a run of neighbours; its key is the text from the place to the right as far as
they reach, then to the left, backwards. Places whose ``GRAM`` bytes occur once in all texts are
left out before anything is sorted.

Each task sorts its keys, drops those it holds twice, and cuts the run at common splitters. Runs
travel front-coded: the bytes a key shares with the one before it are a number. A loser tree merges
the runs of a range and compares two keys only beyond the prefix both are known to share with the
last one out; equal keys come out one after the other, and all but the earliest are repeats.

Keys that share their first ``GRAM`` bytes but differ are neighbours in that order. Where two of
them may share a string of ``SPAN`` bytes, by the prefixes the merge has found, their strings are
looked at one by one. If such a group reaches the edge of a range, its strings, one of each, are
sorted and merged in a second round by the same steps. So no group has to fit one task.
"""

from __future__ import annotations

import bisect
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import BROADCAST_IDS, of_ids, ready, stored
from ._text import mix, pieces, text_bytes, window_hash

SPAN = 100
GRAM = 24
#: Longer texts are looked at in parts of so many bytes, which overlap.
PART = 1 << 20
#: Keys that a task sorts at a time, keys of a range, and ranges at most.
RUN, RANGE, RANGES = 150_000, 60_000, 20_000
#: Keys sampled for each range, and spans that a task collects before it joins those that touch.
SAMPLED, JOINED = 64, 100_000

SPANS = "array<struct<start:bigint,stop:bigint>>"


def least_in_window(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(data: np.ndarray, off: np.ndarray, span: int) -> tuple[np.ndarray, ...]:
    """Places that strings of ``span`` bytes belong to: text, place, first and last start, gram hash."""
    none = np.zeros(0, np.int64)
    if len(data) < span:
        return none, none, none, none, none.astype(np.uint64)
    grams = window_hash(data, GRAM)
    # Place in the low bits: of equal hashes the first one counts.
    packed = (grams >> np.uint64(24) << np.uint64(24)) | np.arange(len(grams), dtype=np.uint64)
    place = (least_in_window(packed, span - GRAM + 1) & np.uint64((1 << 24) - 1)).astype(np.int64)
    valid = np.zeros(len(data) + 1, np.int64)
    np.add.at(valid, off[:-1], 1)
    np.add.at(valid, np.maximum(off[1:] - span + 1, off[:-1]), -1)
    starts = np.flatnonzero(np.cumsum(valid[:-1]) > 0)
    place = place[starts]
    text = np.searchsorted(off, starts, "right") - 1
    new = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (text[1:] != text[:-1]))))
    last = np.concatenate((new[1:], [len(starts)])) - 1
    if not len(starts):
        return none, none, none, none, none.astype(np.uint64)
    return text[new], place[new], starts[new], starts[last], grams[place[new]]


class Texts:
    """The texts of a batch as parts no longer than ``PART``, with their anchors."""

    def __init__(self, batch: pa.RecordBatch, span: int) -> None:
        data, off = text_bytes(batch.column("text"))
        self.data = data
        row, first, stop = [], [], []
        for r, (a, z) in enumerate(zip(off[:-1].tolist(), off[1:].tolist(), strict=True)):
            for at in range(a, max(a + 1, z - span + 1), PART):
                row.append(r)
                first.append(at)
                stop.append(min(z, at + PART + span - 1))
        self.off = off
        found = []
        i = 0
        while i < len(row):
            j = i + 1
            while j < len(row) and first[j] == stop[j - 1] and stop[j] - first[i] <= 2 * PART:
                j += 1
            bounds = np.array([*first[i:j], stop[j - 1]]) - first[i]
            text, *places, gram = anchors(data[first[i] : stop[j - 1]], bounds, span)
            found.append((np.array(row[i:j])[text], *(p + first[i] for p in places), gram))
            i = j
        self.row, self.place, self.low, self.high, self.gram = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 5


def gram_counts(docs: DataFrame, span: int) -> DataFrame:
    """gram, doc_id, n: how often each chosen gram is in each document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            t = Texts(batch, span)
            order = np.lexsort((t.gram, t.row))
            row, gram = t.row[order], t.gram[order]
            new = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])))) if len(row) else np.zeros(0, np.int64)
            n = np.diff(np.append(new, len(row)))
            yield pa.record_batch(
                [pa.array(gram[new].view(np.int64)), batch.column("doc_id").take(pa.array(row[new])), pa.array(n.astype(np.int32))], ["gram", "doc_id", "n"]
            )

    return docs.mapInArrow(run, "gram long, doc_id long, n int")


def shared_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix; the first ``known`` bytes are not looked at."""
    n = min(len(a), len(b))
    while known < n:
        x, y = a[known : known + 32], b[known : known + 32]
        if x != y:
            m = min(len(x), len(y))
            differ = int.from_bytes(x[:m]) ^ int.from_bytes(y[:m])
            return known + (m - (differ.bit_length() + 7) // 8 if differ else m)
        known += len(x)
    return n


def front_coded(keys: list[bytes]) -> bytes:
    """Sorted keys, each as how much it shares with the last one, how long its rest is, and the rest."""
    out, last = bytearray(), b""
    for key in keys:
        h = shared_prefix(last, key, 0)
        out += bytes((h, len(key) - h))
        out += key[h:]
        last = key
    return zlib.compress(bytes(out), 1)


def uncoded(blob: bytes) -> Iterator[tuple[int, bytes]]:
    """The keys with what each shares with the one before."""
    raw, at, last = zlib.decompress(blob), 0, b""
    while at < len(raw):
        h, n = raw[at], raw[at + 1]
        last = last[:h] + raw[at + 2 : at + 2 + n]
        at += 2 + n
        yield h, last


def merged(runs: list[Iterator[tuple[int, bytes]]]) -> Iterator[tuple[int, int, bytes]]:
    """All keys in order: what each shares with the one before it, its run, and the key.

    A loser tree. ``shared[i]`` is what the current key of run i shares with the key that beat it,
    so of two that meet, the one that shares more with the last winner is smaller without a look
    at either; only if both share as much, the bytes beyond decide.
    """
    k = max(1, len(runs))
    key: list[bytes | None] = [None] * k
    shared = [-1] * k
    for i, run in enumerate(runs):
        first = next(run, None)
        if first:
            key[i], shared[i] = first[1], 0

    def beaten(a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two runs whose keys share their numbers with the same key."""
        x, y = shared[a], shared[b]
        if x != y:
            return (a, b) if x > y else (b, a)
        if x < 0:
            return a, b
        h = shared_prefix(key[a], key[b], x)
        p, q = key[a], key[b]
        if h == len(p) or (h < len(q) and p[h] < q[h]):
            shared[b] = h
            return a, b
        shared[a] = h
        return b, a

    loser = [-1] * k

    def build(node: int) -> int:
        if node >= k:
            return node - k
        win, lost = beaten(build(2 * node), build(2 * node + 1))
        loser[node] = lost
        return win

    best = build(1) if k > 1 else 0
    while key[best] is not None:
        yield shared[best], best, key[best]
        following = next(runs[best], None)
        if following:
            shared[best], key[best] = following
        else:
            shared[best], key[best] = -1, None
        node = (best + k) >> 1
        while node:
            best, loser[node] = beaten(best, loser[node])
            node >>= 1


#: A key that stands for an earliest place: document, place, first and last start, as offsets.
PLACE = np.dtype([("doc", "<i8"), ("place", "<i8"), ("low", "u1"), ("high", "u1")])

RUNS = "part int, keys binary, places binary, doc_id long, start long, stop long"
FOUND = "doc_id long, start long, stop long, key binary"


def joined_spans(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans (document, start, stop) in order, those that touch as one."""
    out: list[list[int]] = []
    for doc, start, stop in sorted(spans):
        if out and out[-1][0] == doc and start <= out[-1][2]:
            out[-1][2] = max(out[-1][2], stop)
        else:
            out.append([doc, start, stop])
    return [tuple(s) for s in out]


class Spans(list):
    """Spans that are joined whenever they have doubled: one document gives one for each start."""

    limit = 0

    def append(self, span: tuple[int, int, int]) -> None:
        super().append(span)
        if len(self) > max(self.limit, JOINED):
            self[:] = joined_spans(self)
            self.limit = 2 * len(self)


def sorted_run(entries: list[tuple], splitters: list[bytes], span: int) -> Iterator[pa.RecordBatch]:
    """A task's entries (key, doc, place, low, high) as runs for each range, and repeats within them."""
    entries.sort()
    parts: dict[int, tuple[list[bytes], list[tuple]]] = {}
    spans, last = Spans(), None
    for key, doc, place, low, high in entries:
        if key == last:
            if (doc, place) != at:
                spans.append((doc, place - low, place - high + span))
            continue
        last, at = key, (doc, place)
        part = parts.setdefault(bisect.bisect_right(splitters, key), ([], []))
        part[0].append(key)
        part[1].append((doc, place, low, high))
    spans = joined_spans(spans)
    n, m = len(parts), len(spans)
    columns = [
        pa.array([*parts, *[None] * m], pa.int32()),
        pa.array([*(front_coded(k) for k, _ in parts.values()), *[None] * m], pa.binary()),
        pa.array([*(np.array(p, PLACE).tobytes() for _, p in parts.values()), *[None] * m], pa.binary()),
        *(pa.array([*[None] * n, *(s[i] for s in spans)], pa.int64()) for i in range(3)),
    ]
    yield pa.record_batch(columns, [c.split()[0] for c in RUNS.split(", ")])


def batches_of_runs(entries: Iterator[tuple], splitters: list[bytes], span: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for e in entries:
        held.append(e)
        if len(held) >= RUN:
            yield from sorted_run(held, splitters, span)
            held = []
    if held:
        yield from sorted_run(held, splitters, span)


def place_entries(batches: Iterable[pa.RecordBatch], span: int, one_in: int = 0) -> Iterator[tuple]:
    """Key, document, place, and how far before it the first and last string start, of repeated grams."""
    for batch in pieces(batches, "text"):
        t = Texts(batch, span)
        raw = t.data.tobytes()
        docs = batch.column("doc_id").to_pylist()
        for r in range(batch.num_rows):
            i, j = np.searchsorted(t.row, (r, r + 1))
            wanted = batch.column("grams")[r].values.to_numpy().view(np.uint64)
            keep = np.isin(t.gram[i:j], wanted)
            base = int(t.off[r])
            if one_in:
                # By document and place: a gram that many documents share is drawn as often as it occurs.
                keep &= mix(mix(np.array([docs[r]], np.int64).view(np.uint64)) + (t.place[i:j] - base).astype(np.uint64)) % np.uint64(one_in) == 0
            keep = np.flatnonzero(keep) + i
            for p, a, z in zip(t.place[keep].tolist(), t.low[keep].tolist(), t.high[keep].tolist(), strict=True):
                right, left = raw[p : z + span], raw[a:p][::-1]
                yield right + left + bytes((len(left), len(right))), docs[r], p - base, p - a, p - z


def merge_range(rows: pa.Table) -> Iterator[tuple[int, bytes, int, int, int, int]]:
    """Distinct keys of a range in order, with what each shares with the last, and all its places."""
    places = [np.frombuffer(x.as_py(), PLACE).tolist() for x in rows.column("places")]
    at = [0] * len(places)
    for h, run, key in merged([uncoded(x.as_py()) for x in rows.column("keys")]):
        yield h, key, places[run][at[run]]
        at[run] += 1


def distinct(keys: Iterator[tuple], span: int, spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, bytes, tuple]]:
    """One of each key, its earliest place; places of the others go to ``spans``."""
    held, share = None, 0
    for h, key, place in keys:
        if held and key == held[0]:
            early, late = sorted((held[1], place))
            if early[:2] != late[:2]:
                spans.append((late[0], late[1] - late[2], late[1] - late[3] + span))
            held = key, early
            continue
        if held:
            yield share, *held
        held, share = (key, place), h
    if held:
        yield share, *held


def looked_at(group: list[tuple[int, bytes, tuple]], span: int, spans: list[tuple[int, int, int]], open_: bool) -> list[tuple[bytes, int, int]]:
    """Strings that different keys with the same first bytes share; if ``open_``, one of each string."""
    reach = [max(group[i][0] if i else 0, group[i + 1][0] if i + 1 < len(group) else 0) for i in range(len(group))]
    if open_:
        reach[0] = reach[-1] = span
    out: list[tuple[bytes, int, int]] = []
    rows = []
    for (_, key, (doc, place, low, high)), h in zip(group, reach, strict=True):
        n_left, n_right = key[-2], key[-1]
        least = max(high, span - min(h, n_right))
        if least <= low:
            rows.append((key[:n_right], key[n_right : n_right + n_left], doc, place, least, low))
    if not open_ and len(rows) < 2:
        return out
    for x in range(min((r[4] for r in rows), default=1), max((r[5] for r in rows), default=0) + 1):
        seen: dict[bytes, tuple[int, int]] = {}
        for right, left, doc, place, least, most in rows:
            if least <= x <= most:
                string, now = left[:x][::-1] + right[: span - x], (doc, place - x)
                early = seen.get(string)
                if early is None:
                    seen[string] = now
                elif early != now:
                    if now < early:
                        seen[string], now = now, early
                    spans.append((*now, now[1] + span))
        if open_:
            out += [(s, *at) for s, at in seen.items()]
    return out


def first_round(span: int) -> Callable[[pa.Table], pa.Table]:
    def run(rows: pa.Table) -> pa.Table:
        spans = Spans()
        strings: list[tuple[bytes, int, int]] = []
        group: list[tuple[int, bytes, tuple]] = []
        first = True
        for h, key, place in distinct(merge_range(rows), span, spans):
            if group and h < GRAM:
                if len(group) > 1 or first:
                    strings += looked_at(group, span, spans, first)
                group, first = [], False
            group.append((h, key, place))
        if group:
            strings += looked_at(group, span, spans, True)
        return found(spans, strings)

    return run


def second_round(span: int) -> Callable[[pa.Table], pa.Table]:
    def run(rows: pa.Table) -> pa.Table:
        spans = Spans()
        for _ in distinct(merge_range(rows), span, spans):
            pass
        return found(spans, [])

    return run


def found(spans: list[tuple[int, int, int]], strings: list[tuple[bytes, int, int]]) -> pa.Table:
    spans = joined_spans(spans)
    n, m = len(spans), len(strings)
    return pa.table(
        {
            "doc_id": pa.array([*(s[0] for s in spans), *(s[1] for s in strings)], pa.int64()),
            "start": pa.array([*(s[1] for s in spans), *(s[2] for s in strings)], pa.int64()),
            "stop": pa.array([*(s[2] for s in spans), *[None] * m], pa.int64()),
            "key": pa.array([*[None] * n, *(s[0] for s in strings)], pa.binary()),
        }
    )


def splitters(keys: DataFrame, ranges: int) -> list[bytes]:
    """Keys that cut all keys into ranges of about equally many places, from a sample of places."""
    sample = sorted(keys.toArrow().column("key").to_pylist())
    return sorted({sample[len(sample) * i // ranges] for i in range(1, ranges)}) if sample else []


def range_cuts(suspects: DataFrame, places: int, span: int) -> list[bytes]:
    """Splitters of the keys of all ``places``."""
    ranges = max(1, min(RANGES, places // RANGE))
    one_in = max(1, places // (SAMPLED * ranges))

    def sample(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = [e[0] for e in place_entries(batches, span, one_in)]
        yield pa.record_batch([pa.array(keys, pa.binary())], ["key"])

    return splitters(suspects.mapInArrow(sample, "key binary"), ranges) if ranges > 1 else []


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", span: int = SPAN) -> DataFrame:
    """doc_id and spans (bytes) of each document that holds strings of ``span`` bytes that also start earlier.

    Earlier is a smaller doc_id, or an earlier start in the same document. Documents without such
    strings, without doc_id, or shorter than ``span`` are not in the result. Rows that repeat are
    one document.
    """
    if span < 2 * GRAM or span > 120:
        raise ValueError("span is from 48 to 120 bytes")
    ready(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("doc_id IS NOT NULL")
    counts = gram_counts(rows, span)
    often = counts.groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1").select("gram")
    held = stored(counts.join(often, "gram").groupBy("doc_id").agg(F.collect_set("gram").alias("grams"), F.sum("n").alias("places")))
    n = held.agg(F.coalesce(F.sum("places"), F.lit(0)).alias("n")).first().n
    # Read twice, for the splitters and for the runs.
    suspects = stored(of_ids(rows, held, "doc_id", "left_semi").join(held.drop("places"), "doc_id"))
    cuts = range_cuts(suspects, n, span)

    def sort(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches_of_runs(place_entries(batches, span), cuts, span)

    runs = stored(suspects.mapInArrow(sort, RUNS))
    one = stored(runs.where("part IS NOT NULL").select("part", "keys", "places").groupBy("part").applyInArrow(first_round(span), FOUND))

    open_ = one.where("key IS NOT NULL")
    left = open_.count()
    ranges = max(1, min(RANGES, left // RANGE))
    share = F.pmod(F.xxhash64("key", "doc_id", "start"), F.lit(max(1, left // (SAMPLED * ranges)))) == 0
    second = splitters(open_.where(share).select("key"), ranges) if ranges > 1 else []

    def sort_strings(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((k.as_py(), d.as_py(), s.as_py(), 0, 0) for b in batches for k, d, s in zip(b.column("key"), b.column("doc_id"), b.column("start"), strict=True))
        yield from batches_of_runs(rows, second, span)

    more = stored(open_.select("key", "doc_id", "start").mapInArrow(sort_strings, RUNS))
    two = more.where("part IS NOT NULL").select("part", "keys", "places").groupBy("part").applyInArrow(second_round(span), FOUND)
    all_spans = [x.where("stop IS NOT NULL").select("doc_id", "start", "stop") for x in (runs, one, more, two)]
    every = all_spans[0].unionByName(all_spans[1]).unionByName(all_spans[2]).unionByName(all_spans[3])
    return every.groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans")).select("doc_id", F.col("spans").cast(SPANS).alias("spans"))


def kept_bytes(raw: bytes, spans: Iterable[dict]) -> tuple[bytes, int]:
    """What is left of a text, and how many runs were taken out."""
    out, at, n = [], 0, 0
    stop = -1
    for s in spans:
        if s["start"] > stop:
            n += 1
        if s["start"] > at:
            out.append(raw[at : s["start"]])
        at = max(at, s["stop"])
        stop = max(stop, s["stop"])
    return b"".join([*out, raw[at:]]), n


def cut_rows(docs: DataFrame, spans: DataFrame, doc_id: str, text: str) -> DataFrame:
    """All rows and columns of ``docs``, the text as a struct: kept (bytes), n_bytes, n_removed, n_spans."""
    names = docs.columns
    column = f"spans_{uuid.uuid4().hex}"
    schema = ", ".join(f"`{f.name}` {RESULT if f.name == text else f.dataType.simpleString()}" for f in docs.schema)
    result = pa.struct([("kept", pa.binary()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            cells = []
            for t, s in zip(batch.column(text).to_pylist(), batch.column(column).to_pylist(), strict=True):
                raw = (t or "").encode()
                kept, n = kept_bytes(raw, s or [])
                cells.append({"kept": kept, "n_bytes": len(raw), "n_removed": len(raw) - len(kept), "n_spans": n})
            out = batch.select(names)
            yield out.set_column(out.schema.get_field_index(text), text, pa.array(cells, result))

    ids = spans.select(F.col("doc_id").alias(column), F.col("spans").alias(f"{column}_of"))
    few = ids.count() <= BROADCAST_IDS
    key = ids.select(column)
    at = F.col(doc_id).cast("long") == F.col(column)
    met = docs.join(F.broadcast(key) if few else key, at, "left_semi").join(ids, at).drop(column).withColumnRenamed(f"{column}_of", column)
    rest = docs.join(F.broadcast(key) if few else key, at, "left_anti").withColumn(column, F.lit(None).cast(SPANS))
    return met.unionByName(rest).mapInArrow(run, schema)


RESULT = "struct<kept:binary,n_bytes:bigint,n_removed:bigint,n_spans:bigint>"


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", span: int = SPAN) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept (the bytes that are left).

    Every byte is taken out that a string of ``span`` bytes covers which also starts earlier: in a
    document with a smaller doc_id, or before in the same one. Strings are judged on the texts as
    they come. A null text is empty. Rows that repeat are returned as often, all cut alike. A row
    without doc_id is kept whole and makes nothing a repeat. A doc_id names one text. An empty table
    gives no rows. Other columns are not looked at.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return cut_rows(rows, stored(repeats(docs, doc_id, text, span)), "doc_id", "text").select("doc_id", "text.n_bytes", "text.n_removed", "text.n_spans", "text.kept")


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", span: int = SPAN) -> DataFrame:
    """``docs`` with their texts cut as by ``deduplicated``; characters cut in two go whole.

    All rows and columns stay, also of texts that are empty by then; a null text becomes empty.
    """
    cut = cut_rows(docs, stored(repeats(docs, doc_id, text, span)), doc_id, text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            kept = batch.column(at).field("kept").to_pylist()
            yield batch.set_column(at, text, pa.array([k.decode(errors="ignore") for k in kept], pa.string()))

    return cut.mapInArrow(run, docs.schema)


def digest(found_: DataFrame) -> DataFrame:
    """Counts and a checksum of what is left for each document."""
    return found_.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))

