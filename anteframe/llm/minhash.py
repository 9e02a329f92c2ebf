"""Near duplicates by a join of inverted MinHash signatures.

Every text becomes its set of word shingles and a signature of ``COORDINATES`` minima. Texts with
equal sets are one class from the start, so copies never meet each other. Each class is posted
under every (coordinate, value) it holds; values that no other class holds are dropped, and with
them all classes that cannot reach ``MATCHES`` common coordinates. Of the rest, in the order of
how rare the values are, only a prefix is needed: two classes with enough common coordinates
share one of the first ``held - MATCHES + 1``.

Postings are read in two passes, so that a large group of near copies never becomes all its pairs:

1. Every class counts its collisions with the hub of each of its postings, the class that shares most
   values with others, and is compared with the ``HUBS`` best of at least ``MATCHES``. That links
   nearly all of a group by about as many comparisons as it has members.
2. Postings whose classes are one component by now are skipped whole; those of more than ``PARTED`` are
   parted by the second value that two classes share. The others are compared in blocks of bounded size: only
   pairs of different components, only at the first posting that both share, only with ``MATCHES``
   collisions of coordinates, and only if a second, wider signature leaves the threshold within
   reach. What is left is compared by the whole set of hashes cut to 32 bits (sets up to ``FEW``) or
   by a third, still wider signature, so that of pairs short of the threshold few leave the task.

Candidates of both passes are confirmed on the full sets, in cells of bounded size: a set moves once
for a cell, however many pairs it has there.

Chance decides only at the threshold itself: with 48 coordinates a pair of similarity 0.8 has fewer
than 25 in common in 3 of a million cases, and fails the wider signature in 4 of a million; from 0.85
on both together stay under one of ten million.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._graph import components
from ._store import of_ids, ready, stored
from ._text import BLANKS, Words, give_back, mix, pieces, run_hash, text_bytes

COORDINATES = 48
MATCHES = 25
#: The second signature: one byte for each coordinate, and the common ones that are asked for.
WIDE = 192
WIDE_MATCHES = 128
#: Sets up to ``FEW`` go along whole; sets from ``MANY`` on, which is lower so that any two sets of
#: similar size have one of the two, by a third signature.
FEW, MANY = 320, 256
FINE = 1024
FINE_MATCHES = 755
#: Classes of a posting that are compared as one block.
BLOCK = 512
#: Classes of a posting beyond which it is parted: from here on a class is repeated for more blocks
#: than it has further values to be parted by.
PARTED = (COORDINATES - MATCHES + 1) * BLOCK
#: Hubs that a class is compared with in the first pass.
HUBS = 2
#: Shingles of all sets that are confirmed together, or two sets.
CELL = 1 << 18

_RNG = np.random.default_rng(8_0_8)
_A = _RNG.integers(1 << 31, size=(3, FINE), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _RNG.integers(1 << 32, size=(3, FINE), dtype=np.uint32)


def shingle_sets(batch: pa.RecordBatch, text: str, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text. Fewer words than a shingle has: all as one."""
    data, off = text_bytes(batch.column(text))
    found = Words(data, off, BLANKS)
    hashes = run_hash(found.hash, words)
    for start, stop in zip(found.off[:-1].tolist(), found.off[1:].tolist(), strict=True):
        n = stop - start
        if n >= words:
            whole = np.sort(hashes[start : stop - words + 1])
            yield whole[np.concatenate(([True], whole[1:] != whole[:-1]))]
        else:
            yield run_hash(found.hash[start:stop], n) if n else np.zeros(0, np.uint64)


def minima(hashes: np.ndarray, family: int, n: int) -> np.ndarray:
    """Least value of each of ``n`` functions over a set, a piece of a large set at a time."""
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(n, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(short), 4096):
        values = short[None, i : i + 4096] * _A[family, :n, None]
        values += _B[family, :n, None]
        np.minimum(least, values.min(axis=1), out=least)
    return least


def signatures(docs: DataFrame, doc_id: str, text: str, words: int) -> DataFrame:
    """doc_id, size of the set, two sums that name the set, and its coordinate-value pairs."""
    place = np.arange(COORDINATES, dtype=np.int64) << 32

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            n, one, two, tokens = [], [], [], []
            for s in shingle_sets(batch, "text", words):
                n.append(len(s))
                one.append(s.sum(dtype=np.uint64).astype(np.int64))
                two.append(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64))
                tokens.append(minima(s, 0, COORDINATES).astype(np.int64) + place if len(s) else place[:0])
            flat = np.concatenate(tokens)
            ends = np.cumsum([0, *map(len, tokens)]).astype(np.int32)
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                ["doc_id", "n_shingles", "sum1", "sum2", "tokens"],
            )

    ready(docs.sparkSession)
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, n_shingles long, sum1 long, sum2 long, tokens array<long>"
    )


def full_sets(docs: DataFrame, doc_id: str, text: str, words: int) -> DataFrame:
    """id, size, the whole set, its coordinates, the wide signature, and what settles most of the rest."""

    def bytes_of(s: np.ndarray, family: int, n: int) -> bytes:
        return (minima(s, family, n) >> np.uint32(24)).astype(np.uint8).tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            sets = list(shingle_sets(batch, "text", words))
            columns = [
                [s.tobytes() for s in sets],
                [minima(s, 0, COORDINATES).astype("<u4").tobytes() for s in sets],
                [bytes_of(s, 1, WIDE) for s in sets],
                [np.unique((s >> np.uint64(32)).astype("<u4")).tobytes() if len(s) <= FEW else b"" for s in sets],
                [bytes_of(s, 2, FINE) if len(s) >= MANY else b"" for s in sets],
            ]
            yield pa.record_batch(
                [batch.column("id"), pa.array([len(s) for s in sets], pa.int64()), *(pa.array(c, pa.binary()) for c in columns)],
                ["id", "n", "hashes", "values", "wide", "few", "fine"],
            )

    return docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(
        run, "id long, n long, hashes binary, values binary, wide binary, few binary, fine binary"
    )


def confirmed(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are as similar as asked.

    ``members`` has a row for each id of a cell, with the ids of the same cell to compare it with: a
    set moves once for each of its cells, not for each of its pairs.
    """

    def run(group: pa.Table) -> pa.Table:
        ids = group.column("id").to_pylist()
        sets_of = {i: np.frombuffer(x.as_py(), np.uint64) for i, x in zip(ids, group.column("hashes"), strict=True)}
        found = set()
        for i, others in zip(ids, group.column("others").to_pylist(), strict=True):
            for o in others:
                p, q = sorted((sets_of[i], sets_of[o]), key=len)
                both = int((q[np.minimum(np.searchsorted(q, p), len(q) - 1)] == p).sum())
                if 100 * both >= percent * (len(p) + len(q) - both):
                    found.add((min(i, o), max(i, o)))
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return members.join(sets.select("id", "hashes"), "id").groupBy("cell").applyInArrow(run, "a long, b long")


def spokes(suspects: DataFrame, percent: int) -> DataFrame:
    """Members of cells in which each class meets the ``HUBS`` hubs it has most coordinates in common with."""
    posted = suspects.select("id", "n", "weight", F.explode("prefix").alias("token"))
    hubs = posted.groupBy("token").agg(F.max(F.struct("weight", "id", "n")).alias("hub")).select("token", "hub.id", "hub.n")
    hubs = hubs.toDF("token", "hub", "hub_n")
    alike = (F.col("id") != F.col("hub")) & (F.least("n", "hub_n") * 100 >= F.greatest("n", "hub_n") * percent)
    near = posted.join(hubs, "token").where(alike).groupBy("id").agg(F.collect_set("hub").alias("hubs"))
    asked = suspects.select("id", "n", "held").join(near, "id").select("id", "n", "held", F.explode("hubs").alias("hub"))
    asked = asked.join(suspects.select(F.col("id").alias("hub"), F.col("held").alias("theirs")), "hub")
    counted = asked.select("id", "n", "hub", F.size(F.array_intersect("held", "theirs")).alias("common")).where(F.col("common") >= MATCHES)
    best = F.slice(F.sort_array(F.collect_list(F.struct("common", "hub")), False), 1, HUBS)
    best = counted.groupBy("id", "n").agg(best.alias("best"))
    chosen = stored(best.select("id", "n", F.explode("best.hub").alias("hub")))
    cells = -(-(chosen.agg(F.sum("n")).first()[0] or 1) // CELL)
    parts = chosen.groupBy("hub").agg(F.ceil(F.sum("n") / CELL).alias("parts"))
    salt = F.pmod(F.xxhash64("id"), F.col("parts"))
    dealt = chosen.join(parts, "hub").withColumn("cell", F.pmod(F.xxhash64("hub", salt), F.lit(cells)))
    none = F.array().cast("array<bigint>")
    return dealt.select("cell", "id", F.array("hub").alias("others")).unionByName(
        dealt.select("cell", F.col("hub").alias("id"), none.alias("others")).distinct()
    )


def open_postings(suspects: DataFrame, found: DataFrame) -> DataFrame:
    """Postings with more than one component: token, second, id, label, size.

    A posting of more than ``PARTED`` classes is parted by the second value that two classes share in
    their order: who has ``MATCHES`` in common has it among the first ``held - MATCHES + 2``.
    """
    label = F.coalesce("component_id", "id").alias("label")
    labelled = suspects.join(found, "id", "left").select("id", label, "prefix", "longer")

    def several(rows: DataFrame, *key: str) -> DataFrame:
        size = rows.groupBy(*key).agg(F.count("*").alias("size"), F.min("label").alias("low"), F.max("label").alias("high"))
        return size.where("low != high").select(*key, "size")

    first = stored(several(labelled.select("id", "label", F.explode("prefix").alias("token")), "token"))
    hot = first.where(F.col("size") > PARTED).select("token")
    rows = labelled.select("id", "label", "longer", F.explode("prefix").alias("token"))
    cold = rows.drop("longer").join(first.where(F.col("size") <= PARTED), "token").withColumn("second", F.lit(-1).cast("long"))
    after = F.expr("slice(longer, cast(array_position(longer, token) as int) + 1, size(longer))")
    parted = rows.join(hot, "token").select("id", "label", "token", F.explode(after).alias("second"))
    parted = parted.join(several(parted, "token", "second"), ["token", "second"])
    return cold.unionByName(parted)


def compared(postings: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components within the blocks of a posting that may be similar enough, as members of cells."""

    def run(key: tuple, group: pa.Table) -> pa.Table:
        token, second, i, j = (k.as_py() for k in key)
        ids, label, n = (group.column(c).to_numpy() for c in ("id", "label", "n"))
        block = group.column("block").to_numpy()
        wide = np.frombuffer(b"".join(group.column("wide").to_pylist()), np.uint8).reshape(len(ids), WIDE)
        held = np.frombuffer(b"".join(group.column("values").to_pylist()), "<u4").reshape(len(ids), COORDINATES)
        lists = group.column("longer").to_pylist()
        before = [set(x[: x.index(token if second < 0 else second)]) - {token} for x in lists]
        few = [np.frombuffer(x, "<u4") for x in group.column("few").to_pylist()]
        fine = [np.frombuffer(x, np.uint8) for x in group.column("fine").to_pylist()]

        def within_reach(x: int, others: list[int]) -> Iterator[int]:
            whole = [y for y in others if len(few[x]) and len(few[y])]
            if whole:
                both = np.concatenate([few[y] for y in whole])
                at = np.minimum(np.searchsorted(few[x], both), len(few[x]) - 1)
                common = np.add.reduceat(few[x][at] == both, np.cumsum([0, *(len(few[y]) for y in whole[:-1])]), dtype=np.int64)
                yield from (y for y, c in zip(whole, common.tolist(), strict=True) if 100 * c >= percent * (n[x] + n[y] - c))
            for y in others:
                if not (len(few[x]) and len(few[y])) and (fine[x] == fine[y]).sum() >= FINE_MATCHES:
                    yield y

        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        pairs = []
        for x in left.tolist():
            fit = right[(label[right] != label[x]) & (np.minimum(n[right], n[x]) * 100 >= np.maximum(n[right], n[x]) * percent)]
            if i == j:
                fit = fit[fit > x]
            if not len(fit):
                continue
            fit = fit[(held[fit] == held[x]).sum(axis=1) >= MATCHES]
            fit = fit[(wide[fit] == wide[x]).sum(axis=1) >= WIDE_MATCHES]
            pairs.extend((x, y) for y in within_reach(x, [y for y in fit.tolist() if before[x].isdisjoint(before[y])]))
        out: list[tuple[int, int, list[int]]] = []
        for at, cell in enumerate(in_cells(pairs, n.tolist())):
            name = hash((token, second, i, j, at))
            out.extend((name, int(ids[x]), ids[others].tolist()) for x, others in cell.items())
        cells, members, others = zip(*out, strict=True) if out else ((), (), ())
        return pa.table({"cell": pa.array(cells, pa.int64()), "id": pa.array(members, pa.int64()), "others": pa.array(others, pa.list_(pa.int64()))})

    last = F.floor((F.col("size") - 1) / BLOCK)
    mine = F.pmod(F.xxhash64("id", "token"), last + 1)
    other = F.explode(F.sequence(F.lit(0).cast("long"), last))
    dealt = postings.withColumn("block", mine).withColumn("other", other)
    return (
        dealt.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
        .groupBy("token", "second", "i", "j")
        .applyInArrow(run, "cell long, id long, others array<long>")
    )


def in_cells(pairs: list[tuple[int, int]], n: list[int]) -> Iterator[dict[int, list[int]]]:
    """Pairs in groups whose sets hold about ``CELL`` shingles together: each member, and whom it is compared with."""
    cell: dict[int, list[int]] = {}
    held = 0
    for x, y in sorted(pairs, key=lambda p: (p[0] >> 5, p[1] >> 5, p)):
        more = sum(n[z] for z in (x, y) if z not in cell)
        if cell and held + more > CELL:
            yield cell
            cell, held, more = {}, 0, n[x] + n[y]
        held += more
        cell.setdefault(x, []).append(y)
        cell.setdefault(y, [])
    if cell:
        yield cell


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Words are what stands between blanks, A-Z in lower case; two documents are linked if
    ``100 * common >= percent * all`` of their distinct shingles of ``words`` words. component_id is
    the smallest doc_id reachable by links.

    A null or blank text has no shingles and no links, but stands for itself. A row repeated whole
    is returned as often, in one component. A row without doc_id is returned with its size, no
    component and kept as true. An empty table gives no rows. Other columns are not looked at.
    ``percent`` under 80 needs other signature sizes and is refused.
    """
    if percent < 80:
        raise ValueError("the signature sizes hold from 80 percent on")
    rows = stored(signatures(docs, doc_id, text, words))
    named = rows.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = stored(
        named.groupBy("sum1", "sum2", "n_shingles").agg(F.min("doc_id").alias("id"), F.min_by("tokens", "doc_id").alias("tokens"))
    )
    posted = classes.select("id", F.col("n_shingles").alias("n"), F.explode("tokens").alias("token"))
    shared = posted.groupBy("token").agg(F.count("*").alias("size")).where("size > 1")
    held = posted.join(shared, "token").groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("size", "token"))).alias("held"))
    reach = F.size("held") - F.lit(MATCHES - 1)
    suspects = stored(
        held.where(reach > 0).select(
            "id",
            "n",
            F.col("held.token").alias("held"),
            F.slice(F.col("held.token"), 1, reach).alias("prefix"),
            F.slice(F.col("held.token"), 1, reach + 1).alias("longer"),
            F.aggregate("held", F.lit(0.0), lambda s, x: s + F.log(x["size"])).alias("weight"),
        )
    )
    sets = stored(
        full_sets(of_ids(docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")), suspects, "id", "left_semi"), "id", "text", words)
        .dropDuplicates(["id"])
    )
    links = stored(confirmed(spokes(suspects, percent), sets, percent))
    found = components(links)

    postings = open_postings(suspects, found).join(suspects.select("id", "longer"), "id").join(sets.drop("hashes"), "id")
    more = stored(confirmed(stored(compared(postings, percent)), sets, percent))
    if more.limit(1).count():
        found = components(links.unionByName(more))

    of_class = classes.join(found, "id", "left").select("sum1", "sum2", F.col("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))
    linked = rows.drop("tokens").join(of_class, ["sum1", "sum2", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return linked.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, with all columns, but one document of each component: the least doc_id.

    Of rows that repeat a doc_id one stays. Rows without doc_id, and texts without words, stay.
    """
    key = F.col(doc_id).cast("long")
    found = near_duplicates(docs, doc_id, text, words, percent)
    gone = stored(found.where("NOT kept").select(F.col("doc_id").alias(doc_id)).distinct())
    again = stored(docs.where(key.isNotNull()).groupBy(key.alias(doc_id)).agg(F.count("*").alias("n")).where("n > 1"))
    docs = of_ids(docs, gone, doc_id, "left_anti").select(docs.columns)
    if again.limit(1).count():
        once = of_ids(docs, again, doc_id, "left_semi").dropDuplicates([doc_id])
        docs = of_ids(docs, again, doc_id, "left_anti").unionByName(once).select(docs.columns)
    return docs
