"""Hard negatives of anchors by a multiway hyperplane tree that stores distance ranges.

A node of the tree has up to ``FAN`` split points; a row goes to the nearest one (ties: the first).
For each pair of split points of a node, the range of distances from the one to all rows below the
other is stored. Rows with a score in a window lie in an annulus around the anchor, so a subtree
is left out if, for any split point beside it, its stored range cannot meet that annulus. Leaves
are cut into blocks of neighbouring distances with ranges of their own and are searched exactly.

Scores are inner products. With one more component all rows get the same length, and then a higher
score is a shorter distance; the anchor gets 0 there, so its scores stay as they are. Everything
that decides a result is computed in whole numbers; the ranges are widened by more than their
rounding error.

Two searches: the positives, best first, and for each positive its window of rows with another
label. Each looks first into the leaf the anchor lies in, and what is found there narrows the
annulus for all other leaves.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ._store import batches_of, ready, stored
from ._text import mix

FAN = 8
#: Levels of the tree at most, rows of which it is grown, and rows of a block and of a slice of asks.
DEPTH, SAMPLE, BLOCK, SLICE = 4, 16_384, 2048, 512
#: Squared lengths above this are left out, so that every score fits a long; below EXACT doubles are exact.
LONGEST, EXACT = 1 << 60, 1 << 53
LOW, HIGH = -(1 << 62), 1 << 62


@dataclass
class Tree:
    """Split points of each node (a path of children, as a number) with their added component."""

    splits: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]
    depth: int
    square: float  # of the length that all rows share
    width: int

    def away(self, x: np.ndarray, square: np.ndarray, extra: np.ndarray | float, node: tuple[int, int]) -> np.ndarray:
        """Distances from rows to the split points of a node."""
        points, added = self.splits[node]
        dots = x.astype(float) @ points.T + np.multiply.outer(np.broadcast_to(extra, len(x)), added)
        return np.sqrt(np.maximum(square[:, None] + self.square - 2 * dots, 0))

    def route(self, x: np.ndarray) -> Iterator[tuple[tuple[int, int], np.ndarray, np.ndarray, np.ndarray]]:
        """Level by level: node, its rows, their distances and the child each goes to."""
        extra = self.extra(x)
        square = np.full(len(x), self.square)
        path = np.zeros(len(x), np.int64)
        for level in range(self.depth):
            for code in np.unique(path):
                own = np.flatnonzero(path == code)
                away = self.away(x[own], square[own], extra[own], (level, int(code)))
                yield (level, int(code)), own, away, away.argmin(1)
                path[own] = code * FAN + away.argmin(1)

    def extra(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.square - (x.astype(float) ** 2).sum(1), 0))

    @property
    def slack(self) -> float:
        return 1e-6 * np.sqrt(self.square) + 1e-6


def grow(sample: np.ndarray, rows: int, square: float, width: int) -> Tree:
    """A tree deep enough for leaves of about a block; split points are far from one another."""
    tree = Tree({}, 1, square, width)
    while tree.depth < DEPTH and FAN**tree.depth * BLOCK < rows:
        tree.depth += 1
    rng = np.random.default_rng(13)

    def split(level: int, code: int, own: np.ndarray) -> None:
        drawn = own[rng.permutation(len(own))[: 4 * FAN]]
        extra = tree.extra(drawn)
        full = np.hstack((drawn.astype(float), extra[:, None]))
        chosen = [0]
        near = ((full - full[0]) ** 2).sum(1)
        while len(chosen) < min(FAN, len(drawn)) and near.max() > 0:
            chosen.append(int(near.argmax()))
            near = np.minimum(near, ((full - full[chosen[-1]]) ** 2).sum(1))
        tree.splits[level, code] = drawn[chosen].astype(float), extra[chosen]
        if level + 1 < tree.depth:
            away = tree.away(own, np.full(len(own), square), tree.extra(own), (level, code)).argmin(1)
            for child in range(len(chosen)):
                part = own[away == child]
                split(level + 1, code * FAN + child, part if len(part) else drawn[chosen[child : child + 1]])

    split(0, 0, sample)
    return tree


def rows_of(batch: pa.RecordBatch | pa.Table, column: str, width: int) -> np.ndarray:
    cells = batch.column(column)
    cells = cells.combine_chunks() if isinstance(cells, pa.ChunkedArray) else cells
    return cells.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def packed(x: np.ndarray) -> bytes:
    """Whole numbers as bytes, two each if they fit."""
    return x.astype("<i2" if not x.size or np.abs(x).max() < 1 << 15 else "<i8").tobytes()


def unpacked(data: bytes, n: int, width: int) -> np.ndarray:
    return np.frombuffer(data, "<i2" if len(data) == 2 * n * width else "<i8").reshape(n, width)


def whole_rows(rows: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """Rows that take part: vec_id, label (as used here), vec of whole numbers; one for each vec_id."""
    x = F.col("x")
    rows = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("x"))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & F.coalesce(fine, F.lit(False)))
    size = F.aggregate(x, F.lit(0.0), lambda s, v: s + F.pow(F.lit(256.0) * v, F.lit(2.0)))
    rows = rows.where(size < float(LONGEST)).withColumn("vec", F.transform(x, lambda v: F.floor(v * 256)))
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "vec")).alias("r")).select("vec_id", "r.label", "r.vec")


def indexed(rows: DataFrame, tree: Tree) -> tuple[DataFrame, DataFrame, dict[tuple[int, int], np.ndarray]]:
    """(rows with their leaf, blocks of the leaves, ranges of each node of the tree)."""
    width = tree.width

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = rows_of(batch, "vec", width)
            leaf, key = np.zeros(len(x), np.int64), np.zeros(len(x))
            for (_, code), own, away, child in tree.route(x):
                leaf[own], key[own] = code * FAN + child, away[np.arange(len(own)), child]
            # Rows at equal distances are told apart, so that a block of copies can be cut.
            spread = (mix(batch.column("vec_id").to_numpy().view(np.uint64)) >> np.uint64(11)).astype(float) / 2**53
            yield pa.record_batch([*batch.columns, pa.array(leaf), pa.array(key + tree.slack * spread)], [*batch.schema.names, "leaf", "key"])

    def span(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for node, _, away, child in tree.route(rows_of(batch, "vec", width)):
                m = away.shape[1]
                both = found.setdefault(node, np.stack((np.full((m, m), np.inf), np.full((m, m), -np.inf))))
                for c in np.unique(child):
                    both[0, c] = np.minimum(both[0, c], away[child == c].min(0))
                    both[1, c] = np.maximum(both[1, c], away[child == c].max(0))
        for (level, code), both in found.items():
            m = both.shape[1]
            at = np.arange(m * m)
            yield pa.record_batch([pa.array(np.full(m * m, level)), pa.array(np.full(m * m, code)), pa.array(at), pa.array(both[0].ravel()), pa.array(both[1].ravel())], ["level", "code", "at", "low", "high"])

    kept = stored(rows.mapInArrow(place, "vec_id long, label long, vec array<long>, leaf long, key double"))
    spans = kept.select("vec").mapInArrow(span, "level long, code long, at long, low double, high double")
    ranges = {node: np.stack((np.full((len(p), len(p)), np.inf), np.full((len(p), len(p)), -np.inf))) for node, (p, _) in tree.splits.items()}
    # As many rows as the tree has pairs of split points: at most FAN * FAN for each of its nodes.
    for r in spans.groupBy("level", "code", "at").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
        both = ranges[r.level, r.code]
        both[0].flat[r.at], both[1].flat[r.at] = r.low, r.high

    sizes = kept.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"), F.percentile_approx("key", [i / 64 for i in range(1, 64)], 100_000).alias("cuts"))
    # A leaf of more than 64 blocks is cut further by hash within each of its 64 shells.
    stride = F.greatest(F.lit(1.0), 64 / F.col("blocks"))
    shell = F.size(F.filter("cuts", lambda c: c < F.col("key")))
    cut = F.floor(shell / stride)
    fine = F.pmod(F.xxhash64("vec_id"), F.ceil(F.col("blocks") / 64))
    dealt = kept.join(sizes, "leaf").withColumn("cut", cut * 1_000_000 + fine)

    def pack(key: tuple, group: pa.Table) -> pa.Table:
        x = rows_of(group, "vec", width)
        leaf = key[0].as_py()
        level = tree.depth - 1
        away = tree.away(x, np.full(len(x), tree.square), tree.extra(x), (level, leaf // FAN))
        cells = [
            [f"{leaf}_{key[1].as_py()}"], [leaf], [away.min(0).tolist()], [away.max(0).tolist()],
            [group.column("vec_id").to_numpy().astype("<i8").tobytes()], [group.column("label").to_numpy().astype("<i8").tobytes()], [packed(x)],
        ]
        return pa.table(dict(zip(("block", "leaf", "low", "high", "ids", "labels", "vecs"), cells, strict=True)))

    shape = "block string, leaf long, low array<double>, high array<double>, ids binary, labels binary, vecs binary"
    blocks = stored(dealt.select("leaf", "cut", "vec_id", "label", "vec").groupBy("leaf", "cut").applyInArrow(pack, shape))
    return kept, blocks, ranges


#: What is asked: rows with (``same``) or without the anchor's label and a score from ``least`` to ``most``.
ASK = ["anchor_id", "label", "positive_id", "positive_score", "same", "least", "most", "leaf"]
ASKS = ", ".join(f"{c} long" for c in ASK)


class Asks:
    """Some asks of one slice: a number for each of ``ASK``, and the anchors' vectors."""

    def __init__(self, fields: np.ndarray, x: np.ndarray) -> None:
        self.fields, self.x = fields, x
        self.square = (x.astype(float) ** 2).sum(1)

    @classmethod
    def read(cls, fields: bytes, vecs: bytes, width: int) -> Asks:
        found = np.frombuffer(fields, "<i8").reshape(-1, len(ASK))
        return cls(found, unpacked(vecs, len(found), width))

    def write(self) -> list:
        return [self.fields.astype("<i8").tobytes(), packed(self.x)]

    def of(self, mask: np.ndarray) -> Asks:
        return Asks(self.fields[mask], self.x[mask])

    def meets(self, tree: Tree, away: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether rows at distances ``low`` to ``high`` from the split points can have a score asked for.

        ``away``: the anchors' distances from the split points.
        """
        total = self.square + tree.square
        near = np.sqrt(np.maximum(total - 2.0 * self.fields[:, 6], 0)) - tree.slack
        far = np.sqrt(np.maximum(total - 2.0 * self.fields[:, 5], 0)) + tree.slack
        closest = np.maximum(away - high, low - away).max(1)
        farthest = (away + high).min(1)
        return (closest <= far) & (farthest >= near)


def sliced(asks: DataFrame, width: int, own: bool) -> DataFrame:
    """Asks in packs of about ``SLICE``: leaf (of all in it if ``own``), fields, vecs.

    For their own leaf they are packed by it; for all others anyhow, as each ask is followed by itself.
    """

    def pack(key: tuple, group: pa.Table) -> pa.Table:
        fields = np.stack([group.column(c).to_numpy() for c in ASK], 1)
        return pa.table([[key[0].as_py()], *([c] for c in Asks(fields, rows_of(group, "vec", width)).write())], ["to", "fields", "vecs"])

    at = F.xxhash64("anchor_id")
    if own:
        many = asks.groupBy("leaf").agg(F.ceil(F.count("*") / SLICE).alias("slices"))
        dealt = asks.join(many, "leaf").withColumns({"to": F.col("leaf"), "slice": F.pmod(at, F.col("slices"))})
    else:
        dealt = asks.withColumns({"to": F.lit(-1).cast("long"), "slice": F.pmod(at, F.lit(asks.count() // SLICE + 1))})
    packs = dealt.select("to", "slice", *ASK, "vec").groupBy("to", "slice").applyInArrow(pack, "to long, fields binary, vecs binary")
    # Few bytes, much work: they are not to be put together in few tasks.
    return packs.repartition(int(asks.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def search(slices: DataFrame, blocks: DataFrame, tree: Tree, ranges: dict, take: int, own: bool) -> DataFrame:
    """For each ask up to ``take`` rows from each block that can hold some: ``ASK``, found, score.

    ``own`` looks at the leaf the anchor lies in, else at all others.
    """
    width, depth = tree.width, tree.depth

    def below(asks: Asks, level: int, code: int) -> Iterator[tuple[int, Asks]]:
        away = tree.away(asks.x, asks.square, 0.0, (level, code))
        low, high = ranges[level, code]
        for child in range(len(low)):
            if low[child, 0] > high[child, 0]:  # nothing lies there
                continue
            met = asks.meets(tree, away, low[child], high[child])
            if met.any():
                if level + 1 == depth:
                    yield code * FAN + child, asks.of(met)
                else:
                    yield from below(asks.of(met), level + 1, code * FAN + child)

    def descend(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for leaf, fields, vecs in zip(*(batch.column(c).to_pylist() for c in ("to", "fields", "vecs")), strict=True):
                asks = Asks.read(fields, vecs, width)
                for to, met in [(leaf, asks)] if own else below(asks, 0, 0):
                    met = met if own else met.of(met.fields[:, 7] != to)
                    if len(met.fields):
                        yield pa.record_batch([[to], *([c] for c in met.write())], ["leaf", "fields", "vecs"])

    def narrow(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                asks = Asks.read(row["fields"], row["vecs"], width)
                away = tree.away(asks.x, asks.square, 0.0, (depth - 1, row["leaf"] // FAN))
                met = asks.meets(tree, away, np.array(row["low"]), np.array(row["high"]))
                if met.any():
                    yield pa.record_batch([[row["block"]], *([c] for c in asks.of(met).write())], ["block", "fields", "vecs"])

    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                asks = Asks.read(row["fields"], row["vecs"], width)
                ids, labels = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8")
                x = unpacked(row["rows"], len(ids), width)
                order = np.argsort(ids, kind="stable")  # ties: the smaller id first
                ids, labels, x = ids[order], labels[order], x[order]
                kind = float if tree.square < EXACT else np.int64
                f = asks.fields
                _, first, of = np.unique(f[:, 0], return_index=True, return_inverse=True)
                scores = (asks.x[first].astype(kind) @ x.astype(kind).T).astype(np.int64)[of]
                fit = ((labels == f[:, 1:2]) == (f[:, 4:5] == 1)) & (ids != f[:, :1]) & (scores >= f[:, 5:6]) & (scores <= f[:, 6:7])
                scores[~fit] = LOW - 1
                if scores.shape[1] > take:
                    # All scores above the last one that is taken, and those equal to it by their ids.
                    limit = np.partition(scores, -take, axis=1)[:, -take][:, None]
                    fit &= scores >= limit
                a, b = np.nonzero(fit)
                order = np.lexsort((ids[b], -scores[a, b], a))
                a, b = a[order], b[order]
                nth = np.arange(len(a)) - np.searchsorted(a, a)
                a, b = a[nth < take], b[nth < take]
                yield pa.record_batch([*map(pa.array, f[a].T.copy()), pa.array(ids[b]), pa.array(scores[a, b])], [*ASK, "found", "score"])

    spark = slices.sparkSession
    with batches_of(spark, 4):
        met = slices.mapInArrow(descend, "leaf long, fields binary, vecs binary").join(blocks.select("leaf", "block", "low", "high"), "leaf")
        met = met.mapInArrow(narrow, "block string, fields binary, vecs binary")
        met = met.join(blocks.select("block", "ids", "labels", F.col("vecs").alias("rows")), "block")
        return stored(met.mapInArrow(look, f"{ASKS}, found long, score long"))


def best(found: DataFrame, take: int) -> DataFrame:
    """The first ``take`` of each ask, with their rank."""
    order = W.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "found")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= take)


def answered(asks: DataFrame, blocks: DataFrame, tree: Tree, ranges: dict, take: int) -> DataFrame:
    """The first ``take`` rows of each ask: own leaf first, then all leaves that can still matter."""
    near = search(sliced(asks, tree.width, True), blocks, tree, ranges, take, own=True)
    limit = best(near, take).groupBy("anchor_id", "positive_id").agg(F.count("*").alias("n"), F.min("score").alias("limit")).where(F.col("n") == take)
    raised = asks.join(limit.drop("n"), ["anchor_id", "positive_id"], "left").withColumn("least", F.coalesce("limit", "least"))
    rest = search(sliced(raised.select(*asks.columns), tree.width, False), blocks, tree, ranges, take, own=False)
    return best(near.unionByName(rest), take)


def mined(
    rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", every: int = 100, positives: int = 5, negatives: int = 5
) -> DataFrame:
    """Hard negatives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose vec_id ``every`` divides. Rows with a null id, label or vector, or a
    null or non-finite component, take no part, nor do vectors so long that a score would not fit
    a long. Of rows that share a vec_id the one with the least (label, vector) counts. A shorter
    vector counts as one that goes on with zeros. Anchors without a positive, and positives without
    a row in their window, give no rows; so does an empty table. Other columns are not looked at.

    The tree is grown on the driver from about ``SAMPLE`` rows and holds at most FAN ** DEPTH
    leaves; every row is in it. Larger leaves have more blocks. The search is exact.
    """
    spark = rows.sparkSession
    ready(spark, 2000)
    kept = stored(whole_rows(rows, vec_id, vector, label))
    size = F.aggregate("vec", F.lit(0.0), lambda s, v: s + v.cast("double") * v)
    n, square, width = kept.agg(F.count("*"), F.max(size), F.max(F.size("vec"))).first()
    if not n:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    width = max(width, 1)
    filled = F.concat("vec", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("vec")))
    kept = kept.withColumn("vec", filled)
    share = min(1.0, SAMPLE / n)
    drawn = kept.where(F.pmod(F.xxhash64("vec_id", F.lit("tree")), F.lit(1 << 30)) <= F.lit(share * (1 << 30))).orderBy("vec_id").select("vec").toArrow()
    sample = rows_of(drawn, "vec", width)
    tree = grow(sample if len(sample) else np.zeros((1, width), np.int64), n, float(square), width)
    kept, blocks, ranges = indexed(kept, tree)

    whole = F.lit(LOW).cast("long"), F.lit(HIGH).cast("long")
    anchors = kept.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("anchor_id"), "label", "vec", "leaf")
    none = F.lit(0).cast("long")
    first = anchors.withColumns({"positive_id": none, "positive_score": none, "same": F.lit(1).cast("long"), "least": whole[0], "most": whole[1]})
    positive = stored(answered(first, blocks, tree, ranges, positives).select("anchor_id", F.col("found").alias("positive_id"), F.col("score").alias("positive_score")))
    # 80 p <= 100 n: the least whole n; a window below zero is empty.
    score = F.col("positive_score")
    least = F.expr("(4 * positive_score + 4) div 5")
    second = anchors.join(positive.where(score >= 0), "anchor_id").withColumns({"same": none, "least": least, "most": score})
    out = answered(second, blocks, tree, ranges, negatives)
    return out.select("anchor_id", "positive_id", "rank", F.col("found").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
