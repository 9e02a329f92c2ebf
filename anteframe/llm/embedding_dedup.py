"""Near-duplicate vectors by tiled comparison in the order of their principal axes.

All vectors, scaled to length one, are turned so that their second moments lie along the axes, the
largest first. A product of two vectors is then mostly decided by its leading part, and the rest
is at most the product of the lengths of what remains. Tiles of vectors are compared with this
bound after ``LEAD`` and after ``MIDDLE`` axes; only pairs that can still reach the threshold go on
to the full cosine in double precision. Nothing is missed.

Vectors of a tile lie in one cell of a grid over the first ``GRID`` axes, as wide as two linked
vectors can be apart; cells that are not neighbours, and tiles whose boxes are too far apart, are
never compared. Cells with many vectors are several tiles, so tasks are of bounded size. A pair of
tiles returns how many links each vector has and a spanning forest, never its pairs. Equal vectors
are one vector with a number.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._graph import components
from ._store import batches_of, ready, stored

LEAD, MIDDLE = 16, 32
GRID = 2
#: Vectors of a tile, rows of a tile that are compared at once, and pairs that are looked at closer at once.
TILE, ROWS, CLOSER = 4096, 512, 100_000
#: More than single precision can be wrong by on unit vectors.
SLACK = 1e-4


def unit(raw: np.ndarray) -> np.ndarray:
    raw = raw.astype(np.float64)
    # Scaled first, so that very large or small vectors have a length.
    raw = raw / np.abs(raw).max(axis=1, keepdims=True)
    return raw / np.sqrt((raw * raw).sum(axis=1, keepdims=True))


def rows_of(batch: pa.RecordBatch | pa.Table, column: str, width: int) -> np.ndarray:
    cells = batch.column(column)
    if isinstance(cells, pa.ChunkedArray):
        cells = cells.combine_chunks()
    return cells.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def axes(vectors: DataFrame, width: int) -> np.ndarray:
    """Directions of the second moments of all vectors, the largest first, as columns."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            rows = unit(rows_of(batch, "vector", width))
            total += rows.T @ rows
        yield pa.record_batch([pa.array(np.arange(width * width)), pa.array(total.ravel())], ["at", "moment"])

    found = vectors.mapInArrow(run, "at long, moment double").groupBy("at").agg(F.sum("moment").alias("moment")).collect()
    moments = np.zeros(width * width)
    for r in found:
        moments[r.at] = r.moment
    return np.linalg.eigh(moments.reshape(width, width))[1][:, ::-1].copy()


def reach(threshold: float) -> float:
    """How far apart two linked vectors of length one can be."""
    return float(np.sqrt(2 - 2 * threshold)) + 1e-9


def links_of(a: np.ndarray, b: np.ndarray, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked places (in a, in b), some rows of ``a`` at a time; both turned, of length one."""

    def led(x: np.ndarray, n: int) -> np.ndarray:
        rest = np.sqrt(np.maximum((x[:, n:] ** 2).sum(axis=1, keepdims=True), 0))
        return np.hstack((x[:, :n], rest)).astype(np.float32)

    lead_a, lead_b, mid_a, mid_b = led(a, LEAD), led(b, LEAD), led(a, MIDDLE), led(b, MIDDLE)
    for i in range(0, len(a), ROWS):
        x, y = np.nonzero(lead_a[i : i + ROWS] @ lead_b[i if same else 0 :].T >= threshold - SLACK)
        x, y = x + i, y + (i if same else 0)
        if same:
            x, y = x[x < y], y[x < y]
        found = []
        for j in range(0, len(x), CLOSER):
            p, q = x[j : j + CLOSER], y[j : j + CLOSER]
            fit = np.einsum("ij,ij->i", mid_a[p], mid_b[q]) >= threshold - SLACK
            p, q = p[fit], q[fit]
            fit = np.einsum("ij,ij->i", a[p], b[q]) >= threshold
            found.append((p[fit], q[fit]))
        if found:
            yield tuple(np.concatenate(z) for z in zip(*found, strict=True))


def tiles(classes: DataFrame, width: int, turn: np.ndarray, threshold: float) -> DataFrame:
    """Tiles with their cell, their box, and ids, numbers and vectors as bytes."""
    step = reach(threshold)

    def cell(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.floor(unit(rows_of(batch, "vector", width)) @ turn[:, :GRID] / step).astype(np.int64)
            yield batch.append_column("cell", pa.array(at[:, 0] * 1000 + (at[:, 1] if at.shape[1] > 1 else 0)))

    def pack(key: tuple, group: pa.Table) -> pa.Table:
        raw = rows_of(group, "vector", width)
        turned = unit(raw) @ turn[:, : GRID + 6]
        cells = [
            [f"{key[0].as_py()}_{key[1].as_py()}"], [key[0].as_py()], [turned.min(axis=0).tolist()], [turned.max(axis=0).tolist()],
            [group.column("id").to_numpy().astype("<i8").tobytes()], [group.column("n").to_numpy().astype("<i8").tobytes()], [raw.astype("<f8").tobytes()],
        ]
        return pa.table(dict(zip(("tile", "cell", "low", "high", "ids", "ns", "raw"), cells, strict=True)))

    celled = stored(classes.mapInArrow(cell, f"id long, n long, vector {classes.schema['vector'].dataType.simpleString()}, cell long"))
    parts = celled.groupBy("cell").agg(F.ceil(F.count("*") / TILE).alias("parts"))
    dealt = celled.join(parts, "cell").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    return dealt.select("cell", "part", "id", "n", "vector").groupBy("cell", "part").applyInArrow(
        pack, "tile string, cell long, low array<double>, high array<double>, ids binary, ns binary, raw binary"
    )


def links_of_width(classes: DataFrame, width: int, threshold: float) -> DataFrame:
    """Links of the vectors of one length: a, b of a spanning forest, and the links (n) that a has."""
    spark = classes.sparkSession
    turn = axes(classes.select("vector"), width)
    tile = stored(tiles(classes, width, turn, threshold))
    far = reach(threshold)

    place = tile.select("tile", "cell", "low", "high")
    around = F.explode(F.array(*[F.lit(1000 * i + j) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    left = place.select(*[F.col(c).alias(f"a_{c}") for c in place.columns], around.alias("step")).withColumn("cell", F.col("a_cell") + F.col("step"))
    gap = F.aggregate(
        F.arrays_zip("a_low", "a_high", "low", "high"),
        F.lit(0.0),
        lambda s, d: s + F.pow(F.greatest(F.lit(0.0), d["low"] - d["a_high"], d["a_low"] - d["high"]), F.lit(2)),
    )
    pairs = left.join(place, "cell").where((F.col("a_tile") <= F.col("tile")) & (gap <= far * far)).select("a_tile", F.col("tile").alias("b_tile"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                got = {c: batch.column(c)[r].as_py() for c in batch.schema.names}
                same = got["a_tile"] == got["b_tile"]
                ids, ns, turned = [], [], []
                for side in ("a", "b"):
                    ids.append(np.frombuffer(got[f"{side}_ids"], "<i8"))
                    ns.append(np.frombuffer(got[f"{side}_ns"], "<i8"))
                    turned.append(unit(np.frombuffer(got[f"{side}_raw"], "<f8").reshape(-1, width)) @ turn)
                n = len(ids[0])
                # Places of b come after those of a, unless it is the same tile.
                shift = 0 if same else n
                all_ids = ids[0] if same else np.concatenate(ids)
                count, root = np.zeros(len(all_ids), np.int64), np.arange(len(all_ids))
                for p, q in links_of(turned[0], turned[1], threshold, same):
                    np.add.at(count, p, ns[1][q])
                    np.add.at(count, q + shift, ns[0][p])
                    order = np.argsort(p, kind="stable")
                    p, q = p[order], q[order] + shift
                    for part in np.split(np.arange(len(p)), np.flatnonzero(np.diff(p)) + 1):
                        if len(part):
                            met = np.unique(root[np.append(q[part], p[part[0]])])
                            if len(met) > 1:
                                root[np.isin(root, met)] = met[0]
                linked = np.flatnonzero(count)
                yield pa.record_batch([pa.array(all_ids[linked]), pa.array(all_ids[root[linked]]), pa.array(count[linked])], ["a", "b", "n"])

    blob = ("ids", "ns", "raw")
    for side in ("a", "b"):
        pairs = pairs.join(tile.select(F.col("tile").alias(f"{side}_tile"), *[F.col(c).alias(f"{side}_{c}") for c in blob]), f"{side}_tile")
    with batches_of(spark, 2):
        return stored(pairs.mapInArrow(run, "a long, b long, n long"))


def near_vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", threshold: float = 0.95) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Two vectors are linked if they have the same length and their cosine, in double precision, is
    at least ``threshold``; component_id is the smallest vec_id reachable by links. A vector that
    is null, empty, zero, or holds a null or non-finite component has no links and stands for
    itself. A row repeated whole counts once and is returned once; a row without vec_id has no
    links, no component and is kept. An empty table gives no rows. Other columns are not looked
    at. Each length that occurs, as a rule one, is worked on by itself. What the driver gets are
    these lengths and the second moments, width x width numbers for each.
    """
    spark = rows.sparkSession
    ready(spark, 2000)
    x = F.col("vector")
    every = stored(rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")).distinct())
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))) & F.exists(x, lambda v: v != 0)
    valid = every.where(F.col("vec_id").isNotNull() & F.coalesce(whole, F.lit(False)))
    classes = stored(valid.groupBy("vector").agg(F.min("vec_id").alias("id"), F.count("*").alias("n")).select("id", "n", "vector"))
    widths = sorted(r.width for r in classes.select(F.size("vector").alias("width")).distinct().collect())
    found = spark.createDataFrame([], "a long, b long, n long")
    for width in widths:
        found = found.unionByName(links_of_width(classes.where(F.size("vector") == width), width, threshold))
    component = components(found.where("a != b"))
    links = found.groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("links"))

    of_class = classes.join(links, "id", "left").join(component, "id", "left")
    of_class = of_class.select("vector", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("component_id", "id").alias("component"))
    of_class = of_class.withColumn("known", F.lit(True))
    out = every.join(of_class, "vector", "left")
    known = F.col("known") & F.col("vec_id").isNotNull()
    component_id = F.when(known, F.col("component")).otherwise(F.col("vec_id"))
    return out.select(
        "vec_id",
        F.when(known, F.col("links")).otherwise(0).cast("long").alias("n_links"),
        component_id.alias("component_id"),
        F.coalesce(F.col("vec_id") == component_id, F.lit(True)).alias("kept"),
    )
