"""Merkle manifest of a dataset: an append log of tree nodes in postorder, proofs, verification.

Each source has a tree of ``FAN`` children a node over its rows in the order of their ids, and a
tree of the same kind over the sources gives the root of all. All leaves of a tree have the same
depth, so the place of every node in the postorder of its tree follows from its level, its number
and the number of leaves alone (``place``).

Builders are aligned: each takes ``FAN ** TIER`` neighbouring nodes and writes the nodes above
them, in the order in which they are completed, to the log. The next tier starts from the tops.
A proof is read from the log by the places of the siblings, from the root's tier down: a builder's
block is read once for all its leaves, together with the way from its top to the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ._sample import held_out
from ._store import ready, stored

FAN = 16
#: Levels of a builder: a block has at most FAN ** TIER nodes at its lowest level.
TIER = 3
BLOCK = FAN**TIER
#: Rows of a range when rows are numbered.
RANGE = 500_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LOG = "tree long, leaves long, level int, number long, at long, digest string"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def height(leaves: int) -> int:
    """Levels above the leaves; a lone leaf is the root."""
    level = 0
    while leaves > 1:
        leaves, level = -(-leaves // FAN), level + 1
    return level


def place(level: int, number: int | np.ndarray, leaves: int) -> int | np.ndarray:
    """Place from 0 of a node in the postorder of a tree with ``leaves`` leaves.

    Complete by then are, of its own and the lower levels, all nodes up to its last descendant, and
    of each higher level the nodes whose last descendant comes before it.
    """
    total = -1
    for k in range(height(leaves) + 1):
        if k <= level:
            total = total + np.minimum((number + 1) * FAN ** (level - k), -(-leaves // FAN**k))
        else:
            total = total + number // FAN ** (k - level)
    return total


def part_of(value: Column) -> Column:
    """``-`` for null, else the number of bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return F.sha2(F.concat(*map(part_of, (doc_id, source, lang, n_chars, text))), 256)


def numbered(rows: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``rows`` with ``number``, from 0 in each group by ``order``, and ``leaves``, the group's size.

    Ranges of rows are numbered by themselves and start where those before them end, so a group may
    hold all rows. ``rows`` must be a stored table and ``order`` tell its rows apart.
    """
    spark = rows.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.count() // RANGE + 1)
    keys = [*group, *order]
    ranged = stored(rows.repartitionByRange(ranges, *keys).withColumn("_range", F.spark_partition_id()))
    sizes = ranged.groupBy(*group, "_range").agg(F.count("*").alias("_n"))
    own = W.partitionBy(*group)
    before = F.sum("_n").over(own.orderBy("_range").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("_n")
    sizes = sizes.select(*group, "_range", before.alias("_before"), F.sum("_n").over(own).alias("leaves"))
    nth = F.row_number().over(W.partitionBy(*group, "_range").orderBy(*order)) - 1
    found = ranged.withColumn("_nth", nth).join(sizes, [*group, "_range"])
    return found.withColumn("number", F.col("_nth") + F.col("_before")).drop("_range", "_nth", "_before")


def _completed(tree: int, leaves: int, tier: int, block: int, digests: list[str]) -> Iterator[tuple]:
    """The nodes of a block in the order in which they are complete: (level, number, digest)."""
    base = tier * TIER
    top = min(base + TIER, height(leaves))
    open_: list[list[str]] = [[] for _ in range(top - base + 1)]
    first = block * BLOCK
    done = [first // FAN**k for k in range(top - base + 1)]

    def add(k: int, digest: str) -> Iterator[tuple]:
        yield base + k, done[k], digest
        done[k] += 1
        open_[k].append(digest)
        if k < top - base and len(open_[k]) == FAN:
            yield from close(k)

    def close(k: int) -> Iterator[tuple]:
        digest = sha("".join(open_[k]))
        open_[k].clear()
        yield from add(k + 1, digest)

    for digest in digests:
        yield from add(0, digest)
    for k in range(top - base):
        if open_[k]:
            yield from close(k)


def grown(lowest: DataFrame, tier: int) -> DataFrame:
    """Log of the nodes above ``lowest`` (tree, leaves, number, digest), which are written too at tier 0."""

    def build(key: tuple, group: pa.Table) -> pa.Table:
        tree, block = key[0].as_py(), key[1].as_py()
        group = group.sort_by("number")
        leaves = group.column("leaves")[0].as_py()
        nodes = list(_completed(tree, leaves, tier, block, group.column("digest").to_pylist()))
        if tier:
            nodes = [n for n in nodes if n[0] > tier * TIER]
        level = np.array([n[0] for n in nodes], np.int32)
        number = np.array([n[1] for n in nodes], np.int64)
        at = np.zeros(len(nodes), np.int64)
        for k in np.unique(level):
            at[level == k] = place(int(k), number[level == k], leaves)
        same = [np.full(len(nodes), x, np.int64) for x in (tree, leaves)]
        return pa.table([*map(pa.array, (*same, level, number, at)), pa.array([n[2] for n in nodes], pa.string())], ["tree", "leaves", "level", "number", "at", "digest"])

    block = F.floor(F.col("number") / BLOCK).alias("block")
    return lowest.select("tree", block, "leaves", "number", "digest").groupBy("tree", "block").applyInArrow(build, LOG)


def log_of(leaves: DataFrame) -> list[DataFrame]:
    """The log of trees over ``leaves`` (tree, leaves, number, digest), one stored table for each tier."""
    tiers = [stored(grown(leaves, 0))]
    while True:
        level = TIER * len(tiers)
        tops = tiers[-1].where((F.col("level") == level) & (F.col("leaves") > FAN**level))
        if tops.isEmpty():
            return tiers
        tiers.append(stored(grown(tops.select("tree", "leaves", "number", "digest"), len(tiers))))


def roots(tiers: list[DataFrame]) -> DataFrame:
    """(tree, digest) of each tree's root: the last node of its log."""
    found = None
    for tier in tiers:
        rows = tier.where(F.col("number") == 0).groupBy("tree").agg(F.max_by("digest", "level").alias("digest"), F.max("level").alias("level"))
        found = rows if found is None else found.unionByName(rows)
    return found.groupBy("tree").agg(F.max_by("digest", "level").alias("digest"))


PATH = "path array<struct<left: string, right: string>>"
_STEP = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


class Block:
    """A block of the log with the way from its top to the root; siblings are found by their places."""

    def __init__(self, tier: int, block: int, log: pa.Table) -> None:
        is_way = np.asarray(log.column("at").to_numpy() < 0)
        way = log.filter(pa.array(is_way))
        nodes = log.filter(pa.array(~is_way)).sort_by("at")
        self.leaves = nodes.column("leaves")[0].as_py()
        self.at, self.digest = nodes.column("at").to_numpy(), nodes.column("digest").to_pylist()
        self.way = [(s["left"], s["right"]) for s in way.column("path")[0].as_py()]
        self.subroot = way.column("digest")[0].as_py()
        self.base = tier * TIER
        self.top = min(self.base + TIER, height(self.leaves))
        self.runs: dict[tuple[int, int], list[str]] = {}

    def run(self, level: int, run: int) -> list[str]:
        """The digests of the nodes that share a parent, left to right."""
        if (level, run) not in self.runs:
            many = -(-self.leaves // FAN**level)
            at = place(level, np.arange(run * FAN, min(run * FAN + FAN, many)), self.leaves)
            self.runs[level, run] = [self.digest[i] for i in np.searchsorted(self.at, at)]
        return self.runs[level, run]

    def path(self, number: int) -> list[tuple[str, str]]:
        """What stands left and right of the way from a node of the lowest level to the root."""
        found = []
        for level in range(self.base, self.top):
            run, nth = divmod(number, FAN)
            own = self.run(level, run)
            found.append(("".join(own[:nth]), "".join(own[nth + 1 :])))
            number = run
        return found + self.way


def _blocks(tier: DataFrame, lower: DataFrame | None, ways: DataFrame, number: int) -> DataFrame:
    """The log of a tier by builder's block, each with a row for its way (at -1, subroot as digest)."""
    base = number * TIER
    rows = tier if lower is None else tier.unionByName(lower.where((F.col("level") == base) & (F.col("leaves") > FAN**base)))
    rows = rows.where(F.col("level") < base + TIER)
    shift = F.element_at(F.array(*[F.lit(BLOCK // FAN**k) for k in range(TIER)]), (F.col("level") - base + 1).cast("int"))
    rows = rows.select("tree", F.floor(F.col("number") / shift).alias("block"), "leaves", "at", "digest", F.lit(None).cast(PATH.split(" ", 1)[1]).alias("path"))
    ways = ways.select("tree", "block", F.lit(0).cast("long").alias("leaves"), F.lit(-1).cast("long").alias("at"), F.col("subroot").alias("digest"), "path")
    return rows.unionByName(ways)


def _ways(tier: DataFrame, lower: DataFrame | None, ways: DataFrame, number: int) -> DataFrame:
    """The way to the root of each lowest node of a tier: tree, block (its number), subroot, path."""

    def run(key: tuple, log: pa.Table) -> pa.Table:
        block = Block(number, key[1].as_py(), log)
        first = key[1].as_py() * BLOCK
        many = min(-(-block.leaves // FAN**block.base) - first, BLOCK)
        numbers = np.arange(first, first + many)
        paths = [[{"left": a, "right": b} for a, b in block.path(int(n))] for n in numbers]
        return pa.table([pa.array(np.full(many, key[0].as_py())), pa.array(numbers), pa.array([block.subroot] * many), pa.array(paths, _STEP)], ["tree", "block", "subroot", "path"])

    return _blocks(tier, lower, ways, number).groupBy("tree", "block").applyInArrow(run, f"tree long, block long, subroot string, {PATH}")


def down(tiers: list[DataFrame], ways: DataFrame) -> DataFrame:
    """The ways of tier 0's blocks, from ``ways`` (tree, subroot, path) of the roots of all trees.

    A tree joins in at its highest tier, whose one block ends at its root.
    """
    sizes = tiers[0].where(F.col("level") == 0).groupBy("tree").agg(F.first("leaves").alias("leaves"))
    found = None
    for number in range(len(tiers) - 1, 0, -1):
        low, high = FAN ** (number * TIER), FAN ** ((number + 1) * TIER)
        here = sizes.where((F.col("leaves") > low) & (F.col("leaves") <= high)).join(ways, "tree")
        here = here.select("tree", F.lit(0).cast("long").alias("block"), "subroot", "path")
        here = here if found is None else here.unionByName(found)
        found = stored(_ways(tiers[number], tiers[number - 1], here, number))
    here = sizes.where(F.col("leaves") <= BLOCK).join(ways, "tree").select("tree", F.lit(0).cast("long").alias("block"), "subroot", "path")
    return here if found is None else here.unionByName(found)


PROOFS = "doc_id {}, leaf string, subroot string, proof_sha256 string, folded_root string"


def proven(rows: DataFrame, tier: DataFrame, ways: DataFrame) -> DataFrame:
    """For each of ``rows`` (tree, number, doc_id, digest, changed): what its proof gives.

    ``changed`` is the leaf that is verified, the digest itself where null.
    """

    def run(key: tuple, own: pa.Table, log: pa.Table) -> pa.Table:
        if not own.num_rows:
            return pa.table({"doc_id": own.column("doc_id"), **{c: pa.array([], pa.string()) for c in ("leaf", "subroot", "proof_sha256", "folded_root")}})
        block = Block(0, key[1].as_py(), log)
        proofs, folded = [], []
        for number, digest, changed in zip(*(own.column(c).to_pylist() for c in ("number", "digest", "changed")), strict=True):
            path = block.path(number)
            proofs.append(sha("".join(x for step in path for x in step)))
            node = changed or digest
            for left, right in path:
                node = sha(left + node + right)
            folded.append(node)
        texts = [own.column("digest").combine_chunks(), [block.subroot] * own.num_rows, proofs, folded]
        return pa.table([own.column("doc_id"), *(pa.array(t, pa.string()) for t in texts)], ["doc_id", "leaf", "subroot", "proof_sha256", "folded_root"])

    block = F.floor(F.col("number") / BLOCK).alias("block")
    left = rows.select("tree", block, "number", "doc_id", "digest", "changed").groupBy("tree", "block")
    right = _blocks(tier, None, ways, 0).groupBy("tree", "block")
    return left.cogroup(right).applyInArrow(run, PROOFS.format(rows.schema["doc_id"].dataType.simpleString()))


def tampered(doc_id: Column) -> Column:
    """Rows whose text is altered before it is verified; a null id is none of them."""
    return doc_id.isNotNull() & held_out(doc_id)


def manifest(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Columns looked at: doc_id (a whole number), source, lang, n_chars, text. A null source is a
    source of its own and comes first. Rows of one source with equal ids (null ids come first) are
    leaves in the order of their digests, so repeated rows are leaves as often as they come. An
    empty table has no root and gives no rows. Other columns, whatever their names, are not looked
    at.

    The driver gets the digest of the root and two numbers of rows. Texts are hashed where they are
    read and never move.
    """
    spark = docs.sparkSession
    ready(spark)
    doc_id, source, lang, n_chars, text = map(F.col, ("doc_id", "source", "lang", "n_chars", "text"))
    changed = F.when(tampered(doc_id), leaf(doc_id, source, lang, n_chars, F.translate(text, UPPER, LOWER)))
    hashed = docs.select(
        "doc_id", source.isNotNull().alias("named"), F.coalesce(source, F.lit("")).alias("name"),
        leaf(doc_id, source, lang, n_chars, text).alias("digest"), changed.alias("changed"),
    )
    # The last column tells rows apart that are the same in all others.
    hashed = stored(hashed.withColumn("row", F.monotonically_increasing_id()))
    group = ["named", "name"]
    trees = stored(numbered(stored(hashed.select(*group).distinct()), [], group).select(*group, F.col("number").alias("tree"), F.col("leaves").alias("sources")))
    rows = stored(numbered(hashed, group, ["doc_id", "digest", "row"]).join(trees.drop("sources"), group).drop(*group, "row"))

    tiers = log_of(rows.select("tree", "leaves", "number", "digest"))
    subroots = stored(roots(tiers))
    # The tree over the sources is built and read like all others; its leaves are the subroots.
    above = subroots.join(trees, "tree").select(
        F.lit(0).cast("long").alias("tree"), F.col("sources").alias("leaves"), F.col("tree").alias("number"), "digest"
    )
    top = log_of(above)
    root = roots(top).select("digest").first()
    if root is None:
        return _verified(spark.createDataFrame([], PROOFS.format(docs.schema["doc_id"].dataType.simpleString())), "")
    start = spark.createDataFrame([(0, "", [])], f"tree long, subroot string, {PATH}")
    to_root = _ways(top[0], None, down(top, start), 0).select(F.col("block").alias("tree"), "path")
    ways = stored(down(tiers, subroots.withColumnRenamed("digest", "subroot").join(to_root, "tree")))
    return _verified(proven(rows, tiers[0], ways), root.digest)


def _verified(rows: DataFrame, root: str) -> DataFrame:
    at = rows.withColumns({"root": F.lit(root), "verified": F.col("folded_root") == root})
    return at.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
