"""Documents packed into sequences by bin completion.

Packing needs only how many pieces there are of each length, at most ``LENGTH`` numbers. On these
a branch-and-bound search fills one kind of sequence after the other: around the longest piece
left it lists fillings by their exact subset sums, the fullest first, leaves out those that another
one dominates, takes each as often as the pieces last, and gives a branch up when its waste rules
out a better packing than the best so far. The first packing comes from best fit, and the first
branch is the fullest filling at every step, which is never given up for want of branches. The kinds of sequences found say which pieces of a
length, by their rank, go to which sequence and place; ranks are counted in groups of bounded size,
so that a length that very many pieces share is spread over tasks.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import chain, islice
from operator import neg

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._store import stored
from ._tokens import LENGTH, token_pieces

#: Fillings followed at a branch, fillings looked at for each of them, branches in all: parameters
#: of ``complete``. They bound the search, not the pieces: every packing found holds all of them.
FILLINGS, LOOKED_AT, BRANCHES = 12, 8, 1000
#: Fillings that differ in more pieces are not compared.
COMPARED = 12
#: Pieces of one length that are ranked together, at least.
GROUP = 500

Kind = tuple[tuple[int, ...], int]


def lower_bound(counts: dict[int, int], size: int) -> int:
    """Sequences needed at least: what fills them, and pieces over half a sequence with what fits none."""
    best = -(-sum(n * c for n, c in counts.items()) // size)
    large = sorted((n for n in counts if 2 * n > size), reverse=True)
    for k in {0, *(n for n in counts if 2 * n <= size)}:
        over = sum(counts[n] for n in large if n > size - k)
        middle = [n for n in large if n <= size - k]
        held = sum(counts[n] for n in middle)
        room = sum((size - n) * counts[n] for n in middle)
        small = sum(n * c for n, c in counts.items() if k <= n and 2 * n <= size)
        best = max(best, over + held + max(0, -(-(small - room) // size)))
    # Pieces just over an even part of a sequence take as much room as the next part that fits.
    for k in range(1, 33):
        full = sum(c * n for n, c in counts.items() if (k + 1) * n % size == 0)
        parts = sum(c * ((k + 1) * n // size) for n, c in counts.items() if (k + 1) * n % size)
        best = max(best, -(-(full * k + parts * size) // (size * k)))
    return best


def fittest(counts: dict[int, int], room: int) -> list[int]:
    """Best fit: the longest piece that fits, again and again."""
    taken: Counter[int] = Counter()
    out = []
    for n in sorted(counts, reverse=True):
        while n <= room and counts[n] > taken[n]:
            taken[n] += 1
            out.append(n)
            room -= n
    return out


def subset_sums(lengths: list[int], counts: dict[int, int], room: int) -> list[int]:
    """For each place in ``lengths`` a number whose bit ``n`` says that pieces from there on can fill ``n``."""
    mask, sums = (1 << (room + 1)) - 1, [1]
    for n in reversed(lengths):
        reach, copies, step = sums[-1], min(counts[n], room // n), 1
        while copies:
            step = min(step, copies)
            reach |= reach << (n * step) & mask
            copies, step = copies - step, 2 * step
        sums.append(reach)
    return sums[::-1]


def exactly(lengths: list[int], counts: dict[int, int], sums: list[int], total: int, start: int = 0) -> Iterator[tuple[int, ...]]:
    """Fillings of just ``total``, those with the longest pieces first."""
    if not total:
        yield ()
        return
    for i in range(bisect_left(lengths, -total, start, key=neg), len(lengths)):
        if not sums[i] >> total & 1:
            return
        n = lengths[i]
        for copies in range(min(counts[n], total // n), 0, -1):
            if sums[i + 1] >> (total - copies * n) & 1:
                for rest in exactly(lengths, counts, sums, total - copies * n, i + 1):
                    yield (n,) * copies + rest


def dominates(one: tuple[int, ...], other: tuple[int, ...]) -> bool:
    """Whether the pieces of ``other`` can be placed inside those of ``one``, which so can stand for it."""
    own, rest = Counter(one), Counter(other)
    rooms = sorted((own - rest).elements())
    pieces = sorted((rest - own).elements(), reverse=True)
    if sum(pieces) > sum(rooms) or len(pieces) > COMPARED:
        return False

    def placed(i: int, rooms: tuple[int, ...]) -> bool:
        if i == len(pieces):
            return True
        fitting = {r: j for j, r in enumerate(rooms) if r >= pieces[i]}
        return any(placed(i + 1, tuple(sorted((*rooms[:j], r - pieces[i], *rooms[j + 1 :])))) for r, j in fitting.items())

    return placed(0, tuple(rooms))


def fillings(counts: dict[int, int], room: int, least: int = 0, width: int = FILLINGS) -> Iterator[tuple[int, ...]]:
    """Up to ``width`` fillings of at least ``least`` that none before dominates, the fullest first.

    A filling can dominate only those that are no fuller and, if as full, have the shorter pieces:
    those come later. So each is compared with the ones before it alone.
    """
    lengths = sorted((n for n, c in counts.items() if c and n <= room), reverse=True)
    sums = subset_sums(lengths, counts, room)
    full = (total for total in range(sums[0].bit_length() - 1, max(least, 0) - 1, -1) if sums[0] >> total & 1)
    found: list[tuple[int, ...]] = []
    for filling in islice(chain.from_iterable(exactly(lengths, counts, sums, total) for total in full), width * LOOKED_AT):
        if not any(dominates(other, filling) for other in found):
            found.append(filling)
            yield filling
            if len(found) == width:
                return


def best_fit(counts: dict[int, int], size: int) -> list[Kind]:
    """The packing that takes the longest piece left and then the longest that fit."""
    left, out = {n: c for n, c in counts.items() if c}, []
    while left:
        top = max(left)
        own = {n: c - (n == top) for n, c in left.items()}
        kind = (top, *fittest(own, size - top))
        out.append((kind, spend(left, kind)))
    return out


def spend(left: dict[int, int], kind: tuple[int, ...]) -> int:
    """Takes the pieces of as many sequences of a kind as there are."""
    need = Counter(kind)
    times = min(left[n] // k for n, k in need.items())
    for n, k in need.items():
        left[n] -= k * times
        if not left[n]:
            del left[n]
    return times


def complete(counts: dict[int, int], size: int = LENGTH, branches: int = BRANCHES, width: int = FILLINGS) -> list[Kind]:
    """Kinds of sequences, each with how many there are of it, that hold all pieces."""
    counts = {n: c for n, c in counts.items() if c}
    best = best_fit(counts, size)
    fewest, least = sum(t for _, t in best), lower_bound(counts, size)
    total = sum(n * c for n, c in counts.items())

    def branch(left: dict[int, int], waste: int) -> Iterator[tuple[int, ...]]:
        top = max(left)
        spare = (fewest - 1) * size - total - waste
        own = {n: c - (n == top) for n, c in left.items()}
        return ((top, *filling) for filling in fillings(own, size - top, size - top - spare, width))

    # What is left at each open branch, its number of sequences and waste, and its ways on; the kinds that led there.
    open_, kinds = [(counts, 0, 0, branch(counts, 0))] if counts else [], []
    tried = 0
    while open_ and fewest > least and tried < branches + len(counts):
        left, used, waste, ways = open_[-1]
        del kinds[len(open_) - 1 :]
        kind = next(ways, None)
        if kind is None:
            open_.pop()
            continue
        tried += 1
        rest = dict(left)
        times = spend(rest, kind)
        used, waste = used + times, waste + times * (size - sum(kind))
        if waste > (fewest - 1) * size - total:
            continue
        kinds.append((kind, times))
        if rest:
            open_.append((rest, used, waste, branch(rest, waste)))
        else:
            fewest, best = used, kinds[:]
    return best


def places(kinds: list[Kind]) -> list[tuple[int, int, int, int, int, int]]:
    """For each length: pieces of rank ``low`` to ``high`` go ``each`` to a sequence from ``first`` on, at ``at``."""
    out, rank, first = [], Counter(), 0
    for kind, times in kinds:
        at = 0
        for n, each in sorted(Counter(kind).items(), reverse=True):
            out.append((n, rank[n], rank[n] + each * times, each, first, at))
            rank[n] += each * times
            at += each * n
        first += times
    return out


def ranked(pieces: DataFrame, counts: dict[int, int]) -> DataFrame:
    """``rank`` of each piece among those of its length, from 0; columns length and row identify it."""
    spark = pieces.sparkSession
    groups = [(n, max(1, round(c / max(GROUP, c**0.5)))) for n, c in counts.items()]
    dealt = pieces.join(F.broadcast(spark.createDataFrame(groups, "length long, groups long")), "length")
    dealt = dealt.withColumn("group", F.pmod(F.xxhash64("row"), F.col("groups"))).drop("groups")
    within = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("length", "group").orderBy("row")) - 1)
    before = Window.partitionBy("length").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("length", "group").agg(F.count("*").alias("n"))
    offsets = offsets.select("length", "group", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return within.join(offsets, ["length", "group"]).withColumn("rank", F.col("rank") + F.col("before")).drop("group", "before")


def packed(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, files: tuple[str, str] | None = None, with_ids: bool = False
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    Pieces lie in their sequence without gaps, from offset 0. Documents longer than a sequence are
    cut, the first piece may be shorter; no other document is cut. A null text is one token, the
    end. Rows that repeat, or have no doc_id, are packed like any others. An empty table gives no
    rows. Other columns are not looked at. What the driver gets is the number of pieces of each
    length, at most ``length`` rows.
    """
    pieces = stored(token_pieces(docs, doc_id, text, length, files, with_ids).withColumn("row", F.monotonically_increasing_id()))
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = pieces.sparkSession.createDataFrame(
        places(complete(counts, length)), "of long, low long, high long, each long, first long, at long"
    )
    at_rank = ranked(pieces.select("length", "row", *(c for c in pieces.columns if c not in ("length", "row"))), counts)
    met = at_rank.join(F.broadcast(table), (F.col("length") == F.col("of")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    nth = F.col("rank") - F.col("low")
    return met.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + F.pmod(nth, F.col("each")) * F.col("length")).cast("long").alias("offset"),
        *["ids"] * with_ids,
    )
