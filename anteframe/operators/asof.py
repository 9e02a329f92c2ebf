"""Facts seen from an anchor time: look-back joins, latest values, counts.

Time is cut twice: into chunks about as long as the look-back window, and each window into
``PARTS`` parts. Every shuffle key holds one of them next to the case, so neither a case nor a
signal of a case, however dense, is one task. Facts are merged to one row per time and read once.
What a part leaves behind (its last value, its number of facts) is a short list per chunk that
gives what precedes an anchor's own part; an ordered pass through that part alone does the rest.
Work grows with facts, anchors and what is found, never with the pairs of facts and anchors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..columns import all_present, col, names
from ..functions.times import micros, minutes_between

MICROS_PER_HOUR = 3_600_000_000

#: Parts of a look-back window.
PARTS = 64

#: Bits of the filter of known cases, and bits that one case sets. With a hundred thousand known cases
#: about 3 % of the facts of others get through; no fact of a known case is lost, however many there are.
KNOWN_BITS, KNOWN_MARKS = 1 << 20, 3


def _width(hours: float) -> int:
    return int(hours * MICROS_PER_HOUR)


def _chunk(at: Column, width: int) -> Column:
    """Start of the chunk that a time in microseconds falls into."""
    return at - F.pmod(at, F.lit(width))


def _part_of(at: Column, width: int) -> Column:
    """``_chunk`` of a time that is known to be there, in a form that says so: no use of the merged
    facts adds a null check of its own, and the uses stay one and the same exchange."""
    return F.coalesce(_chunk(at, width), F.lit(0).cast("long"))


def lookback_join(
    anchors: DataFrame,
    facts: DataFrame,
    *,
    key: str | Sequence[str],
    anchor_ts: str,
    fact_ts: str,
    hours: float,
) -> DataFrame:
    """Each anchor with each fact of its case in the last ``hours``, both ends included.

    One row per pair by definition. Features and counts do not need the pairs: see
    ``latest_per_dimension`` and ``lookback_counts``.
    """
    keys, width = names(key), _width(hours)
    own = _chunk(micros(col(anchor_ts)), width)
    left = anchors.withColumn("_chunk", F.explode(F.array(own, own - width)))
    right = facts.withColumn("_chunk", _chunk(micros(col(fact_ts)), width))
    age = micros(col(anchor_ts)) - micros(col(fact_ts))
    return left.join(right, [*keys, "_chunk"]).where(age.between(0, width)).drop("_chunk")


def keep_known_keys(
    facts: DataFrame,
    anchors: DataFrame,
    *,
    key: str | Sequence[str],
    spread: int = 8,
    by: Sequence[str] | None = None,
) -> DataFrame:
    """Facts whose case occurs among the anchors.

    The few distinct cases are repeated ``spread`` times, so a hot case is met in several tasks;
    the columns ``by`` (default: all) say in which. Spark broadcasts them when they are small
    enough.
    """
    keys = names(key)
    known = (
        anchors.select(*map(col, keys))
        .distinct()
        .withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    )
    part = F.pmod(F.xxhash64(*map(col, by or facts.columns)), F.lit(spread)).cast("int")
    return facts.withColumn("_part", part).join(known, [*keys, "_part"], "left_semi").drop("_part")


def maybe_known(
    facts: DataFrame, anchors: DataFrame, *, key: str | Sequence[str], bits: int = KNOWN_BITS
) -> DataFrame:
    """``facts`` without most of those whose case does not occur among the anchors.

    A Bloom filter of ``bits`` bits, made once by one small aggregate. It is a plain condition, so
    it moves down to each source of the facts, where a join would be planned once for every source.
    Facts of a known case all stay; what else gets through is left to the join that follows.
    """
    keys = names(key)
    # A case sets its marks in one word of 64 bits, so a look at one place is enough.
    place = F.pmod(F.xxhash64(*map(col, keys)), F.lit(bits // 64)).cast("int")
    spread = F.xxhash64(*map(col, keys), F.lit(1))
    marks = F.lit(0).cast("long")
    for i in range(KNOWN_MARKS):
        shift = F.shiftright(spread, 6 * i).bitwiseAND(63).cast("int")
        marks = marks.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), shift))
    # Words without a mark are not in the list; they come in as the gaps between those that are.
    found = F.sort_array(F.collect_list(F.struct("_i", "_w")))
    none = F.struct(F.lit(-1).alias("_i"), F.lit(0).cast("long").alias("_w"))
    end = F.array(F.struct(F.lit(bits // 64).alias("_i"), F.lit(0).cast("long").alias("_w")))
    before = F.concat(F.array(none), F.col("_found"))
    filled = F.flatten(
        F.zip_with(
            before,
            F.concat(F.col("_found"), end),
            lambda a, b: F.concat(
                F.filter(F.array(a["_w"]), lambda _: a["_i"] >= 0),
                F.array_repeat(F.lit(0).cast("long"), b["_i"] - a["_i"] - 1),
            ),
        )
    )
    words = (
        anchors.select(place.alias("_i"), marks.alias("_w"))
        .groupBy("_i")
        .agg(F.bit_or("_w").alias("_w"))
        .agg(found.alias("_found"))
        .select(filled)
        .scalar()
    )
    return facts.where(F.get(words, place).bitwiseAND(marks) == marks)


def latest_per_dimension(
    anchors: DataFrame,
    facts: DataFrame,
    *,
    key: str | Sequence[str],
    anchor_ts: str,
    fact_ts: str,
    dim: str,
    value: str,
    hours: float,
    dims: Sequence | None = None,
    tiebreak: str | None = None,
    chunk_hours: float | None = None,
) -> DataFrame:
    """The newest fact per (case, anchor, dimension) in the last ``hours``, both ends included.

    Columns: keys, ``anchor_ts``, ``dim``, ``value``, ``fact_ts``, ``minutes_before``. Facts of
    one case, dimension and time: the one with the greatest ``tiebreak`` wins, without it the
    greatest value. ``dims`` restricts the dimensions. An anchor meets only dimensions that its
    case has in reach, listed or not. ``chunk_hours`` (default: twice ``hours``) is how much time
    one list of last values covers.
    """
    keys, window = names(key), _width(hours)
    width, part = _width(chunk_hours or 2 * hours), max(window // PARTS, 1)

    known = facts.where(all_present([*keys, dim, fact_ts]))
    if dims is not None:
        known = known.where(col(dim).isin(*dims))
    best = F.max_by(col(value), col(tiebreak)) if tiebreak else F.max(col(value))
    # One row per case, dimension and time: copies are merged before anything is moved.
    merged = known.groupBy(
        *map(col, keys),
        col(dim).alias("_dim"),
        _part_of(micros(col(fact_ts)), part).alias("_part"),
        col(fact_ts).alias("_ts"),
    ).agg(best.alias("_value"))

    # The last fact of each part, in lists of the parts that an anchor of the chunk can look back on.
    reached = F.sequence(
        _chunk(F.col("_part"), width), _chunk(F.col("_part") + part + window, width), F.lit(width)
    )
    lasts = (
        merged.groupBy(*map(col, keys), "_dim", "_part")
        .agg(F.max_by("_value", "_ts").alias("_value"), F.max("_ts").alias("_ts"))
        .withColumn("_chunk", F.explode(reached))
        .groupBy(*map(col, keys), "_dim", "_chunk")
        .agg(F.collect_list(F.struct("_part", "_ts", "_value")).alias("_lasts"))
    )
    points = (
        anchors.select(*map(col, keys), col(anchor_ts).alias("_anchor"))
        .where(all_present([*keys, "_anchor"]))
        .distinct()
        .withColumn("_at", micros(F.col("_anchor")))
        .withColumn("_part", _chunk(F.col("_at"), part))
    )
    before = F.array_max(F.filter("_lasts", lambda x: x["_part"] < F.col("_part")))
    own = F.exists("_lasts", lambda x: x["_part"] == F.col("_part"))
    recent = F.col("_at") - micros(F.col("_before._ts")) <= window
    probes = (
        points.withColumn("_chunk", _chunk(F.col("_at"), width))
        .join(lasts, [*keys, "_chunk"])
        .withColumns({"_before": before, "_own": own})
        .withColumn("_before", F.when(recent, F.col("_before")))
        .where(F.col("_own") | F.col("_before").isNotNull())
        .select(*map(col, keys), "_dim", "_part", "_at", "_anchor", "_before", F.lit(True).alias("_probe"))
    )
    # An inner join stays above the merging, so that both uses of the merged facts are one.
    asked = points.select(*map(col, keys), "_part").distinct()
    near = merged.join(asked, [*keys, "_part"]).withColumns(
        {"_at": micros(F.col("_ts")), "_probe": F.lit(False)}
    )
    line = near.unionByName(probes, allowMissingColumns=True)

    # At equal times facts come before the anchor, so a fact at the anchor time counts.
    upto = (
        W.partitionBy(*map(col, keys), "_dim", "_part")
        .orderBy("_at", "_probe")
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    fact = F.when(~F.col("_probe"), F.struct("_ts", "_value"))
    inside = F.last(fact, ignorenulls=True).over(upto)
    hit = F.coalesce(inside, F.struct("_before._ts", "_before._value"))
    return (
        line.withColumn("_hit", hit)
        .where(F.col("_probe") & (F.col("_at") - micros(F.col("_hit._ts")) <= window))
        .select(
            *map(col, keys),
            F.col("_anchor").alias(anchor_ts),
            F.col("_dim").alias(dim),
            F.col("_hit._value").alias(value),
            F.col("_hit._ts").alias(fact_ts),
            minutes_between(F.col("_hit._ts"), F.col("_anchor")).alias("minutes_before"),
        )
    )


def lookback_counts(
    anchors: DataFrame,
    facts: DataFrame,
    *,
    key: str | Sequence[str],
    anchor_ts: str,
    fact_ts: str,
    hours: float,
    name: str = "n_facts",
) -> DataFrame:
    """Number of facts of the case in the last ``hours`` per anchor, both ends included.

    Equals counting the rows of ``lookback_join`` per anchor, with anchors without facts at 0,
    but works on sums of three levels: whole parts of the window from the list of its chunk, and
    running counts inside the parts in which the window ends.
    """
    keys, width = names(key), _width(hours)
    part = max(width // PARTS, 1)
    chunk = max(width, 1)
    merged = (
        facts.where(all_present([*keys, fact_ts]))
        .groupBy(*map(col, keys), _part_of(micros(col(fact_ts)), part).alias("_part"), micros(col(fact_ts)).alias("_at"))
        .agg(F.count("*").alias("_n"))
    )
    reached = F.sequence(
        _chunk(F.col("_part"), chunk), _chunk(F.col("_part") + part + width, chunk), F.lit(chunk)
    )
    sums = (
        merged.groupBy(*map(col, keys), "_part")
        .agg(F.sum("_n").alias("_n"))
        .withColumn("_chunk", F.explode(reached))
        .groupBy(*map(col, keys), "_chunk")
        .agg(F.collect_list(F.struct("_part", "_n")).alias("_sums"))
    )
    end = F.col("_end")
    ends = (
        anchors.select(*map(col, keys), col(anchor_ts).alias("_anchor"))
        .where(all_present([*keys, "_anchor"]))
        .distinct()
        .withColumn("_end", micros(F.col("_anchor")))
    )
    # The start of a window is met before, its end after the facts of the same time.
    marks = F.array(
        F.struct((end - width).alias("_at"), F.lit(0).alias("_rank"), F.lit(-1).alias("_sign")),
        F.struct(end.alias("_at"), F.lit(2).alias("_rank"), F.lit(1).alias("_sign")),
    )
    points = ends.select(*map(col, keys), "_anchor", F.explode(marks).alias("_m")).select(
        *map(col, keys), "_anchor", "_m._at", "_m._rank", "_m._sign", _chunk(F.col("_m._at"), part).alias("_part")
    )
    asked = points.select(*map(col, keys), "_part").distinct()
    line = (
        merged.join(asked, [*keys, "_part"])
        .withColumn("_rank", F.lit(1))
        .unionByName(points, allowMissingColumns=True)
    )
    upto = (
        W.partitionBy(*map(col, keys), "_part")
        .orderBy("_at", "_rank")
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    seen = F.coalesce(F.sum("_n").over(upto), F.lit(0))
    edges = line.withColumn("_seen", seen).where(F.col("_rank") != 1)
    edges = edges.groupBy(*map(col, keys), "_anchor").agg(F.sum(F.col("_sign") * F.col("_seen")).alias("_edge"))
    whole = F.aggregate(
        F.filter("_sums", lambda x: (x["_part"] >= F.col("_first")) & (x["_part"] < F.col("_last"))),
        F.lit(0).cast("long"),
        lambda s, x: s + x["_n"],
    )
    return (
        edges.withColumn("_end", micros(F.col("_anchor")))
        .withColumns({"_first": _chunk(end - width, part), "_last": _chunk(end, part), "_chunk": _chunk(end, chunk)})
        .join(sums, [*keys, "_chunk"], "left")
        .select(
            *map(col, keys),
            F.col("_anchor").alias(anchor_ts),
            (F.col("_edge") + F.coalesce(whole, F.lit(0))).alias(name),
        )
    )
