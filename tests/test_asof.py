"""As-of operators against brute force, on traps and on hot cases."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from anteframe.operators import asof, history
from helpers import rows

T0 = dt.datetime(2024, 1, 10, 12)
HOUR = dt.timedelta(hours=1)
COMMON = dict(key="case", anchor_ts="at", fact_ts="ts", hours=168)


def frames(spark, anchors, facts):
    return (
        spark.createDataFrame(anchors, "case long, at timestamp"),
        spark.createDataFrame(facts, "case long, ts timestamp, dim string, value double, id long"),
    )


def brute_pairs(anchors, facts):
    return sorted(
        (c, a, f[1], f[4])
        for c, a in anchors
        for f in facts
        if f[0] == c and f[1] is not None and a - 168 * HOUR <= f[1] <= a
    )


def brute_latest(anchors, facts, dims=None):
    best = {}
    for c, a in set(anchors):
        for f in facts:
            if f[0] == c and f[1] and f[2] and a - 168 * HOUR <= f[1] <= a and (dims is None or f[2] in dims):
                k = (c, a, f[2])
                if k not in best or (f[1], f[4]) > (best[k][1], best[k][4]):
                    best[k] = f
    return sorted((c, a, d, f[3], f[1]) for (c, a, d), f in best.items())


def random_data(seed, n_cases=6, n_anchors=40, n_facts=300, days=40, hot=0.5):
    rnd = random.Random(seed)

    def case():
        return 0 if rnd.random() < hot else rnd.randrange(n_cases)

    def time():
        return T0 + dt.timedelta(minutes=rnd.randrange(days * 24 * 4) * 15)

    anchors = [(case(), time()) for _ in range(n_anchors)]
    facts = [(case(), time(), rnd.choice("abcde"), float(rnd.randrange(100)), i) for i in range(n_facts)]
    return anchors + anchors[:5], facts + [(1, None, "a", 1.0, 9001), (1, T0, None, 1.0, 9002)]


EDGE = [
    (1, T0, "a", 1.0, 1),
    (1, T0 - 168 * HOUR, "b", 2.0, 2),
    (1, T0 - 168 * HOUR - dt.timedelta(seconds=1), "c", 3.0, 3),
    (1, T0 + dt.timedelta(seconds=1), "d", 4.0, 4),
    (2, T0, "a", 5.0, 5),
]


def test_both_ends_of_the_window_count(spark):
    a, f = frames(spark, [(1, T0)], EDGE)
    got = asof.lookback_join(a, f, **COMMON).select("id")
    assert rows(got) == [(1,), (2,)]
    latest = asof.latest_per_dimension(a, f, dim="dim", value="value", **COMMON)
    assert rows(latest.select("dim", "value", "minutes_before")) == [("a", 1.0, 0.0), ("b", 2.0, 168 * 60.0)]
    assert rows(asof.lookback_counts(a, f, **COMMON)) == [(1, T0, 2)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_pairs_and_counts(spark, seed):
    anchors, facts = random_data(seed)
    a, f = frames(spark, anchors, facts)
    pairs = asof.lookback_join(a, f, **COMMON).select("case", "at", "ts", "id")
    assert rows(pairs) == sorted(brute_pairs(anchors, facts), key=repr)
    want = sorted(
        ((c, t, len([1 for p in brute_pairs([(c, t)], facts)])) for c, t in set(anchors)), key=repr
    )
    assert rows(asof.lookback_counts(a, f, **COMMON)) == want


@pytest.mark.parametrize("seed", [4, 5])
@pytest.mark.parametrize("chunk_hours", [None, 24, 168, 1000])
@pytest.mark.parametrize("dims", [None, ["a", "c", "z"]])
def test_latest(spark, seed, chunk_hours, dims):
    anchors, facts = random_data(seed)
    a, f = frames(spark, anchors, facts)
    got = asof.latest_per_dimension(
        a, f, dim="dim", value="value", tiebreak="id", dims=dims, chunk_hours=chunk_hours, **COMMON
    ).select("case", "at", "dim", "value", "ts")
    assert rows(got) == sorted(brute_latest(anchors, facts, dims), key=repr)


def test_latest_without_tiebreak_takes_the_greatest_value(spark):
    a, f = frames(spark, [(1, T0)], [(1, T0, "a", v, i) for i, v in enumerate([3.0, 9.0, 1.0])])
    got = asof.latest_per_dimension(a, f, dim="dim", value="value", **COMMON)
    assert rows(got.select("value")) == [(9.0,)]


def test_result_does_not_depend_on_order_or_partitions(spark):
    anchors, facts = random_data(7)
    results = []
    for n in (1, 3, 16):
        random.Random(n).shuffle(facts)
        a, f = frames(spark, anchors, facts)
        got = asof.latest_per_dimension(
            a.repartition(n), f.repartition(n), dim="dim", value="value", tiebreak="id", **COMMON
        )
        results.append(rows(got))
    assert results[0] == results[1] == results[2]
    assert all(ts <= at for _, at, _, _, ts, _ in results[0])


def test_one_case_holds_nearly_everything(spark):
    """200,000 facts and 20,000 anchors of one case: all pairs would be billions."""
    facts = spark.range(200_000).select(
        F.lit(1).cast("long").alias("case"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).alias("ts"),
        F.concat(F.lit("d"), (F.col("id") % 3).cast("string")).alias("dim"),
        F.col("id").cast("double").alias("value"),
        "id",
    )
    anchors = spark.range(20_000).select(
        F.lit(1).cast("long").alias("case"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 10).alias("at"),
    )
    latest = asof.latest_per_dimension(anchors, facts, dim="dim", value="value", **COMMON)
    got = latest.agg(F.count("*"), F.sum(F.unix_seconds("at") - F.unix_seconds("ts"))).first()
    # All three dimensions, 0, 1 and 2 s old; only the first anchor has just one, 0 s old.
    assert tuple(got) == (3 * 20_000 - 2, 3 * 19_999)
    counts = asof.lookback_counts(anchors, facts, **COMMON)
    assert counts.agg(F.sum("n_facts")).first()[0] == sum(10 * i + 1 for i in range(20_000))


def test_keep_known_keys(spark):
    anchors, facts = random_data(8, n_anchors=3, hot=0.0)
    a, f = frames(spark, anchors, facts)
    known = {c for c, _ in anchors}
    got = asof.keep_known_keys(f, a, key="case")
    assert rows(got) == sorted([x for x in facts if x[0] in known], key=repr)


def test_flags(spark):
    anchors = spark.createDataFrame([(1, T0), (1, T0), (2, T0), (3, T0), (4, T0)], "case long, at timestamp")
    events = spark.createDataFrame(
        [(1, T0, 1), (1, T0 - HOUR, None), (1, T0 + HOUR, 2), (2, T0, None), (3, T0 + HOUR, 1), (4, None, 1)],
        "case long, ts timestamp, g int",
    )
    got = history.history_flags(
        anchors, events, key="case", anchor_ts="at", event_ts="ts", group="g", groups=[1, 2], prefix="f"
    )
    assert got.columns == ["case", "at", "f_1", "f_2"]
    assert rows(got) == [(1, T0, True, False), (2, T0, False, False)]
    assert rows(history.pair_count(anchors, events, key="case")) == [(2 * 3 + 1 + 1 + 1,)]
    assert rows(history.pair_count(anchors, events.where("case > 9"), key="case")) == [(0,)]


def dense(spark, n=1_000_000):
    """One case and one signal, ``n`` times in a week, and an anchor a minute."""
    step = 7 * 86_400_000_000 // n
    start = 1_704_067_200_000_000
    facts = spark.range(n).select(
        F.lit(1).cast("long").alias("case"),
        F.timestamp_micros(F.lit(start) + F.col("id") * step).alias("ts"),
        F.lit("a").alias("dim"),
        F.col("id").cast("double").alias("value"),
        "id",
    )
    anchors = spark.range(7 * 1440).select(
        F.lit(1).cast("long").alias("case"),
        F.timestamp_micros(F.lit(start) + F.col("id") * 60_000_000 + step - 1).alias("at"),
    )
    return anchors, facts, step


@pytest.fixture
def many_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_dense_signal_is_many_tasks(spark, many_partitions):
    anchors, facts, step = dense(spark)
    got = asof.latest_per_dimension(anchors, facts, dim="dim", value="value", dims=["a", "b"], **COMMON)
    wrong = F.count_if(F.unix_micros("at") - F.unix_micros("ts") != F.pmod(F.unix_micros("at") - F.lit(1_704_067_200_000_000), F.lit(step)))
    got = got.withColumn("task", F.spark_partition_id())
    n, bad, tasks = got.agg(F.count("*"), wrong, F.count_distinct("task")).first()
    assert (n, bad) == (7 * 1440, 0) and tasks >= 8


def test_dense_counts_are_many_tasks(spark):
    anchors, facts, step = dense(spark)
    counts = asof.lookback_counts(anchors, facts, **COMMON)
    start = F.unix_micros("at") - F.lit(1_704_067_200_000_000)
    want = F.floor(start / step) + 1
    assert tuple(counts.agg(F.count("*"), F.count_if(F.col("n_facts") != want)).first()) == (7 * 1440, 0)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("_part" in line for line in windows)


def test_anchors_meet_only_dimensions_that_are_there(spark):
    anchors, facts = random_data(9)
    a, f = frames(spark, anchors, facts)
    dims = ["a", "c", *(f"absent {i}" for i in range(500))]
    got = asof.latest_per_dimension(a, f, dim="dim", value="value", tiebreak="id", dims=dims, **COMMON)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    # Nothing but the lists of last values is multiplied.
    made = [line for line in plan.splitlines() if "Generate" in line]
    assert made and all("sequence" in line for line in made)
    assert rows(got.select("case", "at", "dim", "value", "ts")) == sorted(brute_latest(anchors, facts, dims), key=repr)


@pytest.mark.parametrize("hours", [0, 1, 5000])
def test_other_windows(spark, hours):
    anchors, facts = random_data(10, days=3)
    a, f = frames(spark, anchors, facts)
    common = {**COMMON, "hours": hours}
    window = dt.timedelta(hours=hours)
    near = [(c, t, x) for c, t in set(anchors) for x in facts if x[0] == c and x[1] and t - window <= x[1] <= t]
    counts = {(c, t): 0 for c, t in anchors}
    best = {}
    for c, t, x in near:
        counts[c, t] += 1
        k = (c, t, x[2])
        if x[2] and (k not in best or (x[1], x[4]) > (best[k][1], best[k][4])):
            best[k] = x
    assert rows(asof.lookback_counts(a, f, **common)) == sorted(((c, t, n) for (c, t), n in counts.items()), key=repr)
    if hours:
        got = asof.latest_per_dimension(a, f, dim="dim", value="value", tiebreak="id", **common).select("case", "at", "dim", "value")
        assert rows(got) == sorted(((*k, x[3]) for k, x in best.items()), key=repr)


def test_maybe_known_keeps_all_known(spark):
    facts = spark.range(20_000).select(F.when(F.col("id") % 50 != 0, F.col("id") % 4000).alias("case"), "id")
    anchors = spark.range(0, 4000, 40).select(F.col("id").alias("case"))
    got = asof.maybe_known(facts, anchors, key="case")
    exact = facts.join(anchors, "case", "left_semi")
    assert exact.join(got, "id", "left_anti").count() == 0
    assert got.count() < exact.count() + 100
    assert asof.maybe_known(facts, anchors, key="case", bits=64).where("case IS NOT NULL").count() >= exact.count()
    assert asof.maybe_known(facts, anchors.limit(0), key="case").count() == 0
