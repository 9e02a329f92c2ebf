import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from anteframe.operators import aggregate, dedup, features, joins, prefix, sets
from anteframe.plans import profiles
from helpers import rows


def greedy_prefix(code, rules):
    if code is None:
        return None
    for p in sorted(rules, key=len, reverse=True):
        if code.startswith(p):
            return rules[p]
    return None


def prefixes(spark, codes, rules):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "i int, code string")
    mapping = spark.createDataFrame(rules, "p string, g int")
    got = prefix.longest_prefix_group(df, mapping, code="code", prefix="p", group="g", out="g")
    return [r["g"] for r in got.orderBy("i").collect()]


def test_longest_prefix(spark):
    rules = [("C91", 1), ("C91.10", 2), ("E11", 3)]
    assert prefixes(spark, ["E11.90", "C91.10", "C64", None, "C91.1", ""], rules) == [3, 2, None, None, 1, None]
    assert prefixes(spark, ["ab"], [("a", 5), ("a", 4)]) == [4]


def test_longest_prefix_against_greedy(spark):
    rnd = random.Random(3)

    def code(n):
        return "".join(rnd.choice("AB1.") for _ in range(n))

    rules = {code(rnd.randrange(1, 5)): i for i in range(30)}
    codes = [code(rnd.randrange(0, 8)) for _ in range(500)]
    assert prefixes(spark, codes, list(rules.items())) == [greedy_prefix(c, rules) for c in codes]


def test_single_or_null(spark):
    df = spark.createDataFrame(
        [(1, "a", "08:00"), (1, "a", None), (2, "a", "09:00"), (3, "b", "10:00"), (3, "b", "11:00"), (4, "c", None),
         (None, "d", "12:00")],
        "case int, day string, t string",
    )
    got = aggregate.single_or_null(df, ["case", "day"], "t")
    assert rows(got.select("case", "day", "t")) == [(1, "a", None), (2, "a", "09:00"), (None, "d", "12:00")]


def test_null_equal_join(spark):
    a = spark.createDataFrame([("x", 1), (None, 2), ("y", 3)], "k string, a int")
    b = spark.createDataFrame([("x", 10), (None, 20)], "k string, b int")
    assert rows(joins.null_safe_join(a, b, on="k")) == [("x", 1, 10), (None, 2, 20)]
    left = joins.null_safe_join(a, b, on=["k"], how="left")
    assert rows(left) == [("x", 1, 10), ("y", 3, None), (None, 2, 20)]


def test_group_size_and_singletons(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (3, None)], "k int, v string")
    assert rows(joins.with_group_size(df, ["k"])) == [(1, "a", 2), (1, "b", 2), (2, "c", 1), (3, None, 1), (None, "d", 1)]
    assert rows(dedup.keep_singletons(df, ["k"])) == [(2, "c"), (3, None), (None, "d")]


def test_latest_version(spark):
    df = spark.createDataFrame(
        [(1, None, 1), (1, 5, 2), (1, 7, 3), (1, 7, 4), (None, 1, 5), (None, 2, 6)], "k int, d int, no int"
    )
    got = dedup.latest_version(df, ["k"], [F.desc_nulls_last("d"), F.desc("no")])
    assert rows(got) == [(1, 7, 4), (None, 2, 6)]


def test_uniqueness(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a")], "k int, v string")
    assert rows(dedup.uniqueness_violations(df, ["k", "v"])) == [(1, "a", 2)]
    with pytest.raises(ValueError, match="not unique"):
        dedup.assert_unique(df, ["k"])
    assert dedup.assert_unique(df.distinct(), ["k"]).count() == 2


def test_pivot_has_all_listed_columns(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "x", 9.0), (2, "a", None)], "k int, d string, v double")
    wide = features.pivot_values(df, index="k", dim="d", value="v", values=["a", "b", "c"])
    assert wide.columns == ["k", "a", "b", "c"]
    assert rows(wide) == [(1, 1.0, 2.0, None), (2, None, None, None)]
    assert rows(features.complete_cases(wide, ["a", "b"])) == [(1, 1.0, 2.0, None)]
    assert rows(features.completeness(wide, ["a", "b"])) == [(2, 1, 1, 50.0)]
    twice = df.union(spark.createDataFrame([(1, "a", 4.0)], df.schema))
    means = features.pivot_values(twice, index="k", dim="d", value="v", values=["a"], how="mean")
    assert rows(means) == [(1, 2.5), (2, None)]
    counts = features.pivot_counts(df, index="k", dim="d", values=["a", "b"])
    assert rows(counts) == [(1, 1, 1), (2, 1, 0)]


def test_attach(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    f = spark.createDataFrame([(1, True)], "k int, f boolean")
    assert rows(joins.attach(a, f, on="k", keep_unmatched=False)) == [(1, "x", True)]
    kept = joins.attach(a, f, on="k", keep_unmatched=True, fill_false=["f"])
    assert rows(kept) == [(1, "x", True), (2, "y", False)]


def test_union_with_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(2, "y")], "k int, b string")
    assert rows(sets.union_all(a, b, fill_missing=True)) == [(1, "x", None), (2, None, "y")]
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN|Cannot resolve"):
        sets.union_all(a, b)


def test_counts_with_and_without_nulls(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 1), ("b", None)], "k string, v int")
    assert rows(aggregate.group_counts(df, ["k"], keep_nulls=True)) == [("a", 2), ("b", 1), (None, 1)]
    assert rows(aggregate.group_counts(df, ["k"], keep_nulls=False)) == [("a", 2), ("b", 1)]
    assert rows(aggregate.distinct_counts(df, ["k"], "v", "n")) == [("a", 1), ("b", 0), (None, 1)]
    assert rows(aggregate.distinct_counts(df, [], "v", "n")) == [(1,)]
    assert rows(aggregate.value_counts(df, "k")) == [("a", 2, 0.5), ("b", 1, 0.25), (None, 1, 0.25)]
    assert rows(aggregate.null_counts(df, ["k", "v"])) == [("k", 1, 4), ("v", 1, 4)]
    assert rows(aggregate.row_loss(df, F.col("v") == 1)) == [(4, 3, 1, 75.0)]
    per_description, per_name = profiles.unit_inventory(df, name="k", unit="v", described_by=["k", "v"])
    assert rows(per_description) == [("a", 1, 2), ("b", None, 1), (None, 1, 1)]
    assert rows(per_name) == [("a", 1), ("b", 0)]


@pytest.mark.parametrize("seed", range(4))
def test_histogram_equals_numpy(spark, seed):
    rnd = np.random.default_rng(seed)
    v = [float(x) for x in rnd.integers(-2000, 9000, 3000) / (1 if seed % 2 else 60)]
    df = spark.createDataFrame([(x,) for x in v] + [(None,)], "v double")
    got = aggregate.histogram(df, "v").orderBy("bin").collect()
    n, edges = np.histogram(v, bins=100)
    assert [r["n"] for r in got] == list(n)
    assert [r["lower"] for r in got] == pytest.approx(list(edges[:-1]))
    assert [r["upper"] for r in got] == pytest.approx(list(edges[1:]))


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(7.0,), (7.0,)], "v double")
    got = aggregate.histogram(df, "v", bins=4).orderBy("bin").collect()
    assert [r["n"] for r in got] == list(np.histogram([7.0, 7.0], bins=4)[0])


def share_with_first(cases, k):
    """(k, dimension of rank k, cases that hold the first k, shares in percent), from the definition."""
    sizes = Counter(d for s in cases.values() for d in s)
    first = sorted(sizes, key=lambda d: (-sizes[d], d))[:k]
    kept = [c for c, s in cases.items() if set(first).issubset(s)]
    share = 100.0 * len(kept) / len(cases)
    return k, first[-1], len(kept), pytest.approx(share), pytest.approx(100.0 - share)


@pytest.mark.parametrize("seed", range(5))
def test_coverage_curve(spark, seed):
    rnd = random.Random(seed)
    dims = [f"d{i}" for i in range(9)]
    cases = {}
    for c in range(200):
        s = {d for i, d in enumerate(dims) if rnd.random() < (0.99 - 0.07 * i if seed else 0.2)}
        if s:
            cases[c] = s
    df = spark.createDataFrame([(c, d) for c, s in cases.items() for d in s], "case int, dim string")
    got = profiles.coverage_curve(df, case=["case"], dim="dim").orderBy("k_num_params")
    want = [share_with_first(cases, k) for k in range(1, 1 + len(set().union(*cases.values())))]
    # Nothing follows the first k that no case fulfils.
    stop = next((i for i, w in enumerate(want) if w[2] == 0), len(want) - 1)
    assert [tuple(r) for r in got.collect()] == want[: stop + 1]


def test_subset_test(spark):
    df = spark.createDataFrame([(["a", "b"],), (["a"],), ([],)], "s array<string>")
    got = [r[0] for r in df.select(profiles.has_all(F.col("s"), ["a", "b"])).collect()]
    assert got == [True, False, False]


def test_time_windows_and_timing(spark):
    df = spark.createDataFrame(
        [(1, "a", 0.0), (1, "b", 1440.0), (2, "a", 10080.0), (3, "a", 1439.9)], "case int, dim string, minutes_before double"
    )
    table = profiles.time_window_table(df, case=["case"], dim="dim", hours_per_window=24, lookback_hours=168).orderBy("dim")
    assert table.columns == ["dim", *[f"{24 * i}-{24 * (i + 1)}h" for i in range(7)], ">=168h", "coverage"]
    far = profiles.time_window_table(df, case=["case"], dim="dim", hours_per_window=24, lookback_hours=24).orderBy("dim")
    assert [tuple(r) for r in far.collect()] == [("a", 2, 1, 66.7), ("b", 0, 1, 0.0)]
    late = df.withColumn("minutes_before", F.lit(-1.0))
    with pytest.raises(Exception, match="no time window"):
        profiles.time_window_table(late, case=["case"], dim="dim", hours_per_window=24, lookback_hours=24).collect()
    assert [tuple(r) for r in table.collect()] == [("a", 2, 0, 0, 0, 0, 0, 0, 1, 66.7), ("b", 0, 1, 0, 0, 0, 0, 0, 0, 0.0)]
    stats = profiles.timing_stats(df, dim="dim", quartiles=True).collect()
    assert [r["dim"] for r in stats] == ["a", "b"] and stats[1]["median_hours"] == 24.0


def test_training_profile(spark):
    df = spark.createDataFrame([(1, "W", None), (0, "M", 1.0), (1, None, 2.0)], "y int, s string, v double")
    out = profiles.training_profile(df, shares_of=["y", "s"], nulls_in=["v"], complete_over=["s", "v"])
    assert rows(out["share_y"].select("y", "n")) == [(0, 1), (1, 2)]
    assert rows(out["nulls"]) == [("v", 1, 3)]
    assert rows(out["complete"]) == [(3, 1, 2, 33.3)]


def test_quarter_hours_and_years(spark):
    df = spark.sql(
        """SELECT * FROM VALUES ('O-GLU_Z.0045', timestamp'2020-01-01 00:45:00'), ('O-GLU_Z.0046', timestamp'2020-01-01 00:46:00'),
           ('GLU_S', timestamp'2021-01-01 00:30:00'), ('K_S', timestamp'2021-01-01 00:30:00'), (NULL, NULL) AS t(code, at)"""
    )
    audit = profiles.quarter_hour_audit(df, code="code", ts="at")
    assert rows(audit) == [("GLU_S", True, 1), ("O-GLU_Z.x", False, 1), ("O-GLU_Z.x", True, 1)]
    years = profiles.counts_by_year(df, dim="code", ts=F.col("at"))
    assert (None, None, 1) not in rows(years) and len(rows(years)) == 4


def test_coverage_curve_of_many_dimensions(spark):
    """100,000 dimensions: case i has the first of them up to a length of its own."""
    lengths = {1: 100_000, 2: 60_000, 3: 10, 4: 0}
    parts = [spark.range(n).select(F.lit(c).alias("case"), F.format_string("d%06d", "id").alias("dim")) for c, n in lengths.items()]
    parts.append(spark.createDataFrame([(4, "d000001")], "case int, dim string"))
    df = parts[0]
    for part in parts[1:]:
        df = df.unionByName(part)
    got = profiles.coverage_curve(df, case=["case"], dim="dim")
    # Case 4 lifts the second dimension to the first rank and stays for it alone.
    kept = {1: 4, 2: 3, 10: 3, 11: 2, 60_000: 2, 60_001: 1, 100_000: 1}
    found = {r["k_num_params"]: r["num_cases_kept"] for r in got.where(F.col("k_num_params").isin(*kept)).collect()}
    assert found == kept and got.count() == 100_000


def test_quartiles_of_merged_sketches(spark):
    rng = np.random.default_rng(3)
    hours = np.concatenate((rng.gamma(2, 20, 60_000), np.full(20_000, 5.0)))
    days = rng.integers(0, 40, len(hours))
    pdf = pd.DataFrame({"dim": "a", "at": pd.Timestamp("2024-01-01") + pd.to_timedelta(days, "D"), "minutes_before": hours * 60})
    rows = spark.createDataFrame(pdf).unionByName(spark.createDataFrame([("b", None, None)], "dim string, at timestamp, minutes_before double"))
    sketches = profiles.timing_sketches(rows, dim="dim", anchor_ts="at")
    assert sketches.count() == 40
    got = profiles.timing_quartiles(sketches, dim="dim").collect()
    assert [(r["dim"], r["n"]) for r in got] == [("a", len(hours))]
    for name, q in (("q1_hours", 0.25), ("median_hours", 0.5), ("q3_hours", 0.75)):
        assert (hours < got[0][name] - 1e-9).mean() <= q + 0.01 and (hours <= got[0][name] + 1e-9).mean() >= q - 0.01
    weeks = profiles.timing_quartiles(sketches, dim="dim", period=F.weekofyear("day")).collect()
    assert sum(r["n"] for r in weeks) == len(hours) and all(r["q1_hours"] <= r["median_hours"] <= r["q3_hours"] for r in weeks)
