"""Reports on feature coverage, timing and data quality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .. import vocab
from ..columns import all_present, col
from ..functions import codes, ranges, times
from ..functions.numbers import capped, floor_bucket, lenient_decimal, percent, reference_decimal
from ..functions.times import window_label
from ..operators.aggregate import group_counts, histogram, null_counts, row_loss, value_counts
from ..operators.features import completeness


def coverage_curve(latest: DataFrame, *, case: Sequence[str], dim: str) -> DataFrame:
    """How many cases have all of the k most frequent dimensions, for k = 1, 2, ...

    Ends with the first k that no case fulfils. Equally frequent dimensions rank by name.
    A case counts for every k up to the length of its unbroken run of ranks 1, 2, 3, ... In the
    sorted ranks of a case, rank less position is 1 exactly within that run, so one count per run
    length gives the whole curve. A case's list holds its own ranks; only the windows over the
    dimensions, which the curve lists anyway, have no partition.
    """
    pairs = latest.select(*map(col, case), col(dim).alias("_dim")).distinct()
    order = W.orderBy(F.desc("_n"), "_dim")
    ranks = pairs.where(F.col("_dim").isNotNull()).groupBy("_dim").agg(F.count("*").alias("_n"))
    ranks = ranks.select("_dim", F.row_number().over(order).alias("_r"))
    own = F.sort_array(F.collect_list("_r"))
    run = F.size(F.filter(F.transform(own, lambda r, i: r - i), lambda d: d == 1))
    # A missing dimension has no rank; a case with nothing else has a run of 0.
    runs = (
        pairs.join(ranks, "_dim", "left")
        .groupBy(*map(col, case))
        .agg(run.alias("_r"))
        .groupBy("_r")
        .agg(F.count("*").alias("_cases"))
    )
    longer = W.orderBy(F.desc("_r")).rowsBetween(W.unboundedPreceding, W.currentRow)
    # Run length 0 has no rank: it adds to all cases, but is no row of the curve.
    curve = (
        ranks.join(runs, "_r", "full")
        .withColumn("_kept", F.sum(F.coalesce("_cases", F.lit(0))).over(longer))
        .withColumn("_total", F.last("_kept").over(longer.rowsBetween(0, W.unboundedFollowing)))
        .withColumn("_before", F.lead("_kept").over(W.orderBy(F.desc("_r"))))
        .where("_r > 0 AND (_r = 1 OR _before > 0)")
    )
    kept = F.col("_kept") / F.col("_total") * 100.0
    return curve.select(
        F.col("_r").cast("long").alias("k_num_params"),
        F.col("_dim").alias("last_param_added"),
        F.col("_kept").alias("num_cases_kept"),
        kept.alias("percent_cases_kept"),
        (F.lit(100.0) - kept).alias("percent_cases_excluded"),
    )


def has_all(present: Column, wanted: Sequence[str]) -> Column:
    """Whether the array ``present`` contains every wanted value."""
    return F.size(F.array_except(F.array(*map(F.lit, wanted)), present)) == 0


def time_window_table(
    latest: DataFrame,
    *,
    case: Sequence[str],
    dim: str,
    hours_per_window: int,
    lookback_hours: int,
) -> DataFrame:
    """Rows per dimension and time window before the anchor, and the coverage of the first window.

    The windows are listed in full, whether they occur or not, up to ``lookback_hours``; the last
    one is open and holds all that is further away. A row without a time before the anchor, or
    with a time after it, raises. ``coverage`` is the first window's share of all (case, anchor) in percent.
    ``latest`` holds at most one row per case, anchor and dimension.
    """
    n = int(lookback_hours // hours_per_window)
    windows = list(range(n + 1))
    labels = [*(window_label(i, hours_per_window) for i in range(n)), f">={n * hours_per_window}h"]
    found = floor_bucket(F.col("minutes_before"), hours_per_window * 60)
    wrong = F.raise_error(F.lit("a row is in no time window")).cast("bigint")
    bucket = F.least(F.when(found >= 0, found).otherwise(wrong), F.lit(n))
    # The rows of a case are brought together unsorted; the first of them stands for the case.
    of_case = F.collect_list(F.struct(col(dim), "minutes_before"))
    rows = latest.groupBy(*map(col, case)).agg(of_case.alias("_rows"))
    rows = rows.select(F.posexplode("_rows").alias("_nth", "_row")).select((F.col("_nth") == 0).alias("_first"), "_row.*")
    table = rows.groupBy(col(dim)).agg(
        *[F.count_if(bucket == w).alias(n) for w, n in zip(windows, labels)],
        F.count_if("_first").alias("_cases"),
    )
    total = F.sum("_cases").over(W.partitionBy())
    return table.withColumn("coverage", percent(col(labels[0]), total)).drop("_cases")


def timing_stats(latest: DataFrame, *, dim: str, quartiles: bool = False) -> DataFrame:
    """Mean hours before the anchor and count per dimension, most frequent first."""
    hours = F.col("minutes_before") / 60
    spread = (
        [
            F.percentile_approx(hours, q).alias(n)
            for q, n in ((0.25, "q1_hours"), (0.5, "median_hours"), (0.75, "q3_hours"))
        ]
        if quartiles
        else []
    )
    return (
        latest.groupBy(col(dim))
        .agg(F.avg(hours).alias("mean_hours_before"), F.count(hours).alias("n"), *spread)
        .orderBy(F.desc("n"), col(dim))
    )


#: Items of a quantile sketch: ranks are off by less than 1 % of all values, as a rule by 0.1 %.
SKETCH_ITEMS = 2048


def timing_sketches(latest: DataFrame, *, dim: str, anchor_ts: str) -> DataFrame:
    """A sketch of the hours before the anchor per dimension and day of the anchor.

    One row of a few kilobytes for each (dimension, day), made with a map-side part. Sketches of
    any days can be merged, so the values need not be read again: see ``timing_quartiles``.
    """
    hours = (F.col("minutes_before") / 60).cast("double")
    return (
        latest.where(F.col("minutes_before").isNotNull())
        .groupBy(col(dim), F.to_date(col(anchor_ts)).alias("day"))
        .agg(F.count("*").alias("n"), F.kll_sketch_agg_double(hours, SKETCH_ITEMS).alias("sketch"))
    )


def timing_quartiles(sketches: DataFrame, *, dim: str, period: Column | None = None) -> DataFrame:
    """Quartiles of the hours before the anchor per dimension, and per ``period`` if given.

    ``period`` is made from the column ``day``; without it all days are merged.
    """
    by = [col(dim), *([period.alias("period")] if period is not None else [])]
    merged = sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(SKETCH_ITEMS)).alias("_s"))
    names = {"q1_hours": 0.25, "median_hours": 0.5, "q3_hours": 0.75}
    found = {n: F.kll_sketch_get_quantile_double("_s", F.lit(q)) for n, q in names.items()}
    return merged.withColumns(found).drop("_s")


def unit_inventory(df: DataFrame, *, name: str, unit: str, described_by: Sequence[str]) -> tuple:
    """(rows per full description, distinct units per name); missing parts stay as null groups."""
    per_description = group_counts(df, described_by, keep_nulls=True)
    per_name = (
        df.select(col(name), col(unit))
        .distinct()
        .where(col(name).isNotNull())
        .groupBy(col(name))
        .agg(F.count(col(unit)).alias("n_units"))
    )
    return per_description, per_name


def delays(df: DataFrame, *, start: str, end: str, cap_minutes: float = 360) -> DataFrame:
    """Rows with their delay in seconds and minutes, capped, absolute, signed flag and buckets."""
    secs = times.seconds_between(col(start), col(end))
    mins = F.col("delay_seconds") / 60.0
    return (
        df.withColumn("delay_seconds", secs)
        .withColumns(
            {
                "delay_minutes": mins,
                "delay_minutes_capped": capped(mins, cap_minutes),
                "delay_seconds_abs": F.abs("delay_seconds"),
                "end_not_before_start": F.coalesce(F.col("delay_seconds") >= 0, F.lit(False)),
                "bucket_5_min": floor_bucket(F.col("delay_seconds"), 300, 5),
                "bucket_1_h": floor_bucket(F.col("delay_seconds"), 3600, 60),
            }
        )
    )


def blood_gas_delays(gas: DataFrame, cap_minutes: float = 360) -> DataFrame:
    """Blood gas rows with the delay from sample to result; rows without one of the times are left out."""
    rows = gas.withColumns(
        {c: times.offset_timestamp(col(c)) for c in ("Probeneingangsdatum", "Ergebnisdatum")}
    )
    found = delays(rows, start="Probeneingangsdatum", end="Ergebnisdatum", cap_minutes=cap_minutes)
    return found.where(F.col("delay_seconds").isNotNull())


def blood_gas_delay_histogram(gas: DataFrame, bins: int = 100) -> DataFrame:
    return histogram(blood_gas_delays(gas), "delay_minutes_capped", bins)


def blood_gas_counts_by_year(gas: DataFrame) -> DataFrame:
    """Blood gas rows per parameter and year of the sample, or of the result where that is missing."""
    seen = F.coalesce(col("Probeneingangsdatum"), col("Ergebnisdatum"))
    return counts_by_year(gas, dim="Parameter-ID primär", ts=times.offset_timestamp(seen))


def split_by_flag(df: DataFrame, flag: str) -> tuple[DataFrame, DataFrame]:
    return df.where(col(flag)), df.where(~col(flag))


def counts_by_year(df: DataFrame, *, dim: str, ts: Column, fallback: Column | None = None) -> DataFrame:
    """Rows per dimension and year of the time (or of the fallback time); missing ones left out."""
    at = ts if fallback is None else F.coalesce(ts, fallback)
    return group_counts(df.withColumn("year", F.year(at)), [dim, "year"], keep_nulls=False)


def quarter_hour_audit(
    df: DataFrame,
    *,
    code: str,
    ts: str,
    mark: str = vocab.GLUCOSE_MARK,
    pattern: str = vocab.CLOCK_ID_PATTERN,
    collapsed: str = vocab.CLOCK_ID_COLLAPSED,
) -> DataFrame:
    """Rows of marked codes by device code and by whether the time is a full quarter hour."""
    marked = df.where(F.coalesce(col(code).contains(mark), F.lit(False))).select(
        codes.collapsed_code(col(code), pattern, collapsed).alias("paramid"),
        times.on_quarter_hour(col(ts)).alias("is_quarter"),
    )
    return group_counts(marked, ["paramid", "is_quarter"], keep_nulls=False)


def training_profile(
    table: DataFrame,
    *,
    shares_of: Sequence[str],
    nulls_in: Sequence[str],
    complete_over: Sequence[str],
) -> dict[str, DataFrame]:
    """Value shares, null counts and the loss by requiring complete rows."""
    out = {f"share_{c}": value_counts(table, c) for c in shares_of}
    out["nulls"] = null_counts(table, nulls_in)
    out["complete"] = completeness(table, complete_over)
    return out


def _cleaning_rule(name: str) -> Column:
    return all_present(["Ergebniswert_num", name]) & ranges.category_fits(
        col("Kategorie"), col("Referenzwert unten"), col("Referenzwert oben")
    )


def with_range_numbers(labs: DataFrame) -> DataFrame:
    """Result and reference bounds as numbers next to their texts."""
    return labs.withColumns(
        {
            "Ergebniswert_num": lenient_decimal(col("Ergebniswert"), drop=""),
            "Referenzwert unten_num": reference_decimal(col("Referenzwert unten")),
            "Referenzwert oben_num": reference_decimal(col("Referenzwert oben")),
        }
    )


def clean_ranges(labs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable rows, removal statistics) of labs that carry their category.

    Usable: a numeric result, a parameter name, and just the bounds that the category asks for.
    """
    numbers = with_range_numbers(labs)
    rule = _cleaning_rule("Parameterbezeichnung")
    return numbers.where(rule), row_loss(numbers, rule)
