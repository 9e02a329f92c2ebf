"""Counts, shares, distributions and delays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anteframe.functions import codes
from anteframe.operators import aggregate
from anteframe.operators.features import completeness, pivot_counts
from anteframe.plans import profiles

from .registry import Tables, query


def events_with_gaps(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id",
        "user_id",
        codes.blank_sentinel(F.col("event_type"), "error").alias("kind"),
        F.when(F.col("value") < 100, F.col("value")).alias("value"),
    )


GAPS_SQL = """WITH g AS (SELECT event_id, user_id, nullif(event_type, 'error') AS kind,
                CASE WHEN value < 100 THEN value END AS value FROM events)"""


@query(f"{GAPS_SQL} SELECT kind, user_id, count(*) AS n FROM g GROUP BY ALL")
def group_counts_with_nulls(t: Tables) -> DataFrame:
    return aggregate.group_counts(events_with_gaps(t), ["kind", "user_id"], keep_nulls=True)


@query(f"{GAPS_SQL} SELECT kind, user_id, count(*) AS n FROM g WHERE kind IS NOT NULL GROUP BY ALL")
def group_counts_without_nulls(t: Tables) -> DataFrame:
    return aggregate.group_counts(events_with_gaps(t), ["kind", "user_id"], keep_nulls=False)


@query(f"{GAPS_SQL} SELECT user_id, count(DISTINCT kind) AS n_kinds FROM g GROUP BY user_id")
def distinct_counts(t: Tables) -> DataFrame:
    return aggregate.distinct_counts(events_with_gaps(t), ["user_id"], "kind", "n_kinds")


@query(f"{GAPS_SQL} SELECT count(DISTINCT kind) AS n_kinds FROM g")
def distinct_count_overall(t: Tables) -> DataFrame:
    return aggregate.distinct_counts(events_with_gaps(t), [], "kind", "n_kinds")


@query("""
SELECT o_orderpriority, count(*) AS n, count(*)::DOUBLE / sum(count(*)) OVER () AS share
FROM orders GROUP BY o_orderpriority""")
def value_counts_normalised(t: Tables) -> DataFrame:
    return aggregate.value_counts(t.orders, "o_orderpriority")


@query(f"{GAPS_SQL} SELECT kind, count(*) AS n, count(*)::DOUBLE / sum(count(*)) OVER () AS share FROM g GROUP BY kind")
def value_counts_with_nulls(t: Tables) -> DataFrame:
    return aggregate.value_counts(events_with_gaps(t), "kind")


@query(f"""{GAPS_SQL}
SELECT 'kind' AS column_name, count(*) FILTER (kind IS NULL) AS n_null, count(*) AS n_rows FROM g
UNION ALL SELECT 'value', count(*) FILTER (value IS NULL), count(*) FROM g
UNION ALL SELECT 'user_id', count(*) FILTER (user_id IS NULL), count(*) FROM g""")
def null_profile(t: Tables) -> DataFrame:
    return aggregate.null_counts(events_with_gaps(t), ["kind", "value", "user_id"])


@query(f"""{GAPS_SQL}
SELECT count(*) AS n_rows, count(*) FILTER (kind IS NOT NULL AND value IS NOT NULL) AS n_complete,
       count(*) FILTER (kind IS NULL OR value IS NULL) AS n_lost,
       round_even(count(*) FILTER (kind IS NOT NULL AND value IS NOT NULL)::DOUBLE * 100 / count(*), 1) AS percent_complete
FROM g""")
def complete_row_loss(t: Tables) -> DataFrame:
    return completeness(events_with_gaps(t), ["kind", "value"])


@query(f"""{GAPS_SQL}
SELECT count(*) AS n_before, count(*) FILTER (value < 10) AS n_after,
       count(*) - count(*) FILTER (value < 10) AS n_removed,
       round_even(count(*) FILTER (value < 10)::DOUBLE * 100 / count(*), 1) AS percent_kept
FROM g""")
def filter_row_loss(t: Tables) -> DataFrame:
    return aggregate.row_loss(events_with_gaps(t), F.col("value") < 10)


@query("""
SELECT event_type, {cells} FROM events GROUP BY event_type""".format(
    cells=", ".join(f"count(*) FILTER (dayofmonth(ts) = {d}) AS d{d}" for d in range(1, 32))
))
def count_matrix(t: Tables) -> DataFrame:
    days = list(range(1, 32))
    return pivot_counts(
        t.events,
        index="event_type",
        dim=F.dayofmonth("ts"),
        values=days,
        labels=[f"d{d}" for d in days],
    )


@query("""
SELECT l_returnflag, CAST(year(coalesce(shipped, l_shipdate - INTERVAL 30 DAY)) AS INTEGER) AS year, count(*) AS n
FROM (SELECT l_returnflag, l_shipdate, CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS shipped FROM lineitem)
GROUP BY ALL""")
def counts_by_year(t: Tables) -> DataFrame:
    shipped = F.when(F.col("l_linestatus") == "F", F.col("l_shipdate"))
    earlier = F.col("l_shipdate") - F.make_dt_interval(days=F.lit(30))
    return profiles.counts_by_year(t.lineitem, dim="l_returnflag", ts=shipped, fallback=earlier)


@query("""
SELECT l_returnflag, l_linestatus, tax_unit, count(*) AS n
FROM (SELECT l_returnflag, l_linestatus, nullif(l_tax, 0) AS tax_unit FROM lineitem) GROUP BY ALL""")
def unit_inventory(t: Tables) -> DataFrame:
    rows = t.lineitem.withColumn("tax_unit", codes.blank_sentinel(F.col("l_tax"), 0.0))
    return profiles.unit_inventory(
        rows,
        name="l_returnflag",
        unit="tax_unit",
        described_by=["l_returnflag", "l_linestatus", "tax_unit"],
    )[0]


@query("""
SELECT l_suppkey, count(DISTINCT nullif(l_tax, 0)) AS n_units FROM lineitem GROUP BY l_suppkey""")
def units_per_name(t: Tables) -> DataFrame:
    rows = t.lineitem.withColumn("tax_unit", codes.blank_sentinel(F.col("l_tax"), 0.0))
    return profiles.unit_inventory(
        rows, name="l_suppkey", unit="tax_unit", described_by=["l_suppkey"]
    )[1]


def shipping(t: Tables) -> DataFrame:
    """Line items with the date they were promised for, 60 days after the order; some are not shipped yet."""
    promised = F.col("o_orderdate") + F.make_dt_interval(days=F.lit(60))
    due = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), promised.alias("promised"))
    shipped = F.when(F.col("l_linenumber") != 3, F.col("l_shipdate")).alias("l_shipdate")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", shipped).join(due, "l_orderkey")
    return profiles.delays(rows, start="promised", end="l_shipdate", cap_minutes=30 * 1440)


DELAY_SQL = """WITH d AS (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_linenumber <> 3 THEN (epoch_us(l_shipdate) - epoch_us(o_orderdate + INTERVAL 60 DAY)) / 1e6 END AS secs
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey)"""


@query(f"""{DELAY_SQL}
SELECT l_orderkey, l_linenumber, secs AS delay_seconds, secs / 60.0 AS delay_minutes,
       CASE WHEN secs / 60.0 < 43200 THEN secs / 60.0 ELSE 43200.0 END AS delay_minutes_capped,
       abs(secs) AS delay_seconds_abs, coalesce(secs >= 0, false) AS end_not_before_start,
       CAST(floor(secs / 300) * 5 AS BIGINT) AS bucket_5_min,
       CAST(floor(secs / 3600) * 60 AS BIGINT) AS bucket_1_h
FROM d""")
def delay_rows(t: Tables) -> DataFrame:
    return shipping(t).drop("promised", "l_shipdate")


@query(f"""{DELAY_SQL}
SELECT CAST(floor(secs / 300) * 5 AS BIGINT) AS bucket_5_min, count(*) AS n FROM d
WHERE secs < 0 GROUP BY ALL""")
def delay_buckets_before(t: Tables) -> DataFrame:
    _, before = profiles.split_by_flag(shipping(t), "end_not_before_start")
    return aggregate.group_counts(before, ["bucket_5_min"], keep_nulls=False)


@query(f"""{DELAY_SQL},
v AS (SELECT CASE WHEN secs / 60.0 < 43200 THEN secs / 60.0 ELSE 43200.0 END::DOUBLE AS v FROM d WHERE secs IS NOT NULL),
e AS (SELECT min(v) AS lo, max(v) AS hi FROM v),
edges AS (SELECT b::BIGINT AS bin, b * ((hi - lo) / 100) + lo AS lower,
                 CASE WHEN b = 99 THEN hi ELSE (b + 1) * ((hi - lo) / 100) + lo END AS upper
          FROM e, range(100) r(b)),
n AS (SELECT bin, count(*) AS n FROM v JOIN edges
      ON v.v >= lower AND (v.v < upper OR (bin = 99 AND v.v = upper)) GROUP BY bin)
SELECT bin, round(lower, 6) AS lower, round(upper, 6) AS upper, coalesce(n, 0) AS n
FROM edges LEFT JOIN n USING (bin)""")
def delay_histogram(t: Tables) -> DataFrame:
    known = shipping(t).where("delay_seconds IS NOT NULL")
    bins = aggregate.histogram(known, "delay_minutes_capped")
    return bins.withColumns({c: F.round(c, 6) for c in ("lower", "upper")})
