"""Look-back features: purchases are the anchors, all other events the facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anteframe.operators.asof import (
    keep_known_keys,
    latest_per_dimension,
    lookback_counts,
    lookback_join,
)
from anteframe.operators.features import complete_cases, completeness, pivot_values
from anteframe.operators.joins import attach
from anteframe.plans import profiles

from .registry import Tables, query

HOURS = 168
KINDS = ["click", "error", "signup", "view"]
WIDE_KINDS = [f"{k}_{i}" for k in KINDS for i in range(10)]
CASE = ["user_id", "anchor_ts"]


def purchases(t: Tables) -> DataFrame:
    return t.events.where("event_type = 'purchase'").select(
        "user_id", F.col("ts").alias("anchor_ts")
    )


def facts(t: Tables) -> DataFrame:
    return t.events.where("event_type <> 'purchase'")


def fine_facts(t: Tables) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int") % 10
    return facts(t).withColumn("event_type", F.concat_ws("_", "event_type", k))


def latest(t: Tables, fine: bool = False, dims: list[str] | None = None) -> DataFrame:
    return latest_per_dimension(
        purchases(t),
        fine_facts(t) if fine else facts(t),
        key="user_id",
        anchor_ts="anchor_ts",
        fact_ts="ts",
        dim="event_type",
        value="value",
        hours=HOURS,
        dims=dims,
        tiebreak="event_id",
    )


def wide(t: Tables, fine: bool = False) -> DataFrame:
    kinds = WIDE_KINDS if fine else KINDS
    return pivot_values(
        latest(t, fine, kinds), index=CASE, dim="event_type", value="value", values=kinds
    )


FACTS_SQL = "SELECT event_id, user_id, ts, event_type, value FROM events WHERE event_type <> 'purchase'"
FINE_FACTS_SQL = """
SELECT event_id, user_id, ts, value,
       event_type || '_' || (CAST(json_extract_string(props, '$.k') AS INT) % 10) AS event_type
FROM events WHERE event_type <> 'purchase'"""


def latest_sql(facts_sql: str) -> str:
    return f"""
a AS (SELECT DISTINCT user_id, ts AS anchor_ts FROM events WHERE event_type = 'purchase'),
f AS ({facts_sql}),
latest AS (
  SELECT a.user_id, a.anchor_ts, f.event_type, f.value, f.ts, f.event_id,
         (epoch_us(a.anchor_ts) - epoch_us(f.ts)) / 1e6 / 60.0 AS minutes_before
  FROM a JOIN f ON f.user_id = a.user_id
   AND f.ts BETWEEN a.anchor_ts - INTERVAL 168 HOUR AND a.anchor_ts
  QUALIFY row_number() OVER (PARTITION BY a.user_id, a.anchor_ts, f.event_type
                             ORDER BY f.ts DESC, f.event_id DESC) = 1)"""


def wide_sql(kinds: list[str]) -> str:
    cells = ", ".join(f"max(value) FILTER (event_type = '{k}') AS \"{k}\"" for k in kinds)
    return f"wide AS (SELECT user_id, anchor_ts, {cells} FROM latest GROUP BY ALL)"


WITH = "WITH " + latest_sql(FACTS_SQL)
WITH_WIDE = f"{WITH}, {wide_sql(KINDS)}"
WITH_FINE = "WITH " + latest_sql(FINE_FACTS_SQL)
NONE_NULL = " AND ".join(f'"{k}" IS NOT NULL' for k in KINDS)


@query(f"{WITH_WIDE} SELECT * FROM wide")
def asof_latest_features(t: Tables) -> DataFrame:
    return wide(t)


@query(f"{WITH_FINE}, {wide_sql(WIDE_KINDS)} SELECT * FROM wide")
def asof_latest_features_fine(t: Tables) -> DataFrame:
    return wide(t, fine=True)


@query(f"{WITH} SELECT user_id, anchor_ts, event_type, value, ts, minutes_before FROM latest")
def latest_with_minutes_before(t: Tables) -> DataFrame:
    return latest(t)


@query("""
SELECT a.user_id, a.ts AS anchor_ts, f.event_id, f.ts
FROM events a JOIN events f ON f.user_id = a.user_id
 AND f.ts BETWEEN a.ts - INTERVAL 168 HOUR AND a.ts
WHERE a.event_type = 'purchase' AND f.event_type <> 'purchase'""")
def lookback_pairs(t: Tables) -> DataFrame:
    pairs = lookback_join(
        purchases(t),
        facts(t).select("user_id", "ts", "event_id"),
        key="user_id",
        anchor_ts="anchor_ts",
        fact_ts="ts",
        hours=HOURS,
    )
    return pairs.select("user_id", "anchor_ts", "event_id", "ts")


@query("""
SELECT a.user_id, a.ts AS anchor_ts, count(f.event_id) AS n_facts
FROM (SELECT DISTINCT user_id, ts FROM events WHERE event_type = 'purchase') a
LEFT JOIN events f ON f.user_id = a.user_id AND f.event_type <> 'purchase'
 AND f.ts BETWEEN a.ts - INTERVAL 168 HOUR AND a.ts
GROUP BY ALL""")
def lookback_join_counts(t: Tables) -> DataFrame:
    return lookback_counts(
        purchases(t),
        facts(t),
        key="user_id",
        anchor_ts="anchor_ts",
        fact_ts="ts",
        hours=HOURS,
    )


@query("""
SELECT event_id, user_id, ts FROM events
WHERE event_type <> 'purchase'
  AND user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 100)""")
def facts_of_known_cases(t: Tables) -> DataFrame:
    anchors = t.events.where("event_type = 'purchase' AND value > 100").select("user_id")
    rows = facts(t).select("event_id", "user_id", "ts")
    return keep_known_keys(rows, anchors, key="user_id")


@query(f"{WITH_WIDE} SELECT * FROM wide WHERE {NONE_NULL}")
def complete_case_features(t: Tables) -> DataFrame:
    return complete_cases(wide(t), KINDS)


@query(f"""{WITH_WIDE}
SELECT count(*) AS n_rows, count(*) FILTER ({NONE_NULL}) AS n_complete,
       count(*) FILTER (NOT ({NONE_NULL})) AS n_lost,
       round_even(CAST(count(*) FILTER ({NONE_NULL}) AS DOUBLE) * 100 / count(*), 1) AS percent_complete
FROM wide""")
def complete_case_share(t: Tables) -> DataFrame:
    return completeness(wide(t), KINDS)


@query(f"""{WITH_WIDE}
SELECT e.event_id, e.user_id, e.ts AS anchor_ts, e.ts - INTERVAL 168 HOUR AS window_start,
       w.click, w.error, w.signup, w.view
FROM events e LEFT JOIN wide w ON w.user_id = e.user_id AND w.anchor_ts = e.ts
WHERE e.event_type = 'purchase'""")
def features_keep_unmatched(t: Tables) -> DataFrame:
    anchors = t.events.where("event_type = 'purchase'").select(
        "event_id",
        "user_id",
        F.col("ts").alias("anchor_ts"),
        (F.col("ts") - F.make_dt_interval(hours=F.lit(HOURS))).alias("window_start"),
    )
    return attach(anchors, wide(t), on=CASE, keep_unmatched=True)


@query(f"""{WITH}
SELECT user_id, {", ".join(f"round(avg(value) FILTER (event_type = '{k}'), 6) AS {k}" for k in KINDS)}
FROM latest GROUP BY user_id""")
def mean_pivot(t: Tables) -> DataFrame:
    means = pivot_values(
        latest(t, dims=KINDS),
        index="user_id",
        dim="event_type",
        value="value",
        values=KINDS,
        how="mean",
    )
    return means.select("user_id", *[F.round(k, 6).alias(k) for k in KINDS])


@query(f"""{WITH_FINE},
ranked AS (SELECT event_type, row_number() OVER (ORDER BY count(*) DESC, event_type) AS r
           FROM latest GROUP BY event_type),
sets AS (SELECT user_id, anchor_ts, list(event_type) AS have FROM latest GROUP BY ALL),
core AS (SELECT a.r AS k, a.event_type AS last_param_added, list(b.event_type) AS need
         FROM ranked a JOIN ranked b ON b.r <= a.r GROUP BY ALL),
kept AS (SELECT k, last_param_added, count(*) FILTER (list_has_all(have, need)) AS n, count(*) AS total
         FROM core, sets GROUP BY ALL)
SELECT k AS k_num_params, last_param_added, n AS num_cases_kept,
       round(n::DOUBLE / total * 100, 6) AS percent_cases_kept,
       round(100 - n::DOUBLE / total * 100, 6) AS percent_cases_excluded
FROM kept WHERE k <= coalesce((SELECT min(k) FROM kept WHERE n = 0), k)""")
def coverage_curve(t: Tables) -> DataFrame:
    curve = profiles.coverage_curve(latest(t, fine=True), case=CASE, dim="event_type")
    percents = ["percent_cases_kept", "percent_cases_excluded"]
    return curve.withColumns({c: F.round(c, 6) for c in percents})


@query(f"""{WITH_FINE}
SELECT user_id, anchor_ts, array_to_string(list_sort(list(event_type)), ' ') AS have,
       list_has_all(list(event_type), ['click_1', 'view_2']) AS has_core
FROM latest GROUP BY ALL""")
def dimension_sets(t: Tables) -> DataFrame:
    sets = latest(t, fine=True).groupBy(*CASE).agg(F.collect_set("event_type").alias("s"))
    return sets.select(
        *CASE,
        F.array_join(F.array_sort("s"), " ").alias("have"),
        profiles.has_all(F.col("s"), ["click_1", "view_2"]).alias("has_core"),
    )


@query(f"""{WITH_FINE}
SELECT event_type,
       {", ".join(f"count(*) FILTER (floor(minutes_before / 1440) = {i}) AS \"{i * 24}-{(i + 1) * 24}h\"" for i in range(7))},
       count(*) FILTER (minutes_before >= 7 * 1440) AS ">=168h",
       round_even(CAST(count(*) FILTER (floor(minutes_before / 1440) = 0) AS DOUBLE) * 100
                  / (SELECT count(*) FROM (SELECT DISTINCT user_id, anchor_ts FROM latest)), 1) AS coverage
FROM latest GROUP BY event_type""")
def time_window_matrix(t: Tables) -> DataFrame:
    return profiles.time_window_table(
        latest(t, fine=True), case=CASE, dim="event_type", hours_per_window=24, lookback_hours=HOURS
    )


@query(f"""{WITH_FINE}
SELECT event_type, count(*) FILTER (minutes_before < 2880) AS "0-48h", count(*) FILTER (minutes_before >= 2880) AS ">=48h",
       round_even(CAST(count(*) FILTER (minutes_before < 2880) AS DOUBLE) * 100
                  / (SELECT count(*) FROM (SELECT DISTINCT user_id, anchor_ts FROM latest)), 1) AS coverage
FROM latest GROUP BY event_type""")
def time_window_open_end(t: Tables) -> DataFrame:
    """Values from further back than the windows reach stand in the last one."""
    return profiles.time_window_table(
        latest(t, fine=True), case=CASE, dim="event_type", hours_per_window=48, lookback_hours=48
    )


@query(f"""{WITH_FINE}
SELECT event_type, round(avg(minutes_before / 60), 6) AS mean_hours_before, count(*) AS n
FROM latest GROUP BY event_type""")
def timing_stats(t: Tables) -> DataFrame:
    stats = profiles.timing_stats(latest(t, fine=True), dim="event_type")
    return stats.withColumn("mean_hours_before", F.round("mean_hours_before", 6))


# A quartile of the sketch is right if it lies between the values 1 % below and above its rank.
RANKS_SQL = ", ".join(f"true AS {n}_in_bounds" for n in ("q1", "median", "q3"))


@query(f"""{WITH_FINE}
SELECT event_type, count(*) AS n, {RANKS_SQL} FROM latest GROUP BY event_type""")
def timing_quartiles(t: Tables) -> DataFrame:
    """Quartiles out of merged daily sketches, held against the ranks of all values."""
    rows = latest(t, fine=True)
    sketches = profiles.timing_sketches(rows, dim="event_type", anchor_ts="anchor_ts")
    found = profiles.timing_quartiles(sketches, dim="event_type").drop("n")
    hours = F.col("minutes_before") / 60
    bounds = {"q1": ("q1_hours", 0.25), "median": ("median_hours", 0.5), "q3": ("q3_hours", 0.75)}

    def within(name: str, q: float) -> Column:
        below, upto = F.count_if(hours < F.col(name)), F.count_if(hours <= F.col(name))
        return (below <= (q + 0.01) * F.count("*")) & (upto >= (q - 0.01) * F.count("*"))

    return rows.join(found, "event_type").groupBy("event_type").agg(
        F.count("*").alias("n"), *[within(*b).alias(f"{n}_in_bounds") for n, b in bounds.items()]
    )


@query(f"""{WITH_FINE}
SELECT event_type, strftime(anchor_ts, '%Y-%m') AS period, count(*) AS n FROM latest GROUP BY ALL""")
def timing_sketch_periods(t: Tables) -> DataFrame:
    """The same sketches merged to months: no period is without its quartiles, and these rise."""
    sketches = profiles.timing_sketches(latest(t, fine=True), dim="event_type", anchor_ts="anchor_ts")
    months = profiles.timing_quartiles(sketches, dim="event_type", period=F.date_format("day", "yyyy-MM"))
    return months.where("q1_hours <= median_hours AND median_hours <= q3_hours").select("event_type", "period", "n")
