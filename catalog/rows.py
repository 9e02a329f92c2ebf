"""Which rows stay: versions, unique groups, null-aware filters, joins and unions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anteframe.columns import all_present
from anteframe.functions import codes
from anteframe.operators import aggregate, dedup, joins, sets

from .registry import Tables, query


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus
                           ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) = 1""")
def latest_version(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_totalprice")
    return dedup.latest_version(
        rows,
        ["o_custkey", "o_orderstatus"],
        [F.desc_nulls_last("o_orderdate"), F.desc("o_orderkey")],
    )


@query("""
SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders
QUALIFY count(*) OVER (PARTITION BY o_custkey, o_orderdate) = 1""")
def unique_per_day(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return dedup.keep_singletons(rows, ["o_custkey", "o_orderdate"])


@query("""
SELECT o_custkey, o_orderdate, count(*) AS size FROM orders GROUP BY ALL HAVING count(*) <> 1""")
def uniqueness_violations(t: Tables) -> DataFrame:
    return dedup.uniqueness_violations(t.orders, ["o_custkey", "o_orderdate"])


@query("""
WITH o AS (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority, o_orderstatus FROM orders)
SELECT o_orderkey, priority, o_orderstatus, count(*) OVER (PARTITION BY priority, o_orderstatus) AS size FROM o""")
def group_sizes(t: Tables) -> DataFrame:
    rows = t.orders.select(
        "o_orderkey",
        codes.blank_sentinel(F.col("o_orderpriority"), "5-LOW").alias("priority"),
        "o_orderstatus",
    )
    return joins.with_group_size(rows, ["priority", "o_orderstatus"])


@query("""
SELECT CASE WHEN count(*) = 1 THEN max(t) END AS t, count(t) AS n, o_custkey, o_orderstatus
FROM (SELECT o_custkey, o_orderstatus, CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS t FROM orders)
GROUP BY o_custkey, o_orderstatus HAVING count(t) = 1""")
def single_or_null(t: Tables) -> DataFrame:
    rows = t.orders.select(
        "o_custkey",
        "o_orderstatus",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("t"),
    )
    return aggregate.single_or_null(rows, ["o_custkey", "o_orderstatus"], "t")


@query("""
SELECT event_id, kind FROM (SELECT event_id, nullif(event_type, 'error') AS kind FROM events)
WHERE kind IS DISTINCT FROM 'click'""")
def not_equal_keep_null(t: Tables) -> DataFrame:
    kind = codes.blank_sentinel(F.col("event_type"), "error").alias("kind")
    rows = t.events.select("event_id", kind)
    return rows.where(codes.differs(F.col("kind"), "click"))


@query("""
SELECT event_id, kind, value FROM
  (SELECT event_id, nullif(event_type, 'error') AS kind, CASE WHEN value < 100 THEN value END AS value FROM events)
WHERE kind IS NOT NULL AND value IS NOT NULL""")
def all_columns_present(t: Tables) -> DataFrame:
    rows = t.events.select(
        "event_id",
        codes.blank_sentinel(F.col("event_type"), "error").alias("kind"),
        F.when(F.col("value") < 100, F.col("value")).alias("value"),
    )
    return rows.where(all_present(["kind", "value"]))


@query("""
SELECT event_id, event_type, contains(coalesce(kind, ''), 'i') AS has_i, event_type IN ('view', 'signup') AS listed
FROM (SELECT event_id, event_type, nullif(event_type, 'error') AS kind FROM events)""")
def text_predicates(t: Tables) -> DataFrame:
    kind = codes.blank_sentinel(F.col("event_type"), "error")
    return t.events.select(
        "event_id",
        "event_type",
        codes.matches(kind, "i").alias("has_i"),
        F.col("event_type").isin("view", "signup").alias("listed"),
    )


@query("""
WITH p AS (SELECT p_partkey, p_type, nullif(p_brand, 'Brand#1') AS brand FROM part),
d AS (SELECT p_type, nullif(p_brand, 'Brand#1') AS brand, max(p_size) AS max_size FROM part GROUP BY ALL)
SELECT p.p_partkey, p.p_type, p.brand, d.max_size
FROM p JOIN d ON d.p_type IS NOT DISTINCT FROM p.p_type AND d.brand IS NOT DISTINCT FROM p.brand""")
def null_safe_join(t: Tables) -> DataFrame:
    brand = codes.blank_sentinel(F.col("p_brand"), "Brand#1").alias("brand")
    parts = t.part.select("p_partkey", "p_type", brand)
    largest = t.part.groupBy("p_type", brand).agg(F.max("p_size").alias("max_size"))
    return joins.null_safe_join(parts, largest, on=["p_type", "brand"])


@query("""
SELECT DISTINCT nation, balance, segment, supplier FROM (
  SELECT c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment, NULL AS supplier FROM customer
  UNION ALL
  SELECT s_nationkey, s_acctbal, NULL, s_name FROM supplier)""")
def union_missing_columns(t: Tables) -> DataFrame:
    buyers = t.customer.select(
        F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    sellers = t.supplier.select(
        F.col("s_nationkey").alias("nation"),
        F.col("s_acctbal").alias("balance"),
        F.col("s_name").alias("supplier"),
    )
    return sets.union_all(buyers, sellers, fill_missing=True).distinct()


@query("""
SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus = 'F'""")
def filtered_distinct_rows(t: Tables) -> DataFrame:
    rows = t.orders.where(F.col("o_orderstatus") == "F")
    return rows.select("o_custkey", "o_orderstatus", "o_orderpriority").distinct()
