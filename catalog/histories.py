"""Flags from earlier events, and the training table on shop events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anteframe import vocab
from anteframe.functions import codes
from anteframe.operators.history import history_flags as flags_up_to
from anteframe.operators.history import pair_count
from anteframe.operators.joins import attach

from .features import CASE, KINDS, WITH_WIDE, wide
from .registry import Tables, query

GROUPS = [1, 2, 3, 4, 5]


@query(f"""
WITH a AS (SELECT DISTINCT o_custkey, o_orderdate FROM orders WHERE o_orderstatus = 'O'),
h AS (SELECT o_custkey, o_orderdate AS at, CAST(o_orderpriority[1] AS INT) AS g
      FROM orders WHERE o_orderstatus <> 'O')
SELECT a.o_custkey, a.o_orderdate, {", ".join(f"bool_or(h.g = {g}) AS priority_{g}" for g in GROUPS)}
FROM a JOIN h ON h.o_custkey = a.o_custkey AND h.at <= a.o_orderdate GROUP BY ALL""")
def history_flags(t: Tables) -> DataFrame:
    anchors = t.orders.where("o_orderstatus = 'O'")
    history = t.orders.where("o_orderstatus <> 'O'").select(
        "o_custkey",
        F.col("o_orderdate").alias("at"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("g"),
    )
    return flags_up_to(
        anchors,
        history,
        key="o_custkey",
        anchor_ts="o_orderdate",
        event_ts="at",
        group="g",
        groups=GROUPS,
        prefix="priority",
    )


@query("""
SELECT count(*) AS n_pairs FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey
WHERE a.o_orderstatus = 'O' AND b.o_orderstatus <> 'O'""")
def history_pair_count(t: Tables) -> DataFrame:
    anchors = t.orders.where("o_orderstatus = 'O'").select("o_custkey")
    history = t.orders.where("o_orderstatus <> 'O'").select("o_custkey")
    return pair_count(anchors, history, key="o_custkey")


FLAGS = vocab.COMORBIDITY_FLAGS


@query(f"""{WITH_WIDE},
h AS (SELECT user_id, ts, CAST(json_extract_string(props, '$.k') AS INT) % 20 AS g
      FROM events WHERE event_type = 'error'),
flags AS (
  SELECT a.user_id, a.anchor_ts,
         {", ".join(f"coalesce(bool_or(h.g = {g}), false) AS {vocab.COMORBIDITY_PREFIX}_{g}" for g in vocab.COMORBIDITY_GROUPS)}
  FROM a LEFT JOIN h ON h.user_id = a.user_id AND h.ts <= a.anchor_ts GROUP BY ALL)
SELECT e.event_id, w.user_id, w.anchor_ts, w.click, w.error, w.signup, w.view,
       {", ".join("flags." + f for f in FLAGS)},
       CASE WHEN e.value < 50 THEN 0 ELSE 1 END AS label
FROM events e JOIN wide w ON w.user_id = e.user_id AND w.anchor_ts = e.ts
JOIN flags ON flags.user_id = w.user_id AND flags.anchor_ts = w.anchor_ts
WHERE e.event_type = 'purchase'""")
def training_table(t: Tables) -> DataFrame:
    anchors = t.events.where("event_type = 'purchase'").select(
        "event_id",
        "user_id",
        F.col("ts").alias("anchor_ts"),
        F.when(F.col("value") < 50, vocab.LABEL_NEGATIVE)
        .otherwise(vocab.LABEL_POSITIVE)
        .alias("text_label"),
    )
    history = t.events.where("event_type = 'error'").select(
        "user_id", "ts", (F.get_json_object("props", "$.k").cast("int") % 20).alias("g")
    )
    flags = flags_up_to(
        anchors,
        history,
        key="user_id",
        anchor_ts="anchor_ts",
        event_ts="ts",
        group="g",
        groups=vocab.COMORBIDITY_GROUPS,
        prefix=vocab.COMORBIDITY_PREFIX,
    )
    rows = attach(anchors, wide(t), on=CASE, keep_unmatched=False)
    rows = attach(rows, flags, on=CASE, keep_unmatched=True, fill_false=FLAGS)
    return rows.select(
        "event_id", *CASE, *KINDS, *FLAGS, codes.binary_label(F.col("text_label")).alias("label")
    )


@query(f"""
SELECT DISTINCT doc_id, label, confidence, CASE WHEN label = '{vocab.LABEL_NEGATIVE}' THEN 0 ELSE 1 END AS label_int
FROM (SELECT l.doc_id, least(d.n_chars / 1000.0::DOUBLE, 1.0::DOUBLE) AS confidence,
             CASE WHEN l.toxic = 1 THEN 'unklar' WHEN l.quality = 1 THEN '{vocab.LABEL_POSITIVE}'
                  ELSE '{vocab.LABEL_NEGATIVE}' END AS label
      FROM labels l JOIN documents d ON d.doc_id = l.doc_id)
WHERE label IN ('{vocab.LABEL_NEGATIVE}', '{vocab.LABEL_POSITIVE}') AND confidence >= 0.9""")
def labelled_selection(t: Tables) -> DataFrame:
    label = (
        F.when(F.col("toxic") == 1, "unklar")
        .when(F.col("quality") == 1, vocab.LABEL_POSITIVE)
        .otherwise(vocab.LABEL_NEGATIVE)
    )
    rows = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id").select(
        "doc_id",
        label.alias("label"),
        F.least(F.col("n_chars") / 1000.0, F.lit(1.0)).alias("confidence"),
    )
    sure = rows.distinct().where(codes.confident_label(F.col("label"), F.col("confidence")))
    return sure.withColumn("label_int", codes.binary_label(F.col("label")))
