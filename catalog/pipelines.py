"""The clinical pipelines on sources derived from events (labs), orders (procedures, reports,
diagnoses) and customers and suppliers (master data)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anteframe import vocab
from anteframe.columns import col
from anteframe.operators.aggregate import distinct_counts
from anteframe.plans import cohort, labs, profiles, training

from .registry import Tables, query

ANCHOR = ["Fallnummer", "prozedur_datetime"]


# Labs: errors are the main source, views come late, signups are blood gases, clicks devices.


def lab_sources(t: Tables) -> dict[str, DataFrame]:
    e = t.events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    iso, v, k = "yyyy-MM-dd'T'HH:mm:ss", F.col("value").cast("string"), F.col("k")

    def stamp(suffix: str, shift_minutes: int = 0) -> Column:
        at = F.col("ts") + F.make_dt_interval(mins=F.lit(shift_minutes))
        return F.concat(F.date_format(at, iso), F.lit(suffix))

    def source(kind: str, at: Column, result_at: Column, value: Column, code: Column) -> DataFrame:
        cells = [F.col("user_id"), at, result_at, value, code]
        return e.where(F.col("event_type") == kind).select(
            "k", *[c.alias(n) for c, n in zip(cells, labs.LAB_COLUMNS)]
        )

    main = source(
        "error",
        stamp("+0100"),
        stamp("+0100", 30),
        F.when(k < 10, "positiv").otherwise(F.translate(v, ".", ",")),
        F.when(k < 25, "O-K_Z").when(k < 50, "K_S").when(k < 75, "NA_S").when(k < 88, "B-HGB_E").otherwise("NEW_S"),
    )
    late = source(
        "view",
        stamp("+02:00"),
        stamp("+02:00", 30),
        F.concat(F.lit("<"), v),
        F.when(k < 20, None).when(k < 40, "CKDEPI").otherwise("CRE_S"),
    )
    gas = source(
        "signup",
        F.when(k >= 30, stamp("Z")),
        F.when(k % 9 != 5, F.when(k % 7 == 0, stamp("Z", -20)).otherwise(stamp("Z", 10))),
        v,
        F.when(k > 80, vocab.SAMPLE_KIND_ID).otherwise("O-CL_Z"),
    )
    clock = F.lpad((k * 37 % 2400).cast("string"), 4, "0")
    device = source(
        "click",
        stamp("+0100"),
        stamp("+0100", 1),
        F.concat(F.lit("> "), v),
        F.when(k < 50, "K_H").otherwise(F.concat(F.lit("O-GLU_Z."), clock)),
    ).withColumnsRenamed(dict(zip(labs.LAB_COLUMNS, labs.DEVICE_COLUMNS)))
    return {
        "main": main,
        "late": late.unionByName(late),
        "blood_gas": gas,
        "potassium": device.where("k < 50"),
        "glucose": device.where("k >= 50"),
    }


LABS_SQL = """
e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k, date_trunc('second', ts) AS s, value::VARCHAR AS v FROM events),
raw AS (
  SELECT user_id, s - INTERVAL 1 HOUR AS seen, replace(v, '.', ',') AS txt, value,
         CASE WHEN k < 25 THEN 'O-K_Z' WHEN k < 50 THEN 'K_S' WHEN k < 75 THEN 'NA_S' WHEN k < 88 THEN 'B-HGB_E' ELSE 'NEW_S' END AS code
  FROM e WHERE event_type = 'error' AND k >= 10
  UNION ALL SELECT user_id, s - INTERVAL 2 HOUR, '<' || v, value, CASE WHEN k < 40 THEN 'CKDEPI' ELSE 'CRE_S' END
  FROM e WHERE event_type = 'view' AND k >= 20
  UNION ALL SELECT user_id, seen, v, value, 'O-CL_Z'
  FROM (SELECT *, CASE WHEN k >= 30 THEN s WHEN k % 9 = 5 THEN NULL WHEN k % 7 = 0 THEN s - INTERVAL 20 MINUTE ELSE s + INTERVAL 10 MINUTE END AS seen FROM e)
  WHERE event_type = 'signup' AND k <= 80 AND seen IS NOT NULL
  UNION ALL SELECT user_id, s - INTERVAL 1 HOUR, '> ' || v, value,
         CASE WHEN k < 50 THEN 'K_H' ELSE 'O-GLU_Z.' || lpad((k * 37 % 2400)::VARCHAR, 4, '0') END
  FROM e WHERE event_type = 'click'),
labs AS (
  SELECT DISTINCT user_id AS "Fallnummer", seen AS "Probeneingangsdatum", txt AS "Ergebniswert", code AS "Parameter-ID primär",
         value AS ergebniswert_num,
         CASE WHEN starts_with(code, 'O-GLU_Z.') THEN date_trunc('day', seen) + to_hours(substr(code, 9, 2)::INT)
              + to_minutes(substr(code, 11, 2)::INT) ELSE seen END AS abnahmezeitpunkt_effektiv,
         CASE WHEN code LIKE '%GLU!_%' ESCAPE '!' THEN 'x-GLU_x' WHEN code IN ('K_S', 'O-K_Z', 'K_H') THEN 'x-K_x'
              WHEN code IN ('NA_S', 'O-NA_Z') THEN 'x-NA_x' WHEN code IN ('CL_S', 'O-CL_Z') THEN 'x-CL_x'
              ELSE code END AS parameterid_effektiv
  FROM raw)"""

LABELLED_SQL = f"""
labelled AS (
  SELECT user_id AS "Fallnummer", date_trunc('second', ts) AS prozedur_datetime, 'P' || user_id AS "Patientennummer",
         CASE WHEN value < 30 THEN '{vocab.LABEL_NEGATIVE}' WHEN value < 100 THEN '{vocab.LABEL_POSITIVE}' ELSE 'unklar' END AS predicted_label,
         CASE WHEN value < 5 THEN 0.5::DOUBLE ELSE 0.95::DOUBLE END AS confidence
  FROM events WHERE event_type = 'purchase'),
procs AS (SELECT DISTINCT * FROM labelled WHERE predicted_label <> 'unklar' AND confidence >= 0.9)"""

LATEST_SQL = """
latest AS (
  SELECT p."Fallnummer", p.prozedur_datetime, l.parameterid_effektiv, l.ergebniswert_num
  FROM (SELECT DISTINCT "Fallnummer", prozedur_datetime FROM procs) p JOIN labs l ON l."Fallnummer" = p."Fallnummer"
   AND l.abnahmezeitpunkt_effektiv BETWEEN p.prozedur_datetime - INTERVAL 168 HOUR AND p.prozedur_datetime
  QUALIFY row_number() OVER (PARTITION BY p."Fallnummer", p.prozedur_datetime, l.parameterid_effektiv
                             ORDER BY l.abnahmezeitpunkt_effektiv DESC, l.ergebniswert_num DESC) = 1)"""

CELLS_SQL = ", ".join(
    f"max(ergebniswert_num) FILTER (parameterid_effektiv = '{i}') AS \"{i}\"" for i in vocab.LAB_FEATURES
)
WIDE_SQL = f'wide AS (SELECT "Fallnummer", prozedur_datetime, {CELLS_SQL} FROM latest GROUP BY ALL)'
FEATURES_SQL = ", ".join(f'wide."{i}"' for i in vocab.LAB_FEATURES)


def naive(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the SQL side has them."""
    stamps = [f.name for f in df.schema if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: col(c).cast("timestamp_ntz") for c in stamps})


def clean_labs(t: Tables, variant: str = "complete") -> DataFrame:
    return labs.labs_from_sources(lab_sources(t), variant)


def labelled(t: Tables) -> DataFrame:
    value = F.col("value")
    return t.events.where("event_type = 'purchase'").select(
        F.col("user_id").alias("Fallnummer"),
        F.date_trunc("second", "ts").cast("timestamp").alias("prozedur_datetime"),
        F.concat(F.lit("P"), F.col("user_id").cast("string")).alias("Patientennummer"),
        F.when(value < 30, vocab.LABEL_NEGATIVE)
        .when(value < 100, vocab.LABEL_POSITIVE)
        .otherwise("unklar")
        .alias("predicted_label"),
        F.when(value < 5, 0.5).otherwise(0.95).alias("confidence"),
    )


def procs(t: Tables) -> DataFrame:
    return training.procedures_for_training(labelled(t))


@query(f"WITH {LABS_SQL} SELECT * FROM labs")
def lab_cleaning(t: Tables) -> DataFrame:
    return naive(clean_labs(t))


@query(f"""WITH {LABS_SQL} SELECT * FROM labs WHERE "Parameter-ID primär" IN ('O-K_Z', 'K_S', 'NA_S', 'B-HGB_E', 'CKDEPI', 'CRE_S')""")
def lab_cleaning_reduced(t: Tables) -> DataFrame:
    return naive(clean_labs(t, "reduced"))


@query(f"WITH {LABS_SQL} SELECT DISTINCT parameterid_effektiv FROM labs")
def distinct_lab_ids(t: Tables) -> DataFrame:
    return labs.distinct_lab_ids(clean_labs(t))


@query(f"WITH {LABELLED_SQL} SELECT * FROM procs")
def training_procedures(t: Tables) -> DataFrame:
    return naive(procs(t))


@query(f"WITH {LABELLED_SQL} SELECT (SELECT count(*) FROM labelled) AS n_labelled, (SELECT count(*) FROM procs) AS n_used")
def training_selection_counts(t: Tables) -> DataFrame:
    return training.selection_counts(labelled(t))


@query(f"WITH {LABS_SQL}, {LABELLED_SQL}, {LATEST_SQL}, {WIDE_SQL} SELECT * FROM wide")
def lab_features(t: Tables) -> DataFrame:
    return naive(labs.lab_features(procs(t), clean_labs(t)))


@query(f"""WITH {LABS_SQL}, {LABELLED_SQL}, {LATEST_SQL}
SELECT "Fallnummer", prozedur_datetime, count(*) AS n_features, string_agg(parameterid_effektiv, ' ' ORDER BY parameterid_effektiv) AS keys,
       max(ergebniswert_num) FILTER (parameterid_effektiv = 'NEW_S') AS "NEW_S", max(ergebniswert_num) FILTER (parameterid_effektiv = 'x-K_x') AS "x-K_x"
FROM latest GROUP BY ALL""")
def feature_maps(t: Tables) -> DataFrame:
    """Among the keys is NEW_S, which no list names."""
    maps = labs.feature_maps(procs(t), clean_labs(t))
    of = {i: F.try_element_at("features", F.lit(i)) for i in ("NEW_S", "x-K_x")}
    keys = F.array_join(F.map_keys("features"), " ").alias("keys")
    return naive(maps.select(*map(col, ANCHOR), F.size("features").cast("long").alias("n_features"), keys, *[c.alias(i) for i, c in of.items()]))


@query(f"""WITH {LABS_SQL}, {LABELLED_SQL}, {LATEST_SQL}
SELECT row_number() OVER (ORDER BY parameterid_effektiv) - 1 AS column_number, parameterid_effektiv, count(*) AS n_values
FROM latest GROUP BY parameterid_effektiv""")
def feature_dictionary(t: Tables) -> DataFrame:
    return labs.feature_dictionary(labs.feature_maps(procs(t), clean_labs(t)))


@query(f"""WITH {LABS_SQL}, {LABELLED_SQL}, {LATEST_SQL},
d AS (SELECT parameterid_effektiv, row_number() OVER (ORDER BY parameterid_effektiv) - 1 AS i FROM (SELECT DISTINCT parameterid_effektiv FROM latest))
SELECT "Fallnummer", prozedur_datetime, string_agg(i, ' ' ORDER BY i) AS columns, count(*) AS n, max_by(ergebniswert_num, i) AS last_value
FROM latest JOIN d USING (parameterid_effektiv) GROUP BY ALL""")
def feature_vectors(t: Tables) -> DataFrame:
    maps = labs.feature_maps(procs(t), clean_labs(t))
    rows = labs.feature_vectors(maps, labs.feature_dictionary(maps))
    return naive(rows.select(
        *map(col, ANCHOR), F.array_join(F.col("columns").cast("array<string>"), " ").alias("columns"),
        F.size("columns").cast("long").alias("n"), F.element_at("values", -1).alias("last_value"),
    ))


# The short list as its columns, and the ids from which they are made, before any are merged.
REDUCED = [f'wide."{i}" IS NOT NULL' for i in vocab.LAB_FEATURES_REDUCED]
RAW_REDUCED = ", ".join(f"'{i}'" for i in vocab.LAB_IDS_REDUCED)
REDUCED_SQL = f"""all_labs AS (SELECT * FROM labs),
few AS (SELECT * FROM all_labs WHERE "Parameter-ID primär" IN ({RAW_REDUCED})),
{LATEST_SQL.replace("JOIN labs l", "JOIN few l")}, {WIDE_SQL}"""


@query(f"""WITH {LABS_SQL}, {LABELLED_SQL}, {REDUCED_SQL}
SELECT "Fallnummer", prozedur_datetime, "x-K_x", "x-NA_x", "CRE_S" FROM wide
WHERE "x-K_x" IS NOT NULL AND "x-NA_x" IS NOT NULL AND "CRE_S" IS NOT NULL""")
def lab_features_reduced(t: Tables) -> DataFrame:
    """With three of the columns: no case here has all of the short list."""
    few = ["x-K_x", "x-NA_x", "CRE_S"]
    return naive(labs.lab_features(procs(t), clean_labs(t), variant="reduced", ids=few))


@query(f"""WITH {LABS_SQL} SELECT parameterid_effektiv, count(*) AS n FROM labs WHERE parameterid_effektiv = 'NEW_S' GROUP BY ALL""")
def unlisted_lab_values(t: Tables) -> DataFrame:
    return labs.unlisted_values(clean_labs(t))


GAS_SQL = """
e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k, date_trunc('second', ts) AS s FROM events),
gas AS (SELECT CASE WHEN k > 80 THEN 'O-PROBENTYP' ELSE 'O-CL_Z' END AS code, CASE WHEN k >= 30 THEN s END AS seen,
               CASE WHEN k % 9 <> 5 THEN CASE WHEN k % 7 = 0 THEN s - INTERVAL 20 MINUTE ELSE s + INTERVAL 10 MINUTE END END AS done
        FROM e WHERE event_type = 'signup')"""


@query(f"""WITH {GAS_SQL},
v AS (SELECT epoch(done - seen) / 60 AS v FROM gas WHERE seen IS NOT NULL AND done IS NOT NULL),
b AS (SELECT bin, -20 + bin * 0.3::DOUBLE AS lower, CASE WHEN bin = 99 THEN 10 ELSE -20 + (bin + 1) * 0.3::DOUBLE END AS upper FROM range(100) r(bin))
SELECT bin::BIGINT AS bin, round(lower, 6) AS lower, round(upper, 6) AS upper,
       CASE bin WHEN 0 THEN (SELECT count(*) FROM v WHERE v = -20) WHEN 99 THEN (SELECT count(*) FROM v WHERE v = 10) ELSE 0 END AS n
FROM b""")
def blood_gas_delay_histogram(t: Tables) -> DataFrame:
    bins = profiles.blood_gas_delay_histogram(lab_sources(t)["blood_gas"])
    return bins.withColumns({c: F.round(c, 6) for c in ("lower", "upper")})


@query(f"""WITH {GAS_SQL}
SELECT code AS "Parameter-ID primär", CAST(year(coalesce(seen, done)) AS INTEGER) AS year, count(*) AS n
FROM gas WHERE coalesce(seen, done) IS NOT NULL GROUP BY ALL""")
def blood_gas_years(t: Tables) -> DataFrame:
    return profiles.blood_gas_counts_by_year(lab_sources(t)["blood_gas"])


@query(f"""WITH {LABS_SQL}, {LABELLED_SQL}, {REDUCED_SQL},
n AS (SELECT count(*) AS n_rows, count(*) FILTER ({" AND ".join(REDUCED)}) AS n_complete FROM wide)
SELECT n_rows, n_complete, n_rows - n_complete AS n_lost, round_even(n_complete::DOUBLE * 100 / n_rows, 1) AS percent_complete FROM n""")
def reduced_completeness(t: Tables) -> DataFrame:
    return labs.reduced_completeness(procs(t), clean_labs(t))


@query(f"""WITH {LABS_SQL}, {LABELLED_SQL}, {LATEST_SQL}, {WIDE_SQL}
SELECT procs.*, procs.prozedur_datetime - INTERVAL 168 HOUR AS prozedur_fenster_start,
       procs."Fallnummer" || '+' || strftime(procs.prozedur_datetime, '%Y-%m-%d_%H:%M:%S') AS "Fall_dt", {FEATURES_SQL}
FROM procs LEFT JOIN wide ON wide."Fallnummer" = procs."Fallnummer" AND wide.prozedur_datetime = procs.prozedur_datetime""")
def procedures_with_labs(t: Tables) -> DataFrame:
    return naive(training.merge_labs(procs(t), clean_labs(t)))


@query(f"""WITH {LABS_SQL}
SELECT "Fallnummer", {", ".join(f"round(avg(ergebniswert_num) FILTER (parameterid_effektiv = '{i}'), 6) AS \"{i}\"" for i in vocab.LAB_FEATURES)}
FROM labs GROUP BY ALL""")
def mean_labs_per_case(t: Tables) -> DataFrame:
    means = labs.mean_features_per_case(clean_labs(t))
    return means.withColumns({i: F.round(col(i), 6) for i in vocab.LAB_FEATURES})


@query(f"""WITH {LABS_SQL}, {LABELLED_SQL}, {LATEST_SQL},
ranked AS (SELECT parameterid_effektiv AS p, row_number() OVER (ORDER BY count(*) DESC, parameterid_effektiv) AS r
           FROM latest GROUP BY parameterid_effektiv),
sets AS (SELECT list(parameterid_effektiv) AS have FROM latest GROUP BY "Fallnummer", prozedur_datetime),
core AS (SELECT a.r AS k, a.p, list(b.p) AS need FROM ranked a JOIN ranked b ON b.r <= a.r GROUP BY ALL),
kept AS (SELECT k, p, count(*) FILTER (list_has_all(have, need)) AS n, count(*) AS total FROM core, sets GROUP BY ALL)
SELECT k AS k_num_params, p AS last_param_added, n AS num_cases_kept,
       round(n::DOUBLE / total * 100, 6) AS percent_cases_kept, round(100 - n::DOUBLE / total * 100, 6) AS percent_cases_excluded
FROM kept WHERE k <= coalesce((SELECT min(k) FROM kept WHERE n = 0), k)""")
def feature_tradeoff(t: Tables) -> DataFrame:
    curve = training.feature_tradeoff(labelled(t), clean_labs(t))
    return curve.withColumns({c: F.round(c, 6) for c in curve.columns if c.startswith("percent")})


# Diagnoses: orders moved to the time of the events; the comorbidity list comes from the nations.


def diagnosis_source(t: Tables) -> DataFrame:
    at = F.col("o_orderdate") + F.make_dt_interval(days=F.lit(9000), hours=F.lit(14), mins=F.lit(5))
    letter = F.chr(65 + F.ascii(F.substring("o_orderpriority", 3, 1)) % 26)
    digits = F.lpad((F.floor("o_totalprice") % 1000).cast("string"), 3, "0")
    code = F.concat(letter, F.substring(digits, 1, 2), F.lit("."), F.substring(digits, 3, 1))
    return t.orders.select(
        F.col("o_custkey").alias("Fall"),
        code.alias("Diagnoseschlüssel"),
        F.date_format(at, "M/d/yyyy").alias("DiagDatum"),
        F.date_format(at, "h:mm:ss a").alias("Zeit"),
    )


def comorbidity_map(t: Tables) -> DataFrame:
    """Short prefixes for all codes; the full code has a group of its own for some orders."""
    rows = diagnosis_source(t).withColumnRenamed("Diagnoseschlüssel", "code")
    digit = F.substring("code", 2, 1)
    short = rows.select(
        F.concat(F.substring("code", 1, 2), F.lit(".x")), (digit.cast("int") + 1).alias("g")
    )
    full = rows.where("Zeit = '2:05:00 PM' AND Fall < 200").select(
        "code", (F.col("Fall") % 7 + 11).cast("int").alias("g")
    )
    return short.union(full).distinct().toDF("icd-10-code", "charlson_group")


DIAG_SQL = """
d AS (SELECT o_custkey AS "Fallnummer", o_orderdate + INTERVAL 9000 DAY + INTERVAL 14 HOUR + INTERVAL 5 MINUTE AS diagnose_datetime,
             chr(65 + ascii(o_orderpriority[3]) % 26) AS letter, lpad((floor(o_totalprice)::BIGINT % 1000)::VARCHAR, 3, '0') AS dg
      FROM orders),
m AS (SELECT icd, min(g)::INT AS g FROM (
        SELECT letter || dg[1] AS icd, CAST(dg[1] AS INT) + 1 AS g FROM d
        UNION ALL SELECT letter || dg[1:2] || '.' || dg[3], "Fallnummer" % 7 + 11 FROM d WHERE "Fallnummer" < 200) GROUP BY icd),
c AS (SELECT DISTINCT "Fallnummer", letter || dg[1:2] || '.' || dg[3] AS code, diagnose_datetime FROM d),
g AS (SELECT code, (SELECT max_by(g, length(icd)) FROM m WHERE starts_with(code, icd)) AS charlson_group FROM (SELECT DISTINCT code FROM c)),
diags AS (SELECT c."Fallnummer", c.code AS "Diagnoseschlüssel", g.charlson_group, c.diagnose_datetime FROM c JOIN g ON g.code = c.code)"""


def diags(t: Tables) -> DataFrame:
    return cohort.diagnoses(diagnosis_source(t), comorbidity_map(t))


@query(f"WITH {DIAG_SQL} SELECT * FROM diags")
def diagnoses_with_group(t: Tables) -> DataFrame:
    return naive(diags(t))


FLAGS_SQL = f"""
flags AS (
  SELECT p."Fallnummer", p.prozedur_datetime,
         {", ".join(f"coalesce(bool_or(charlson_group = {g}), false) AS charlson_group_{g}" for g in vocab.COMORBIDITY_GROUPS)}
  FROM (SELECT DISTINCT "Fallnummer", prozedur_datetime FROM procs) p
  JOIN diags ON diags."Fallnummer" = p."Fallnummer" AND diags.diagnose_datetime <= p.prozedur_datetime GROUP BY ALL)"""


@query(f"WITH {LABELLED_SQL}, {DIAG_SQL}, {FLAGS_SQL} SELECT * FROM flags")
def comorbidity_flags(t: Tables) -> DataFrame:
    return naive(cohort.comorbidity_flags(procs(t), diags(t)))


@query(f"""WITH {LABELLED_SQL}, {DIAG_SQL}, {FLAGS_SQL}
SELECT procs.*, {", ".join("flags." + f for f in vocab.COMORBIDITY_FLAGS)}
FROM procs LEFT JOIN flags ON flags."Fallnummer" = procs."Fallnummer" AND flags.prozedur_datetime = procs.prozedur_datetime""")
def procedures_with_diagnoses(t: Tables) -> DataFrame:
    return naive(training.merge_diagnoses(procs(t), diags(t)))


@query(f"""WITH {LABS_SQL}, {LABELLED_SQL}, {LATEST_SQL}, {WIDE_SQL}, {DIAG_SQL}, {FLAGS_SQL}
SELECT procs.*, procs.prozedur_datetime - INTERVAL 168 HOUR AS prozedur_fenster_start, {FEATURES_SQL},
       {", ".join(f"coalesce(flags.{f}, false) AS {f}" for f in vocab.COMORBIDITY_FLAGS)},
       CASE WHEN predicted_label = '{vocab.LABEL_NEGATIVE}' THEN 0 ELSE 1 END AS predicted_label_int
FROM procs JOIN wide ON wide."Fallnummer" = procs."Fallnummer" AND wide.prozedur_datetime = procs.prozedur_datetime
LEFT JOIN flags ON flags."Fallnummer" = procs."Fallnummer" AND flags.prozedur_datetime = procs.prozedur_datetime""")
def clinic_training_table(t: Tables) -> DataFrame:
    return naive(training.training_table(labelled(t), clean_labs(t), diags(t)))


# Cohort: orders are procedures and reports, customers and suppliers the master data.


def master_sources(t: Tables) -> tuple[DataFrame, DataFrame]:
    inpatient = F.col("c_mktsegment").isin("HOUSEHOLD", "MACHINERY", "FURNITURE")
    first = t.customer.select(
        F.col("c_custkey").alias("Fallnummer"),
        F.concat(F.lit("P"), F.col("c_nationkey").cast("string")).alias("Patientennummer"),
        F.when(F.col("c_acctbal") > 5000, "W").otherwise("M").alias("Geschlecht"),
        (F.floor(F.abs("c_acctbal")) % 90).alias("Alter"),
        F.when(inpatient, vocab.INPATIENT).otherwise("Ambulant").alias("Bewegung Behandlungsart"),
    )
    late = t.supplier.select(
        (F.col("s_suppkey") + 100000).alias("Fall"),
        F.concat(F.lit("P"), F.col("s_nationkey").cast("string")).alias("Patient"),
        F.lit("W").alias("G"),
        F.date_format(
            F.date_sub(F.lit("1999-01-01"), F.floor("s_acctbal").cast("int")), "yyyy-MM-dd"
        ).alias("GebDatum"),
        F.when(F.col("s_acctbal") > 3000, vocab.INPATIENT).otherwise("Ambulant").alias("Fa"),
    )
    return first, late


MASTER_SQL = f"""
master AS (
  SELECT DISTINCT c_custkey AS "Fallnummer", 'P' || c_nationkey AS "Patientennummer",
         CASE WHEN c_acctbal > 5000 THEN 'W' ELSE 'M' END AS geschlecht,
         floor(abs(c_acctbal))::BIGINT % 90 AS alter_bei_prozedur, '{vocab.INPATIENT}' AS behandlungsart, NULL::TIMESTAMP AS geburtsdatum
  FROM customer WHERE c_mktsegment IN ('HOUSEHOLD', 'MACHINERY', 'FURNITURE')
  UNION SELECT s_suppkey + 100000, 'P' || s_nationkey, 'W', NULL, '{vocab.INPATIENT}',
         TIMESTAMP '1999-01-01' - to_days(floor(s_acctbal)::INT)
  FROM supplier WHERE s_acctbal > 3000)"""

CODED = ["1-URGENT", "2-HIGH", "3-MEDIUM"]


def order_time() -> Column:
    """Times of day from the price; cheap orders have none."""
    minutes = (F.floor("o_totalprice") % 1440).cast("int")
    clock = F.concat_ws(
        ":",
        F.lpad(F.floor(minutes / 60).cast("string"), 2, "0"),
        F.lpad((minutes % 60).cast("string"), 2, "0"),
        F.lit("00"),
    )
    return F.when(F.col("o_totalprice") < 50000, vocab.NO_TIME).otherwise(clock)


def case_of_order() -> Column:
    """Some orders belong to the late cases."""
    late = F.col("o_custkey") < 100
    return F.when(late, F.col("o_custkey") + 100000).otherwise(F.col("o_custkey"))


def procedure_sources(t: Tables) -> tuple[DataFrame, DataFrame]:
    code = F.when(F.col("o_orderpriority").isin(*CODED), vocab.PROCEDURE_CODE).otherwise("3-200")
    cells = [case_of_order(), F.date_format("o_orderdate", "yyyy-MM-dd"), order_time(), code]

    def source(status: list[str], names: list[str]) -> DataFrame:
        rows = t.orders.where(F.col("o_orderstatus").isin(*status))
        return rows.select(*[c.alias(n) for c, n in zip(cells, names)])

    first = source(["F", "O"], ["Fall", "OP-Code Beg.", "BegZeit", "OP-Code"])
    late = source(["P", "O"], ["Fallnummer", "Prozedurdatum", "Prozedurzeit", "PrzCode"])
    return first, late


PROC_SQL = f"""
o AS (SELECT *, CASE WHEN o_custkey < 100 THEN o_custkey + 100000 ELSE o_custkey END AS "Fallnummer",
             strftime(o_orderdate, '%Y-%m-%d') AS prozedur_datum, floor(o_totalprice)::BIGINT % 1440 AS mins FROM orders),
p AS (SELECT DISTINCT "Fallnummer", prozedur_datum,
             nullif(CASE WHEN o_totalprice < 50000 THEN '00:00:00'
                    ELSE lpad((mins // 60)::VARCHAR, 2, '0') || ':' || lpad((mins % 60)::VARCHAR, 2, '0') || ':00' END, '00:00:00') AS prozedur_zeit
      FROM o WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM'))"""


def report_source(t: Tables) -> DataFrame:
    """A report per order, a second version of the expensive ones, exact copies of some others."""
    day, late_day = F.date_format("o_orderdate", "dd.MM.yyyy"), F.date_add("o_orderdate", 2)
    price = F.col("o_totalprice")
    number = F.concat(F.col("o_orderkey").cast("string"), F.lit("/15"))
    header = F.concat(
        F.lit("Klinik\r\n\n"), day, F.lit(" ------ RAD -----  Arztbrief  -----  "), number, F.lit("  -----\nText")
    )
    plain = F.concat_ws("\n", F.lit("  "), "o_orderstatus", F.lit(""), "o_orderpriority", F.lit("x"), F.lit("y"), day)
    german = "dd.MM.yyyy HH:mm:ss"
    first = t.orders.select(
        case_of_order().alias("FALNR"),
        F.col("o_orderkey").alias("DOKNR"),
        F.when(price < 200000, plain).otherwise(header).alias("CONTENT"),
        F.when(F.col("o_orderstatus") == "P", "01.01.1900 00:00:00")
        .when(price > 499000, "unbekannt")
        .otherwise(F.date_format("o_orderdate", german))
        .alias("ZBEFALL04D"),
        F.date_format("o_orderdate", german).alias("DODAT"),
        F.date_format(late_day, german).alias("ERDAT"),
        "o_totalprice",
    )
    again = first.where("o_totalprice > 300000").withColumn("DOKNR", F.col("DOKNR") + 10000000)
    copies = first.where("o_totalprice BETWEEN 150000 AND 250000")
    return first.unionByName(again).unionByName(copies).drop("o_totalprice")


REPORT_SQL = """
r0 AS (SELECT "Fallnummer", o_orderkey AS "DOKNR",
       CASE WHEN o_totalprice > 499000 AND o_orderstatus <> 'P' THEN NULL ELSE prozedur_datum END AS prozedur_datum,
       CASE WHEN o_totalprice >= 200000 THEN o_orderkey || '/15' END AS befund_nummer,
       CASE WHEN o_totalprice < 200000 THEN o_orderstatus || o_orderpriority || 'xy' END AS "CONTENT_head",
       CASE WHEN o_totalprice < 200000 THEN o_orderdate + INTERVAL 2 DAY ELSE o_orderdate END AS befund_datum, o_totalprice FROM o),
r1 AS (SELECT * FROM r0 UNION ALL SELECT * REPLACE ("DOKNR" + 10000000 AS "DOKNR") FROM r0 WHERE o_totalprice > 300000
       UNION ALL SELECT * FROM r0 WHERE o_totalprice BETWEEN 150000 AND 250000),
r2 AS (SELECT * EXCLUDE (o_totalprice) FROM r1 QUALIFY row_number() OVER (
         PARTITION BY "Fallnummer", prozedur_datum, befund_nummer, "CONTENT_head"
         ORDER BY befund_datum DESC NULLS LAST, "DOKNR" DESC) = 1),
r AS (SELECT * FROM r2 QUALIFY count(*) OVER (PARTITION BY "Fallnummer", prozedur_datum) = 1)"""

JOINED_SQL = """
timed AS (SELECT "Fallnummer", prozedur_datum, CASE WHEN count(*) = 1 THEN max(prozedur_zeit) END AS prozedur_zeit,
                 count(prozedur_zeit) AS num_start_times FROM p GROUP BY ALL HAVING count(prozedur_zeit) = 1),
j AS (SELECT r.*, timed.prozedur_zeit, timed.num_start_times FROM r JOIN timed
      ON timed."Fallnummer" = r."Fallnummer" AND timed.prozedur_datum IS NOT DISTINCT FROM r.prozedur_datum)"""

REPORT_COLUMNS = ["Fallnummer", "DOKNR", "prozedur_datum", "befund_nummer", "CONTENT_head", "befund_datum"]


@query(f"WITH {MASTER_SQL} SELECT * FROM master")
def inpatient_master_data(t: Tables) -> DataFrame:
    rows = cohort.inpatients(*master_sources(t))
    return rows.withColumn("geburtsdatum", col("geburtsdatum").cast("timestamp_ntz"))


@query(f"WITH {MASTER_SQL} SELECT count(DISTINCT \"Patientennummer\") AS n_patients FROM master")
def patient_count(t: Tables) -> DataFrame:
    return distinct_counts(cohort.inpatients(*master_sources(t)), [], "Patientennummer", "n_patients")


@query(f"WITH {PROC_SQL} SELECT * FROM p")
def distinct_procedures(t: Tables) -> DataFrame:
    return cohort.procedures(*procedure_sources(t))


@query(f"""WITH {PROC_SQL}
SELECT (SELECT sum(CASE WHEN o_orderstatus = 'O' THEN 2 ELSE 1 END)::BIGINT FROM o
        WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')) AS n_procedures,
       (SELECT count(*) FROM p) AS n_distinct, (SELECT count(DISTINCT "Fallnummer") FROM o) AS n_cases""")
def procedure_counts(t: Tables) -> DataFrame:
    return cohort.procedure_counts(*procedure_sources(t))


@query(f"""WITH {PROC_SQL}, {REPORT_SQL} SELECT {", ".join(f'"{c}"' for c in REPORT_COLUMNS)} FROM r""")
def unique_reports(t: Tables) -> DataFrame:
    return naive(cohort.usable_reports(report_source(t)).select(*REPORT_COLUMNS))


@query(f"""WITH {PROC_SQL}, {REPORT_SQL}
SELECT count(*) AS n_reports, count(*) FILTER (prozedur_datum IS NULL) AS n_no_day FROM r1""")
def unusable_report_count(t: Tables) -> DataFrame:
    return cohort.unusable_reports(cohort.parsed_reports(report_source(t)))


@query(f"""WITH {PROC_SQL}, {REPORT_SQL}, {JOINED_SQL}
SELECT {", ".join(f'"{c}"' for c in REPORT_COLUMNS)}, prozedur_zeit, num_start_times FROM j""")
def reports_with_procedure(t: Tables) -> DataFrame:
    choice = cohort.report_choice(report_source(t))
    joined = cohort.reports_with_procedure(
        cohort.usable_reports(report_source(t), choice),
        cohort.procedures(*procedure_sources(t)),
        keys=choice,
    )
    return naive(joined.select(*REPORT_COLUMNS, "prozedur_zeit", "num_start_times"))


@query(f"""WITH {PROC_SQL}, {REPORT_SQL}, {JOINED_SQL}, {MASTER_SQL},
a AS (SELECT j.*, master.* EXCLUDE ("Fallnummer", alter_bei_prozedur, geburtsdatum), strptime(prozedur_datum || prozedur_zeit, '%Y-%m-%d%H:%M:%S') AS prozedur_datetime,
             coalesce(alter_bei_prozedur, round_even(date_diff('day', geburtsdatum, strptime(prozedur_datum || prozedur_zeit, '%Y-%m-%d%H:%M:%S'))
                      / CAST(365.25 AS DOUBLE), 0)::BIGINT) AS age
      FROM j JOIN master ON master."Fallnummer" = j."Fallnummer")
SELECT "Fallnummer", "DOKNR", "Patientennummer", geschlecht, prozedur_datetime, age AS alter_bei_prozedur,
       ceil(age / 10)::BIGINT AS altersdekade_bei_prozedur FROM a WHERE age >= 18""")
def cohort_for_labelling(t: Tables) -> DataFrame:
    choice = cohort.report_choice(report_source(t))
    rows = cohort.procedures_for_labelling(
        cohort.usable_reports(report_source(t), choice),
        cohort.procedures(*procedure_sources(t)),
        cohort.inpatients(*master_sources(t)),
        keys=choice,
    )
    return naive(
        rows.select(
            *ANCHOR,
            "DOKNR",
            "Patientennummer",
            "geschlecht",
            "alter_bei_prozedur",
            "altersdekade_bei_prozedur",
        )
    )
