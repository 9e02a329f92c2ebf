"""Numbers, reference ranges, times and ages out of text columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anteframe import vocab
from anteframe.functions import codes, numbers, ranges, times
from anteframe.plans import labs, profiles

from .registry import Tables, query

MESSY_SQL = """CASE event_type WHEN 'click' THEN replace(value::VARCHAR, '.', ',')
     WHEN 'view' THEN '<' || value::VARCHAR WHEN 'error' THEN '> ' || value::VARCHAR || ' '
     WHEN 'signup' THEN value::VARCHAR || 'd' ELSE value::VARCHAR || 'e1' END"""


def messy(t: Tables) -> DataFrame:
    """Event values as the kinds of text that sources hold."""
    v = F.col("value").cast("string")
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", F.translate(v, ".", ","))
        .when(kind == "view", F.concat(F.lit("<"), v))
        .when(kind == "error", F.concat(F.lit("> "), v, F.lit(" ")))
        .when(kind == "signup", F.concat(v, F.lit("d")))
        .otherwise(F.concat(v, F.lit("e1")))
    )
    return t.events.select("event_id", text.alias("v"))


DECIMAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


@query(f"""
WITH m AS (SELECT event_id, {MESSY_SQL} AS v FROM events),
c AS (SELECT *, trim(replace(replace(replace(v, ',', '.'), '<', ''), '>', '')) AS a, trim(replace(v, ',', '.')) AS b FROM m)
SELECT event_id, v, CASE WHEN regexp_matches(a, '{DECIMAL}') THEN try_cast(a AS DOUBLE) END AS number,
       CASE WHEN regexp_matches(b, '{DECIMAL}') THEN try_cast(b AS DOUBLE) END AS v_num
FROM c""")
def lenient_decimal(t: Tables) -> DataFrame:
    rows = messy(t).withColumn("number", numbers.lenient_decimal(F.col("v")))
    return numbers.add_numeric_columns(rows, ["v"])


def as_labs(t: Tables) -> DataFrame:
    """Parts in the shape of lab results with reference bounds as text."""
    kind = F.col("p_type")
    size = F.col("p_size").cast("string")
    upper = F.when(~kind.isin("SMALL", "PROMO"), (F.col("p_size") + 10).cast("string"))
    lower = F.when(kind.isin("SMALL", "ECONOMY", "LARGE"), F.when(F.col("p_size") == 7, "0").otherwise(size))
    return t.part.select(
        "p_partkey",
        F.translate(F.col("p_retailprice").cast("string"), ".", ",").alias("Ergebniswert"),
        lower.alias("Referenzwert unten"),
        upper.alias("Referenzwert oben"),
        kind.alias("Parameter-ID primär"),
        codes.blank_sentinel(F.col("p_brand"), "Brand#3").alias("LOINC-Code"),
        codes.blank_sentinel(F.col("p_name"), "red widget").alias("Parameterbezeichnung"),
    )


def definitions(t: Tables) -> DataFrame:
    """A category for every (type, brand) that occurs in the parts, but for one brand."""
    kind = F.col("p_type")
    category = (
        F.when(kind.isin("ECONOMY", "LARGE"), 0)
        .when(kind == "SMALL", 1)
        .when(kind.isin("MEDIUM", "STANDARD"), 2)
        .otherwise(3)
    )
    rows = t.part.where("p_brand <> 'Brand#9'").select(
        kind.alias("Parameter-ID primär"),
        codes.blank_sentinel(F.col("p_brand"), "Brand#3").alias("LOINC-Code"),
        category.alias("Kategorie"),
    )
    return rows.distinct()


LABS_SQL = """WITH l AS (
  SELECT p_partkey, p_size, p_retailprice AS e, nullif(p_brand, 'Brand#3') AS loinc, nullif(p_name, 'red widget') AS name, p_type,
         CASE WHEN p_type IN ('SMALL', 'ECONOMY', 'LARGE') THEN CASE WHEN p_size = 7 THEN 0 ELSE p_size END END AS lo_text,
         nullif(CASE WHEN p_type IN ('SMALL', 'ECONOMY', 'LARGE') AND p_size <> 7 THEN p_size::DOUBLE END, 0) AS lo,
         CASE WHEN p_type NOT IN ('SMALL', 'PROMO') THEN p_size + 10.0::DOUBLE END AS hi,
         CASE WHEN p_type IN ('ECONOMY', 'LARGE') THEN 0 WHEN p_type = 'SMALL' THEN 1
              WHEN p_type IN ('MEDIUM', 'STANDARD') THEN 2 ELSE 3 END AS cat
  FROM part WHERE p_brand <> 'Brand#9')"""


@query(f"""{LABS_SQL}
SELECT p_partkey, cat AS category, lo AS lower, hi AS upper,
       round(CASE cat WHEN 0 THEN (e - lo) / nullif(hi - lo, 0) WHEN 1 THEN e / nullif(lo, 0)
            WHEN 2 THEN e / nullif(hi, 0) ELSE e END, 6) AS normalised
FROM l""")
def range_normalise(t: Tables) -> DataFrame:
    rows = labs.with_normalised_values(profiles.with_range_numbers(as_labs(t)), definitions(t))
    return rows.select(
        "p_partkey",
        F.col("Kategorie").alias("category"),
        F.col("Referenzwert unten_num").alias("lower"),
        F.col("Referenzwert oben_num").alias("upper"),
        F.round("Ergebniswert_normalisiert", 6).alias("normalised"),
    )


FIT_SQL = """CASE p_size % 4 WHEN 0 THEN lo_text IS NOT NULL AND hi IS NOT NULL
 WHEN 1 THEN lo_text IS NOT NULL AND hi IS NULL WHEN 2 THEN lo_text IS NULL AND hi IS NOT NULL
 ELSE lo_text IS NULL AND hi IS NULL END"""


@query(f"""{LABS_SQL.replace(" WHERE p_brand <> 'Brand#9'", "")} SELECT p_partkey, {FIT_SQL} AS fits FROM l""")
def category_fit(t: Tables) -> DataFrame:
    rows = as_labs(t).join(t.part.select("p_partkey", "p_size"), "p_partkey")
    category = F.col("p_size") % 4
    lower, upper = F.col("Referenzwert unten"), F.col("Referenzwert oben")
    return rows.select("p_partkey", ranges.category_fits(category, lower, upper).alias("fits"))


@query(f"""{LABS_SQL}
SELECT p_partkey, cat AS category, e AS value FROM l
WHERE name IS NOT NULL AND e IS NOT NULL AND CASE cat WHEN 0 THEN lo_text IS NOT NULL AND hi IS NOT NULL
 WHEN 1 THEN lo_text IS NOT NULL AND hi IS NULL WHEN 2 THEN lo_text IS NULL AND hi IS NOT NULL
 ELSE lo_text IS NULL AND hi IS NULL END""")
def clean_ranges(t: Tables) -> DataFrame:
    rows, _ = profiles.clean_ranges(labs.with_definitions(as_labs(t), definitions(t)))
    return rows.select(
        "p_partkey", F.col("Kategorie").alias("category"), F.col("Ergebniswert_num").alias("value")
    )


@query(f"""{LABS_SQL}
SELECT count(*) AS n_before, count(*) FILTER (name IS NOT NULL) AS n_after,
       count(*) FILTER (name IS NULL) AS n_removed,
       round_even(count(*) FILTER (name IS NOT NULL)::DOUBLE * 100 / count(*), 1) AS percent_kept
FROM l""")
def clean_ranges_statistics(t: Tables) -> DataFrame:
    return profiles.clean_ranges(labs.with_definitions(as_labs(t), definitions(t)))[1]


@query("""
SELECT event_id, date_trunc('second', ts) - INTERVAL 1 HOUR AS plus_one, date_trunc('second', ts) + INTERVAL 150 MINUTE AS minus_two_and_half,
       date_trunc('second', ts) AS zulu, NULL::TIMESTAMP AS broken, NULL::TIMESTAMP AS no_offset,
       date_trunc('second', ts) - INTERVAL 1 HOUR + INTERVAL 250 MILLISECOND AS fraction
FROM events""")
def offset_timestamps(t: Tables) -> DataFrame:
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")

    def parsed(suffix: str, name: str, strict: bool = True) -> F.Column:
        utc = times.offset_timestamp(F.concat(text, F.lit(suffix)), strict=strict)
        return utc.cast("timestamp_ntz").alias(name)

    return t.events.select(
        "event_id",
        parsed("+0100", "plus_one"),
        parsed("-02:30", "minus_two_and_half"),
        parsed("Z", "zulu"),
        parsed(" Uhr", "broken", strict=False),
        parsed("", "no_offset", strict=False),
        parsed(".25+01:00", "fraction"),
    )


@query("""
SELECT event_id, date_trunc('second', ts) AS us, date_trunc('second', ts) AS iso, date_trunc('second', ts) AS german,
       date_trunc('day', ts) AS german_day, NULL::TIMESTAMP AS broken
FROM events""")
def clinic_timestamps(t: Tables) -> DataFrame:
    ts = F.col("ts")
    ntz = "timestamp_ntz"
    german = F.date_format(ts, "d.M.yyyy H:m:s")
    return t.events.select(
        "event_id",
        times.us_timestamp(F.date_format(ts, "M/d/yyyy"), F.date_format(ts, "hh:mm:ss a"))
        .cast(ntz)
        .alias("us"),
        times.iso_timestamp(F.date_format(ts, "yyyy-MM-dd"), F.date_format(ts, "HH:mm:ss"))
        .cast(ntz)
        .alias("iso"),
        times.german_timestamp(german).cast(ntz).alias("german"),
        times.german_date(F.date_format(ts, "dd.MM.yyyy")).cast(ntz).alias("german_day"),
        times.german_timestamp(F.concat(german, F.lit("h"))).cast(ntz).alias("broken"),
    )


CLOCK_SQL = """SELECT event_id, ts, event_type, CASE event_type
  WHEN 'click' THEN 'O-GLU_Z.' || lpad((CAST(json_extract_string(props, '$.k') AS INT) * 37 % 3000)::VARCHAR, 4, '0')
  WHEN 'view' THEN 'G-GLU_K' WHEN 'error' THEN 'O-K_Z' WHEN 'signup' THEN 'CL_S' ELSE 'GGT_S' END AS code FROM events"""


def coded(t: Tables) -> DataFrame:
    """Events with lab-like codes; those of clicks carry a clock time."""
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")
    code = (
        F.when(kind == "click", F.concat(F.lit("O-GLU_Z."), F.lpad((k * 37 % 3000).cast("string"), 4, "0")))
        .when(kind == "view", "G-GLU_K")
        .when(kind == "error", "O-K_Z")
        .when(kind == "signup", "CL_S")
        .otherwise("GGT_S")
    )
    return t.events.select("event_id", "ts", "event_type", code.alias("code"))


EFFECTIVE_SQL = r"""CASE WHEN regexp_matches(code, 'O-GLU_Z\.\d{4}')
  THEN date_trunc('day', ts) + to_hours(substr(split_part(code, '.', 2), 1, 2)::INT)
       + to_minutes(substr(split_part(code, '.', 2), 3, 2)::INT) ELSE ts END"""


@query(f"SELECT event_id, code, {EFFECTIVE_SQL} AS effective FROM ({CLOCK_SQL})")
def embedded_time(t: Tables) -> DataFrame:
    at = times.embedded_clock_time(F.col("code"), F.col("ts"), vocab.CLOCK_ID_PATTERN)
    return coded(t).select("event_id", "code", at.cast("timestamp_ntz").alias("effective"))


@query(f"""
SELECT event_id, code, CASE WHEN contains(code, 'GLU_') THEN 'x-GLU_x' WHEN code IN ('CL_S', 'O-CL_Z') THEN 'x-CL_x'
  WHEN code IN ('K_S', 'O-K_Z', 'K_H') THEN 'x-K_x' WHEN code IN ('NA_S', 'O-NA_Z') THEN 'x-NA_x' ELSE code END AS common
FROM ({CLOCK_SQL})""")
def code_harmonise(t: Tables) -> DataFrame:
    return coded(t).select("event_id", "code", codes.common_code(F.col("code")).alias("common"))


@query(f"""
SELECT CASE WHEN code LIKE 'O-GLU_Z.%' THEN 'O-GLU_Z.x' ELSE code END AS paramid,
       minute({EFFECTIVE_SQL}) % 15 = 0 AS is_quarter, count(*) AS n
FROM ({CLOCK_SQL}) WHERE contains(code, 'GLU_') GROUP BY ALL""")
def quarter_hour_audit(t: Tables) -> DataFrame:
    at = times.embedded_clock_time(F.col("code"), F.col("ts"), vocab.CLOCK_ID_PATTERN)
    return profiles.quarter_hour_audit(coded(t).withColumn("at", at), code="code", ts="at")


@query("""
WITH c AS (SELECT o_orderkey, o_orderdate AS seen, CASE WHEN o_orderpriority = '5-LOW' THEN 10 + o_custkey % 60 END AS age,
                  o_orderdate - to_days((o_custkey * 31 % 30000)::INT) AS birth FROM orders),
a AS (SELECT o_orderkey, coalesce(age, CAST(round_even(date_diff('day', birth, seen) / 365.25::DOUBLE, 0) AS BIGINT)) AS age FROM c)
SELECT o_orderkey, age, CAST(ceil(age / 10) AS BIGINT) AS decade FROM a WHERE age >= 18""")
def age_fill_half_even(t: Tables) -> DataFrame:
    at = F.col("o_orderdate")
    given = F.when(F.col("o_orderpriority") == "5-LOW", 10 + F.col("o_custkey") % 60)
    birth = F.date_sub(at, (F.col("o_custkey") * 31 % 30000).cast("int"))
    rows = t.orders.select("o_orderkey", times.age_in_years(given, birth, at).alias("age"))
    return rows.where("age >= 18").withColumn("decade", times.age_decade(F.col("age")))


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_orderdate - INTERVAL 3 DAY ELSE o_orderdate END AS day
FROM orders""")
def placeholder_date(t: Tables) -> DataFrame:
    entered = F.col("o_orderdate")
    planned = F.when(F.col("o_orderstatus") == "P", F.lit("1900-01-01").cast("timestamp_ntz")).otherwise(entered)
    day = times.date_unless_year(planned, entered - F.make_dt_interval(days=F.lit(3)), 1900)
    return t.orders.select("o_orderkey", day.alias("day"))


@query("""
SELECT event_id, user_id || '+' || strftime(ts, '%Y-%m-%d_%H:%M:%S') AS anchor FROM events""")
def anchor_keys(t: Tables) -> DataFrame:
    return t.events.select("event_id", times.anchor_key(F.col("user_id"), F.col("ts")).alias("anchor"))
