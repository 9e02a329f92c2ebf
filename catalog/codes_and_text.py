"""Prefix mapping of codes and identification of report texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anteframe.functions import codes
from anteframe.functions.text import report_head as head_of
from anteframe.operators import prefix
from anteframe.sources.delimited import NA_TOKENS, blank_na

from .registry import Tables, query


@query("""
WITH m AS (SELECT DISTINCT CASE WHEN length(p_brand) = 7 THEN replace(p_brand || '.x', '.x', '') ELSE p_brand END AS prefix,
                  length(p_brand)::INT * 10 + CAST(p_brand[-1] AS INT) AS grp
           FROM part WHERE length(p_brand) = 7 OR p_brand[-1] = '7')
SELECT p_partkey, p_brand, (SELECT max_by(grp, length(prefix)) FROM m WHERE starts_with(p_brand, prefix)) AS grp
FROM part""")
def longest_prefix_group(t: Tables) -> DataFrame:
    brand = F.col("p_brand")
    code = F.when(F.length(brand) == 7, F.concat(brand, F.lit(".x"))).otherwise(brand)
    mapping = t.part.where((F.length(brand) == 7) | brand.endswith("7")).select(
        codes.as_prefix(code).alias("prefix"),
        (F.length(brand) * 10 + F.substring(brand, -1, 1).cast("int")).alias("grp"),
    )
    return prefix.longest_prefix_group(
        t.part.select("p_partkey", "p_brand"),
        mapping.distinct(),
        code="p_brand",
        prefix="prefix",
        group="grp",
        out="grp",
    )


# Blanks, line breaks and the header line as the reports have them.
WS = r"[\t-\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NL = r"[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
HEADER = (
    rf"\p{{Nd}}{{2}}\.\p{{Nd}}{{2}}\.\p{{Nd}}{{4}}{WS}[-]+{WS}[A-Z0-9\-]{{3,6}}{WS}[-]+{WS}+"
    rf"[A-Za-z]{{5,12}}{WS}+[-]+{WS}+\p{{Nd}}{{1,9}}/\p{{Nd}}{{2}}{WS}+[-]+"
)


@query(f"""
WITH c AS (
  SELECT doc_id, CASE lang WHEN 'en' THEN text ELSE source || chr(10) || '0' || (1 + n_chars % 9)
           || '.08.2015 ------ RAD -----  Arztbrief  -----  ' || doc_id || '/15  --------' || chr(10) || text END AS content
  FROM documents),
l AS (SELECT doc_id, list_filter(regexp_split_to_array(content, '{NL}'),
                                 lambda x: regexp_replace(x, '{WS}', '', 'g') <> '') AS lines FROM c),
h AS (SELECT doc_id, lines, list_filter(lines, lambda x: regexp_matches(x, '{HEADER}'))[1] AS header FROM l),
p AS (SELECT doc_id, lines, header, string_split(regexp_replace(regexp_replace(header, '{WS}+-+{WS}*', ' ', 'g'),
                                 '^{WS}+|{WS}+$', '', 'g'), ' ') AS parts FROM h)
SELECT doc_id, CASE WHEN header IS NULL THEN array_to_string(lines[1:4], '') END AS head,
       parts[-1] AS number, parts[1] AS date FROM p""")
def report_head(t: Tables) -> DataFrame:
    header = F.concat(
        F.lit("\n0"),
        (1 + F.col("n_chars") % 9).cast("string"),
        F.lit(".08.2015 ------ RAD -----  Arztbrief  -----  "),
        F.col("doc_id").cast("string"),
        F.lit("/15  --------\n"),
    )
    content = F.when(F.col("lang") == "en", F.col("text")).otherwise(
        F.concat(F.col("source"), header, F.col("text"))
    )
    head = head_of(content)
    return t.documents.select("doc_id", head.alias("h")).select(
        "doc_id",
        F.col("h.head").alias("head"),
        F.col("h.number").alias("number"),
        F.col("h.date").alias("date"),
    )


@query("""
SELECT event_id, CASE WHEN event_id % 25 >= 19 THEN event_type END AS kind
FROM events""")
def na_tokens(t: Tables) -> DataFrame:
    token = F.get(F.array(*map(F.lit, NA_TOKENS)), (F.col("event_id") % 25).cast("int"))
    text = F.coalesce(token, F.col("event_type"))
    return t.events.select("event_id", blank_na(text).alias("kind"))
