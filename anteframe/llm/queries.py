"""The operators as queries over their whole tables, and the SQL that must give the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, embedding_dedup, hard_negatives, langid, lm, merkle, minhash, packing, quality, rule_forest, suffix_dedup, token_output, toxicity
from ._sample import held_out
from ._store import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op3_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"), words=4, percent=80)


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op3_minhash_dedup"] = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
             ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS shingle FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM shared JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * common >= 80 * (p.n + q.n - common)),
reach AS (SELECT doc_id, doc_id AS root FROM documents UNION SELECT link.b, root FROM reach JOIN link ON link.a = reach.doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, min(root) AS component_id, doc_id = min(root) AS kept
FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id, n"""


@query
def op1_quality_knn(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality.fit(docs, table(spark, folder, "labels"))
    return quality.scored(docs, model, threshold=0.3).withColumn("held_out", held_out())


@query
def op2_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.digest(decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark")))


@query
def op4_language_ecoc(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return langid.predicted(docs, langid.fit(docs)).withColumn("held_out", held_out())


_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES["op2_winnowing"] = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, least(len(w), 10) AS k,
       unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2), lambda i: array_to_string(w[i:i + least(len(w), 10) - 1], ' '))) AS win
       FROM b WHERE len(w) > 0),
dw AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k),
hits AS (SELECT doc_id, item, p, dw.k FROM dw JOIN bw ON dw.k = bw.k AND array_to_string(w[p:p + dw.k - 1], ' ') = win),
n AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM hits) GROUP BY doc_id),
i AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN i USING (doc_id)"""


@query
def op8_toxicity_trees(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    return toxicity.scored(docs, model, threshold=0.5).withColumn("held_out", held_out())


@query
def op5_bin_completion(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"))


@query
def op10_training_order(spark: SparkSession, folder: str) -> DataFrame:
    found = token_output.shards(table(spark, folder, "documents"))
    path = f"{shared_folder(spark)}/shards-{uuid.uuid4().hex}"
    return token_output.records(token_output.write(found, path))


@query
def op9_pca_tiles(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, folder, "embeddings"))


ORACLES["op9_pca_tiles"] = """
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings
                     WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
u AS (SELECT vec_id, x, sqrt(list_dot_product(x, x)) AS norm FROM v WHERE len(x) > 0 AND list_dot_product(x, x) > 0),
link AS (SELECT p.vec_id AS a, q.vec_id AS b FROM u p JOIN u q ON p.vec_id <> q.vec_id AND len(p.x) = len(q.x)
         WHERE list_dot_product(p.x, q.x) / (p.norm * q.norm) >= 0.95),
reach AS (SELECT vec_id, vec_id AS root FROM embeddings UNION SELECT link.b, root FROM reach JOIN link ON link.a = reach.vec_id),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, min(root) AS component_id, vec_id = min(root) AS kept
FROM reach LEFT JOIN n USING (vec_id) GROUP BY vec_id, n_links"""


@query
def op6_suffix_runs(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.deduplicated(table(spark, folder, "documents")))


ORACLES["op6_suffix_runs"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS bytes FROM documents),
b AS (SELECT doc_id, unnest(range(0, len(bytes) // 2 - 99, 200)) AS low, bytes FROM d),
c AS (SELECT doc_id, low, substr(bytes, 2 * low + 1, 598) AS part FROM b),
w AS (SELECT doc_id, low, unnest(range(len(part) // 2 - 99)) AS i, part FROM c),
h AS (SELECT doc_id, low + i AS p, row_number() OVER (PARTITION BY substr(part, 2 * i + 1, 200) ORDER BY doc_id, low + i) > 1 AS again FROM w),
r AS (SELECT doc_id, p, coalesce(p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) > 100, true) AS head FROM h WHERE again),
g AS (SELECT doc_id, p, sum(head::INT) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM r),
spans AS (SELECT doc_id, min(p) AS start, max(p) + 100 AS stop FROM g GROUP BY doc_id, run),
t AS (SELECT doc_id, start, stop, lag(stop, 1, 0) OVER (PARTITION BY doc_id ORDER BY start) AS since FROM spans),
k AS (SELECT doc_id, count(*) AS n_spans, sum(stop - start) AS n_removed, max(stop) AS stop,
             string_agg(substr(bytes, 2 * since + 1, 2 * (start - since)), '' ORDER BY start) AS head
      FROM t JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, len(bytes) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(bytes, 2 * coalesce(stop, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)"""


@query
def op7_recurrent_lm(spark: SparkSession, folder: str) -> DataFrame:
    return lm.scored(table(spark, folder, "documents"))


@query
def op11_rule_forest(spark: SparkSession, folder: str) -> DataFrame:
    return rule_forest.judged(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest(table(spark, folder, "documents"))


def _merkle_sql(levels: int = 8) -> str:
    """Level by level; more levels than a tree has leave it as it is. ``levels``: up to 16 ** levels leaves."""
    cell = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR) || ':' || {0}::VARCHAR END".format
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(map(cell, ('doc_id', 'source', 'lang', 'n_chars', text)))})"

    bits = "flatten(list_transform(str_split(doc_id::VARCHAR, ''), lambda c: list_transform(range(8), lambda i: (ascii(c)::BIGINT >> i) & 1)))"
    crc = f"xor(list_reduce(list_prepend(4294967295, {bits}), lambda a, b: xor(a >> 1, CASE WHEN xor(a, b) & 1 = 1 THEN 3988292384 ELSE 0 END)), 4294967295)"
    steps = [
        f"""d AS (SELECT *, {leaf('text')} AS leaf, CASE WHEN {crc} % 5 = 0 THEN {leaf(lower)} ELSE {leaf('text')} END AS changed FROM documents)""",
        """a0 AS (SELECT source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY source) AS n, leaf AS h FROM d)""",
        """f0 AS (SELECT doc_id, leaf, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, changed AS fold, '' AS proof FROM d)""",
    ]

    def climb(a: str, f: str, levels: int) -> None:
        for k in range(levels):
            steps.append(f"""{a}{k + 1} AS (SELECT source, i // CASE WHEN n > 1 THEN 16 ELSE 1 END AS i, max((n + CASE WHEN n > 1 THEN 15 ELSE 0 END) // CASE WHEN n > 1 THEN 16 ELSE 1 END) AS n,
                CASE WHEN max(n) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE max(h) END AS h, list(h ORDER BY i) AS run, max(n) AS below
                FROM {a}{k} GROUP BY 1, {a}{k}.i // CASE WHEN n > 1 THEN 16 ELSE 1 END)""")
            steps.append(f"""{f}{k + 1} AS (SELECT doc_id, leaf, f.source, a.i,
                CASE WHEN below = 1 THEN fold ELSE sha256(array_to_string(run[:f.i % 16], '') || fold || array_to_string(run[f.i % 16 + 2:], '')) END AS fold,
                CASE WHEN below = 1 THEN proof ELSE proof || array_to_string(run[:f.i % 16], '') || array_to_string(run[f.i % 16 + 2:], '') END AS proof
                FROM {f}{k} f JOIN {a}{k + 1} a ON f.source IS NOT DISTINCT FROM a.source AND a.i = CASE WHEN below = 1 THEN f.i ELSE f.i // 16 END)""")

    climb("a", "f", levels)
    steps.append(f"s AS (SELECT source AS name, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i FROM a{levels})")
    steps.append("b0 AS (SELECT NULL::VARCHAR AS source, i, count(*) OVER () AS n, subroot AS h FROM s)")
    steps.append(f"g0 AS (SELECT {{'id': doc_id, 'subroot': subroot}} AS doc_id, leaf, NULL::VARCHAR AS source, s.i, fold, proof FROM f{levels} f JOIN s ON f.source IS NOT DISTINCT FROM s.name)")
    climb("b", "g", levels)
    return f"""WITH {', '.join(steps)}
SELECT doc_id.id AS doc_id, leaf, doc_id.subroot AS subroot, h AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = h AS verified
FROM g{levels}, (SELECT h FROM b{levels})"""


ORACLES["op12_merkle_manifest"] = _merkle_sql()


@query
def op13_range_tree_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.mined(table(spark, folder, "embeddings"))


ORACLES["op13_range_tree_negatives"] = """
WITH v AS (SELECT vec_id::BIGINT AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS x
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS anchor, b.id AS id, a.label = b.label AS same, list_dot_product(a.x, b.x)::BIGINT AS score
      FROM v a JOIN v b ON a.id % 100 = 0 AND a.id <> b.id),
p AS (SELECT anchor, id AS positive, score AS top FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5)
SELECT anchor AS anchor_id, positive AS positive_id, (row_number() OVER (PARTITION BY anchor, positive ORDER BY score DESC, id))::INT AS rank,
       id AS negative_id, top AS positive_score, score AS negative_score
FROM p JOIN s USING (anchor) WHERE NOT same AND 80 * top <= 100 * score AND score <= top
QUALIFY rank <= 5"""
