"""Quality rules, Merkle manifest and hard negatives: against brute force, and rows of every odd kind."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from anteframe.llm import hard_negatives, merkle, rule_forest
from anteframe.llm.queries import QUERIES

# Labelled rows enough for a held-out share.
FOLDER = "/root/testdata/sf0.1"
UPPER = str.maketrans(merkle.UPPER, merkle.LOWER)


# Quality rules


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def strange_texts(n):
    rng = random.Random(5)
    parts = ["a", "bé", "漢", "A", "a#", "*", "||", " ", " ", "\n", "\n\n", "\t", "\r\n", "one two", "x" * 40, "🙂"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 60))) for _ in range(n)]


def test_counts_of_rules(spark, odd_docs):
    texts = [*strange_texts(400), "a b c\na b c\n", "\n", "a b c a b c a b", "q\nq", " q\nq"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in rule_forest.measured(docs.coalesce(1)).collect()}
    assert all(tuple(rows[i][c] for c in rule_forest.COUNTS) == plain_counts(t) for i, t in enumerate(texts))
    want = Counter((r.doc_id, *plain_counts(r.text)) for r in odd_docs.select("doc_id", "text").collect())
    got = rule_forest.measured(odd_docs).select("doc_id", *rule_forest.COUNTS).collect()
    assert Counter(map(tuple, got)) == want


def test_path_lengths():
    rng = np.random.default_rng(0)
    rows = np.vstack((rng.normal(size=(600, 4)), [[9, 9, 9, 9]]))
    forest = rule_forest.Forest(rows, trees=30, each=64)

    def length(t, row):
        node = 0
        while forest.feature[t, node] >= 0:
            node = 2 * node + 1 + int(row[forest.feature[t, node]] > forest.cut[t, node])
        return forest.path[t, node]

    want = [2 ** (-np.mean([length(t, r) for t in range(30)]) / forest.norm) for r in rows]
    assert np.allclose(forest.score(rows), want)
    assert forest.score(rows).argmax() == 600
    assert rule_forest._rest(256) == pytest.approx(10.24, abs=0.01)


def test_rules_of_held_out_documents(spark):
    got = QUERIES["op11_rule_forest"](spark, FOLDER).toPandas()
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").toPandas()
    texts = spark.read.parquet(f"{FOLDER}/documents.parquet").toPandas().set_index("doc_id").text
    assert all(tuple(r[c] for c in rule_forest.COUNTS) == plain_counts(texts[r.doc_id]) for _, r in got.iterrows())
    failed = (got.n_words < 50) | (100 * got.n_repeat_words > 50 * got.n_words)
    assert (failed == got.base_failed).all() and not got[failed].kept.any()
    rows = got[~got.base_failed].merge(labels, on="doc_id")
    held = rows.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)
    assert rows[held & (rows.quality == 1)].kept.mean() > 0.95
    assert rows[held & (rows.quality == 0)].kept.mean() < 0.2


def test_rules_on_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (10, 0, 0), (10, 1, 0), (11, 0, 0), (None, 0, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    got = rule_forest.judged(odd_docs, labels).toPandas()
    assert len(got) == odd_docs.count() and not got[got.doc_id.isin([4, 5, 6, 7, 11])].kept.any()
    assert got[got.doc_id == 1].score.nunique() == 1 and (got.doc_id == 1).sum() == 2
    assert rule_forest.judged(no_docs, labels).count() == 0
    # One label only: nothing is rejected by its score.
    alike = rule_forest.judged(odd_docs, labels.where("quality = 1")).toPandas()
    assert (alike.kept == ~alike.base_failed).all()
    kept = rule_forest.accepted(odd_docs, labels.limit(0))
    assert kept.columns == odd_docs.columns and kept.where("doc_id IS NULL").count() == 1


# Merkle manifest


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def cell(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climbed(nodes):
    """The root, and for each node the (left, right) of its way."""
    ways = [[] for _ in nodes]
    below = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, holds = [], []
        for s in range(0, len(nodes), 16):
            run = nodes[s : s + 16]
            for k in range(len(run)):
                for i in below[s + k]:
                    ways[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            up.append(digest("".join(run)))
            holds.append([i for b in below[s : s + 16] for i in b])
        nodes, below = up, holds
    return nodes[0], ways


def plain_manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""

    def leaf(r, text):
        return digest("".join(map(cell, (*r[:4], text))))

    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    own = {s: sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4]))) for s in sources}
    trees = {s: climbed([leaf(r, r[4]) for r in own[s]]) for s in sources}
    root, above = climbed([trees[s][0] for s in sources])
    out = []
    for s, top in zip(sources, above, strict=True):
        for r, way in zip(own[s], trees[s][1], strict=True):
            touched = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None
            fold = leaf(r, r[4].translate(UPPER) if touched else r[4])
            for left, right in way + top:
                fold = digest(left + fold + right)
            proof = digest("".join(a + b for a, b in way + top))
            out.append((r[0], leaf(r, r[4]), trees[s][0], root, proof, fold, fold == root))
    return Counter(out)


def test_places_in_postorder():
    def visit(level, number, leaves, out):
        if level:
            many = -(-leaves // merkle.FAN ** (level - 1))
            for child in range(number * merkle.FAN, min(number * merkle.FAN + merkle.FAN, many)):
                visit(level - 1, child, leaves, out)
        out.append((level, number))
        return out

    for leaves in (1, 2, 15, 16, 17, 255, 256, 257, 273, 4096, 4097, 5000):
        for at, (level, number) in enumerate(visit(merkle.height(leaves), 0, leaves, [])):
            assert merkle.place(level, number, leaves) == at


@pytest.mark.parametrize("kind", ["one hot source", "many sources", "odd"])
def test_manifest(spark, odd_docs, kind):
    rng = random.Random(2)
    if kind == "odd":
        docs = odd_docs
    else:
        n = 9000 if kind == "one hot source" else 4500
        source = (lambda i: "hot" if i % 9 else rng.choice([None, "", "é", "z", f"s{i % 40}"])) if n == 9000 else (lambda i: f"s{i}")
        rows = [(i * 3 - 50, source(i), rng.choice(["en", None]), i, rng.choice([None, "", f"Text {i}", "lower", "ÄÖ A"])) for i in range(n)]
        rng.shuffle(rows)
        docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert Counter(map(tuple, merkle.manifest(docs).collect())) == plain_manifest(rows)


def test_log_is_the_postorder_of_each_tree(spark):
    leaves = spark.range(5000).select(F.lit(7).cast("long").alias("tree"), F.lit(5000).cast("long").alias("leaves"), F.col("id").alias("number"), F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    log = [r for tier in merkle.log_of(leaves) for r in tier.collect()]
    assert sorted(r.at for r in log) == list(range(5000 + 313 + 20 + 2 + 1))
    assert max(log, key=lambda r: r.at).digest == climbed([digest(str(i)) for i in range(5000)])[0]


def test_manifest_of_nothing(no_docs):
    got = merkle.manifest(no_docs)
    assert got.count() == 0 and got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


# Hard negatives


def plain_negatives(rows):
    known = {}
    for i, x, label in rows:
        if i is None or x is None or label is None or any(v is None or not np.isfinite(v) for v in x):
            continue
        label = int(np.fmod(label + 1, 10)) if i % 7 == 0 else label
        cells = (label, [int(np.floor(256 * float(v))) for v in x])
        known[i] = min(known.get(i, cells), cells)
    score = {a: {b: sum(p * q for p, q in zip(known[a][1], known[b][1])) for b in known if b != a} for a in known if a % 100 == 0}
    out = []
    for a, own in score.items():
        same = sorted((i for i in own if known[i][0] == known[a][0]), key=lambda i: (-own[i], i))[:5]
        other = sorted((i for i in own if known[i][0] != known[a][0]), key=lambda i: (-own[i], i))
        for p in same:
            window = [i for i in other if 80 * own[p] <= 100 * own[i] <= 100 * own[p]][:5]
            out += [(a, p, n + 1, i, own[p], own[i]) for n, i in enumerate(window)]
    return sorted(out)


def vectors(kind):
    rng = np.random.default_rng(4)
    if kind == "groups":
        centre = rng.normal(size=(40, 12))
        return [(i - 300, (centre[i % 40] + rng.normal(size=12) * 0.3).tolist(), int(rng.integers(0, 6))) for i in range(3000)]
    if kind == "copies":  # more than a block of them
        return [(i, [0.5, 0.25, -1.0] if i % 3 else rng.normal(size=3).tolist(), i % 4) for i in range(7000)]
    if kind == "large":  # scores beyond what doubles hold exactly
        return [(i * 20, (rng.normal(size=5) * 3e5).tolist(), i % 3) for i in range(400)]
    rows = [(i, rng.normal(size=4).round(1).tolist(), i % 2) for i in range(-60, 240)]
    rows += rows[:40] + [(5, None, 1), (6, [1.0, None, 0.0, 0.0], 1), (7, [float("nan"), 0.0, 0.0, 0.0], 1), (8, [float("inf")] * 4, 0), (9, [1.0] * 4, None)]
    return rows + [(None, [1.0] * 4, 1), (300, [1.0], 1), (301, [], 0), (302, [1.0] * 9, 1), (400, [0.0] * 4, 1), (14, [3.0] * 4, 1), (14, [3.0] * 4, 0), (500, [1e300] * 4, 0)]


@pytest.mark.parametrize("kind", ["groups", "copies", "large", "odd"])
def test_hard_negatives(spark, kind):
    rows = vectors(kind)
    df = spark.createDataFrame([(*r, "x", "x") for r in rows], "vec_id long, embedding array<double>, label int, leaf string, score string").repartition(4)
    got = sorted(map(tuple, hard_negatives.mined(df).collect()))
    want = plain_negatives([r for r in rows if not (r[1] and r[1][0] == 1e300)])
    assert want and got == want


def test_no_vectors_no_negatives(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.mined(none).count() == 0


def test_ranges_leave_out_what_cannot_matter():
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(size=(200, 8)) * 5 + c for c in rng.normal(size=(12, 8)) * 400]).astype(np.int64)
    tree = hard_negatives.grow(x, len(x), float((x.astype(float) ** 2).sum(1).max()), 8)
    _, _, away, child = next(tree.route(x))
    asks = hard_negatives.Asks(np.array([[0, 0, 0, 0, 1, (x[0] @ x[1]), (x[0] @ x[0]), 0]], np.int64), x[:1])
    met = 0
    for c in np.unique(child):
        own = away[child == c]
        meets = asks.meets(tree, tree.away(asks.x, asks.square, 0.0, (0, 0)), own.min(0), own.max(0))[0]
        score = x[child == c] @ x[0]
        assert meets or not ((score >= asks.fields[0, 5]) & (score <= asks.fields[0, 6])).any()
        met += meets
    assert 0 < met < len(np.unique(child)) / 2
