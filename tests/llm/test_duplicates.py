"""Near duplicates, repeated passages, near vectors: against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from anteframe.llm import _graph, embedding_dedup, minhash, suffix_dedup
from anteframe.llm.queries import QUERIES


def roots(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute_near(texts, k, percent=80):
    sets = {i: shingles(t, k) for i, t in texts.items()}
    ids = sorted(sets)
    links = []
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                links.append((a, b))
    found = roots(ids, links)
    return {i: (len(sets[i]), found[i], found[i] == i) for i in ids}


def family(seed, base=40, copies=12, words=90, edits=6):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    texts, n = {}, 0
    for _ in range(base):
        first = rng.choices(vocabulary, k=rng.randint(1, words))
        for _ in range(rng.choice([1, 1, 2, copies])):
            own = list(first)
            for _ in range(rng.randint(0, edits)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            texts[n * 7] = rng.choice([" ", "\n"]).join(own)
            n += 1
    return texts


@pytest.mark.parametrize("block", [512, 8])
def test_near_duplicates(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    texts = family(1)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs, words=4).collect()}
    assert got == brute_near(texts, 4)


def test_second_pass_links_what_hubs_do_not(spark):
    # A chain: neighbours are similar, no member is similar to most others.
    words = [f"c{i}" for i in range(400)]
    texts = {i: " ".join(words[i * 5 : i * 5 + 100]) for i in range(40)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs, words=4).collect()}
    assert got == brute_near(texts, 4)
    assert {c for _, c, _ in got.values()} == {0}


def test_a_value_that_many_share_is_parted_by_the_next(spark, monkeypatch):
    # All hold the same opening; families differ in the rest, and no component covers a posting.
    rng = random.Random(4)
    opening = " ".join(f"o{i}" for i in range(60))
    texts, n = {}, 0
    for f in range(12):
        first = [f"f{f}x{i}" for i in range(40)]
        for _ in range(5):
            own = list(first)
            own[rng.randrange(40)] = "changed"
            texts[n * 3] = opening + " " + " ".join(own)
            n += 1
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    monkeypatch.setattr(minhash, "BLOCK", 4)
    monkeypatch.setattr(minhash, "PARTED", 4)
    monkeypatch.setattr(minhash, "CELL", 300)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs, words=4).collect()}
    assert got == brute_near(texts, 4)
    suspects = spark.createDataFrame(
        [(i, [5], [5, 7 + i % 2]) for i in range(10)], "id long, prefix array<long>, longer array<long>"
    )
    none = spark.createDataFrame([], "id long, component_id long")
    rows = minhash.open_postings(suspects, none).collect()
    assert {(r.token, r.second, r["size"]) for r in rows} == {(5, 7, 5), (5, 8, 5)}


def test_cells_are_bounded_and_hold_every_pair():
    n = [100] * 50
    pairs = [(x, y) for x in range(50) for y in range(x + 1, 50)]
    cells = list(minhash.in_cells(pairs, n))
    assert sorted((x, y) for c in cells for x, others in c.items() for y in others) == pairs
    assert minhash.CELL >= max(sum(n[x] for x in c) for c in cells)
    huge = list(minhash.in_cells([(0, 1), (1, 2)], [minhash.CELL] * 3))
    assert [sorted(c) for c in huge] == [[0, 1], [1, 2]]


def test_near_duplicates_of_odd_rows(odd_docs, no_docs):
    got = minhash.near_duplicates(odd_docs, words=4).toPandas()
    assert len(got) == odd_docs.count()
    by = got.dropna(subset=["doc_id"]).drop_duplicates().set_index("doc_id")
    assert by.index.is_unique
    assert by.component_id[[1, 2, 3]].tolist() == [1, 1, 1] and by.component_id[8] == 7
    assert by.n_shingles[[4, 5, 6]].tolist() == [0, 0, 0] and by.kept[[4, 5, 6]].all()
    none = got[got.doc_id.isna()]
    assert len(none) == 2 and none.kept.all() and none.component_id.isna().all()
    assert minhash.near_duplicates(no_docs).count() == 0
    kept = minhash.one_of_each(odd_docs, words=4)
    assert kept.columns == odd_docs.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == [1, 4, 5, 6, 7, 9, 10, 11, 12, 13]
    with pytest.raises(ValueError):
        minhash.near_duplicates(odd_docs, percent=60)


def test_components_of_long_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1100)] + [(5000, 5000)]
    got = {r.id: r.component_id for r in _graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 1000 for i in range(1000, 1100)}
    assert _graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_repeats(texts, span=100):
    seen, out = set(), {}
    for i in sorted(texts):
        raw = (texts[i] or "").encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - span + 1):
            s = raw[p : p + span]
            if s in seen:
                gone[p : p + span] = True
            seen.add(s)
        runs = int((gone & ~np.concatenate(([False], gone[:-1]))).sum()) if len(raw) else 0
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        out[i] = (len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


def passages(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeéß ", k=rng.randint(2, 9)))
    shared = ["".join(word() for _ in range(rng.randint(10, 60))) for _ in range(6)]
    texts = {}
    for i in range(n):
        parts = ["".join(word() for _ in range(rng.randint(0, 40)))]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randint(0, len(s) // 2)
            parts += [s[a : a + rng.randint(50, len(s))], word()]
        texts[i * 3] = "".join(parts)
    texts[n * 3] = "x" * 700
    texts[n * 3 + 1] = texts[3] + texts[6] + texts[3]
    return texts


@pytest.mark.parametrize(("size", "part"), [(60_000, 1 << 20), (40, 1 << 20), (40, 300)])
def test_repeated_passages(spark, monkeypatch, size, part):
    # Small ranges: groups reach their edges and go through the second round.
    monkeypatch.setattr(suffix_dedup, "RANGE", size)
    monkeypatch.setattr(suffix_dedup, "PART", part)
    texts = passages(size)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.digest(suffix_dedup.deduplicated(docs)).collect()}
    assert got == brute_repeats(texts)


def test_a_hot_gram_spreads_over_ranges(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "RANGE", 1280)
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz "
    passage = "".join(rng.choices(letters, k=110))
    texts = {i: "".join(rng.choices(letters, k=90)) + passage + "".join(rng.choices(letters, k=90)) for i in range(6000)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    t = suffix_dedup.Texts(pa.record_batch([pa.array([*texts.values()])], ["text"]), suffix_dedup.SPAN)
    grams, n = np.unique(t.gram, return_counts=True)
    hot = grams[n > 1].view(np.int64).tolist()
    cuts = suffix_dedup.range_cuts(docs.withColumn("grams", F.array(*map(F.lit, hot))), int(n[n > 1].sum()), suffix_dedup.SPAN)
    first = t.place[t.gram == grams[n.argmax()]][0]
    gram = t.data[first : first + suffix_dedup.GRAM].tobytes()
    assert sum(c.startswith(gram) for c in cuts) >= 3
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.digest(suffix_dedup.deduplicated(docs)).collect()}
    assert got == brute_repeats(texts)


def test_spans_are_joined_as_they_come(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "JOINED", 50)
    spans, most = suffix_dedup.Spans(), 0
    for x in range(77):
        for doc in range(40):
            spans.append((doc, x, x + 100))
            most = max(most, len(spans))
    assert most <= 81 and suffix_dedup.joined_spans(spans) == [(doc, 0, 176) for doc in range(40)]


def test_texts_longer_than_a_part(spark):
    rng = random.Random(9)
    base = "".join(rng.choices("abcdefgh ", k=1_300_000))
    at = (1 << 20) - 150
    texts = {1: base, 2: "y" * 90 + base[at : at + 400] + "z" * 90}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in suffix_dedup.deduplicated(docs).collect()}
    assert got == {1: (0, 0), 2: (400, 1)}


def test_repeated_passages_of_odd_rows(odd_docs, no_docs):
    got = suffix_dedup.deduplicated(odd_docs).toPandas()
    assert len(got) == odd_docs.count()
    one = got.dropna(subset=["doc_id"])
    texts = {r.doc_id: r.text for r in odd_docs.collect() if r.doc_id is not None}
    want = brute_repeats(texts)
    for r in one.itertuples():
        assert (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) == want[r.doc_id]
    assert (got[got.doc_id.isna()].n_removed == 0).all()
    cut = suffix_dedup.without_repeats(odd_docs)
    assert cut.columns == odd_docs.columns and cut.count() == odd_docs.count()
    assert suffix_dedup.deduplicated(no_docs).count() == 0 and suffix_dedup.without_repeats(no_docs).count() == 0


def test_merge_never_looks_at_known_prefixes():
    rng = random.Random(2)
    keys = [bytes(rng.choices(b"ab", k=rng.randint(1, 40))) for _ in range(400)]
    runs = [sorted(set(keys[i::7])) for i in range(7)]
    got = list(suffix_dedup.merged([suffix_dedup.uncoded(suffix_dedup.front_coded(r)) for r in runs]))
    assert [k for _, _, k in got] == sorted(k for r in runs for k in r)
    last = b""
    for h, run, key in got:
        assert h == suffix_dedup.shared_prefix(last, key, 0) and key in runs[run]
        last = key


def brute_vectors(rows, threshold=0.95):
    good = {i: np.array(v, float) for i, v in rows.items() if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    good = {i: v / np.linalg.norm(v) for i, v in good.items()}
    links = [(a, b) for a in good for b in good if a < b and good[a] @ good[b] >= threshold]
    found = roots(rows, links)
    return {i: (sum(i in p for p in links), found[i], found[i] == i) for i in rows}


@pytest.mark.parametrize("tile", [4096, 20])
def test_near_vectors(spark, monkeypatch, tile):
    monkeypatch.setattr(embedding_dedup, "TILE", tile)
    rng = np.random.default_rng(4)
    rows = {}
    for i in range(150):
        v = rng.normal(size=40)
        for j in range(rng.integers(1, 4)):
            rows[i * 10 + j] = [float(np.float32(x)) for x in v + rng.normal(size=40) * rng.choice([0, 0.15, 0.3])]
    rows |= {9001: None, 9002: [], 9003: [0.0] * 40, 9004: [float("nan")] + [1.0] * 39, 9005: [None] + [1.0] * 39, 9006: [x * 3 for x in rows[0]], 9007: rows[0]}
    docs = spark.createDataFrame([(i, v, 1) for i, v in rows.items()] + [(0, rows[0], 1), (None, rows[0], 1)], "vec_id long, embedding array<float>, n_links int")
    got = embedding_dedup.near_vectors(docs).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got if r.vec_id is not None} == brute_vectors(rows)
    assert [tuple(r) for r in got if r.vec_id is None] == [(None, 0, None, True)]
    assert len(got) == len(rows) + 1
    assert embedding_dedup.near_vectors(docs.limit(0)).count() == 0


def test_queries_on_the_small_table(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in QUERIES["op3_minhash_dedup"](spark, folder).collect()}
    assert got == brute_near(texts, 4)
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op6_suffix_runs"](spark, folder).collect()}
    assert got == brute_repeats(texts)
    rows = {r.vec_id: r.embedding for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()}
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in QUERIES["op9_pca_tiles"](spark, folder).collect()}
    assert got == brute_vectors(rows)


def test_vectors_of_several_widths(spark):
    rng = np.random.default_rng(8)
    rows = []
    for width, n in ((8, 60), (4, 30), (1, 4)):
        for i in range(n):
            x = rng.normal(size=width)
            rows += [(len(rows), x.tolist()), (len(rows) + 1, (x * 3 + rng.normal(size=width) * 0.02).tolist())]
    rows += [(1000, rows[0][1]), (1001, [float("nan")] * 4), (1002, [0.0] * 8), (1003, [])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    links = []
    for n, (i, x) in enumerate(rows):
        for j, y in rows[n + 1 :]:
            if len(x) == len(y) and any(x) and any(y) and np.isfinite(x + y).all():
                if np.dot(x, y) / np.linalg.norm(x) / np.linalg.norm(y) >= 0.95:
                    links.append((i, j))
    want = roots([i for i, _ in rows], links)
    assert got == {i: (sum(i in link for link in links), want[i]) for i, _ in rows}
