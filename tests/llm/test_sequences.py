"""Packing, training order, contamination, language model and the pipeline."""

import itertools
import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from parity import connect, difference

import corpus_pipeline
from anteframe.llm import decontaminate, lm, packing, token_output
from anteframe.llm._store import stored
from anteframe.llm._text import NOT_ALNUM, Words, span_hash, text_bytes
from anteframe.llm._tokens import END, Encoder, default_files
from anteframe.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


def fewest(counts, size):
    """Fewest sequences, by trying all fillings of each in turn."""
    pieces = sorted((n for n, c in counts.items() for _ in range(c)), reverse=True)
    best = len(pieces)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(pieces):
            best = len(rooms)
            return
        for j in {r: j for j, r in enumerate(rooms) if r >= pieces[i]}.values():
            place(i + 1, [*rooms[:j], rooms[j] - pieces[i], *rooms[j + 1 :]])
        place(i + 1, [*rooms, size - pieces[i]])

    place(0, [])
    return best


@pytest.mark.parametrize("seed", range(25))
def test_few_pieces_are_packed_as_well_as_can_be(seed):
    rng = random.Random(seed)
    counts = dict(Counter(rng.randint(1, 40) for _ in range(rng.randint(1, 9))))
    kinds = packing.complete(counts, 40)
    used = Counter()
    for kind, times in kinds:
        assert sum(kind) <= 40 and times > 0
        used.update({n: k * times for n, k in Counter(kind).items()})
    assert used == Counter(counts)
    assert packing.lower_bound(counts, 40) <= fewest(counts, 40) == sum(t for _, t in kinds)


def test_many_pieces_reach_the_bound():
    rng = random.Random(5)
    counts = Counter(rng.randint(1, 1024) for _ in range(30_000)) + Counter({350: 9000, 1024: 20_000})
    kinds = packing.complete(dict(counts), 1024)
    assert sum(t for _, t in kinds) <= packing.lower_bound(counts, 1024) * 1.001


@pytest.mark.parametrize("seed", range(4))
def test_packing_is_no_worse_than_the_fullest_filling_at_each_step(seed):
    rng = random.Random(seed)
    counts = Counter(rng.randint(300, 345) if rng.random() < 0.5 else rng.randint(200, 520) for _ in range(200))
    left, steps = Counter(counts), 0
    while left := +left:
        top = max(left)
        left[top] -= 1
        made = {0: ()}
        for n in sorted(left.elements(), reverse=True):
            made |= {s + n: (*f, n) for s, f in made.items() if s + n <= 1024 - top and s + n not in made}
        left.subtract(made[max(made)])
        steps += 1
    kinds = packing.complete(dict(counts), 1024)
    assert sum((Counter({n: k * t for n, k in Counter(kind).items()}) for kind, t in kinds), Counter()) == counts
    assert sum(t for _, t in kinds) <= steps + 1
    assert sum(t for _, t in kinds) < sum(t for _, t in packing.best_fit(counts, 1024))


def test_fillings_are_those_that_none_before_dominates():
    counts, room = {9: 1, 7: 1, 6: 1, 5: 2, 4: 1, 2: 2}, 11
    pieces = [n for n, c in counts.items() for _ in range(c)]
    every = {tuple(sorted(c, reverse=True)) for k in range(8) for c in itertools.combinations(pieces, k) if sum(c) <= room}

    def parts_fit(other, rooms):
        if not other:
            return True
        return any(parts_fit(other[1:], [*rooms[:j], r - other[0], *rooms[j + 1 :]]) for j, r in enumerate(rooms) if r >= other[0])

    best = {f for f in every if not any(g != f and parts_fit(f, list(g)) for g in every)}
    assert all(packing.dominates(g, f) == parts_fit(f, list(g)) for g in every for f in every)
    assert set(packing.fillings(counts, room, width=1000)) == best
    assert list(packing.fillings(counts, room, least=room)) == [f for f in packing.fillings(counts, room, width=1000) if sum(f) == room]


def packed_rows(spark, docs):
    rows = packing.packed(docs).toPandas().sort_values(["sequence_id", "offset"]).reset_index(drop=True)
    first = rows.groupby("sequence_id").length.cumsum() - rows.length
    assert (first == rows.offset).all() and rows.groupby("sequence_id").length.sum().max() <= 1024
    return rows


def test_packed_pieces_are_those_of_the_texts(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = packed_rows(spark, docs)
    encoder, want = Encoder(*default_files()), set()
    for r in docs.collect():
        ids = [*encoder.whole.encode(r.text or "", add_special_tokens=False).ids, END]
        at, stop, piece = 0, len(ids) % 1024 or 1024, 0
        while at < len(ids):
            own = np.array(ids[at:stop], "<u4")
            want.add((r.doc_id, piece, at, len(own), zlib.crc32(own.tobytes())))
            at, stop, piece = stop, stop + 1024, piece + 1
    assert set(rows[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)) == want
    assert len(rows) == len(want)
    assert rows.sequence_id.nunique() <= packing.lower_bound(Counter(rows.length.tolist()), 1024) + 1


def test_a_length_many_share_is_ranked_in_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 5)
    docs = spark.createDataFrame([(i, "one two three") for i in range(700)] + [(i, "one") for i in range(700, 1500)], "doc_id long, text string")
    rows = packed_rows(spark, docs)
    assert len(rows) == 1500 and rows.sequence_id.nunique() == -(-rows.length.sum() // 1024)


def test_packing_of_odd_rows(spark, odd_docs, no_docs):
    rows = packed_rows(spark, odd_docs)
    assert (rows.piece == 0).sum() == odd_docs.count()
    assert rows[rows.doc_id == 4].length.tolist() == [1] and rows[rows.doc_id == 5].length.tolist() == [1]
    assert packing.packed(no_docs).count() == 0


def test_a_permutation_of_any_size():
    for n in (1, 2, 3, 5, 64, 1000, 4097):
        x = np.arange(n)
        y = token_output.permuted(x, n, key=9)
        assert sorted(y.tolist()) == x.tolist()
        assert token_output.permuted(y, n, key=9, back=True).tolist() == x.tolist()
    assert token_output.permuted(x, n, key=10).tolist() != y.tolist()


def test_shards_are_read_from_any_slot(spark, tmp_path, monkeypatch, odd_docs, no_docs):
    monkeypatch.setattr(token_output, "SHARD", 8)
    found = token_output.write(token_output.shards(odd_docs), str(tmp_path / "shards"))
    every = token_output.records(found).toPandas().sort_values("slot").reset_index(drop=True)
    packed = packing.packed(odd_docs).toPandas()
    assert every.slot.tolist() == list(range(len(packed)))
    key = ["doc_id", "piece", "length", "ids_crc32"]
    assert every[key].astype(float).value_counts(dropna=False).to_dict().keys() is not None
    assert sorted(map(repr, every[key].astype(float).to_numpy().tolist())) == sorted(map(repr, packed[key].astype(float).to_numpy().tolist()))
    for r in found.collect():
        assert len(r.payload) == r.records * r.stride and r.first_slot == r.shard * 8
    late = token_output.records(token_output.read(spark, str(tmp_path / "shards"), 11), 11).toPandas().sort_values("slot")
    assert late.slot.tolist() == list(range(11, len(packed)))
    assert token_output.shards(no_docs).count() == 0


def test_contamination_equals_sql(spark):
    got = QUERIES["op2_winnowing"](spark, SMALL).toPandas()
    assert difference(got, connect(SMALL).execute(ORACLES["op2_winnowing"]).df()) is None


def brute_hits(texts, items):
    import re

    def words(t):
        return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower())

    windows = {}
    for name, t in items:
        w = words(t)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(name)
    out = []
    for i, t in texts:
        w, hit, found = words(t), set(), set()
        for k in {len(x) for x in windows}:
            for p in range(len(w) - k + 1):
                names = windows.get(tuple(w[p : p + k]))
                if names:
                    hit.update(range(p, p + k))
                    found |= names
        out.append((i, len(w), len(hit), len(found - {None})))
    return sorted(out, key=repr)


def test_equal_items_cost_no_more_than_one(spark):
    passage = " ".join(f"w{i}" for i in range(12))
    data, off = text_bytes(pa.array([f"{passage} " * 3000, passage, "w0 w1"]))
    words = Words(data, off, NOT_ALNUM)
    many = decontaminate.Items([str(i) for i in range(20_000)], [passage] * 20_000)
    tracemalloc.start()
    start, size, window = many.hits(words)
    rows = np.searchsorted(words.off, start, "right") - 1
    named = many.named(rows, window)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(start) == 3 * 3001 and (size == 10).all() and sorted(set(window.tolist())) == [0, 1, 2]
    assert len(named) == 2 * 20_000 and named[:, 0].max() == 1
    assert peak < 50_000_000


def test_a_long_item_has_all_its_windows(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "ITEM_WORDS", 7)
    text = "ünd, ".join(f"A{i}b" for i in range(63))
    bench = spark.createDataFrame([(1, text), (1, text)], "item_id long, text string")
    docs = spark.createDataFrame([(0, text.lower()), (1, text[:20])], "doc_id long, text string")
    got = decontaminate.contamination(docs, bench).orderBy("doc_id").collect()
    assert [(r.n_words, [tuple(s) for s in r.spans], r["items"]) for r in got] == [(63, [(0, 63)], ["1"]), (3, [], [])]


@pytest.mark.parametrize("block", [4_000_000, 40])
def test_contamination(spark, monkeypatch, odd_docs, no_docs, block):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
    monkeypatch.setattr(decontaminate, "ITEM_WORDS", min(block, 100_000) // 3)
    monkeypatch.setattr(decontaminate, "LISTED", block)
    rng = random.Random(8)
    words = [f"w{i}" for i in range(9)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([0, 1, 3, 4, 9, 10, 11, 14, 30])))) for i in range(40)]
    items += [(3, items[3][1]), (50, None), (None, " ".join(words)), (51, "Same same SAME")]
    texts = []
    for i in range(80):
        own = rng.choices(words, k=rng.randint(0, 40))
        for _ in range(rng.randint(0, 2)):
            w = rng.choice(items)[1] or ""
            at = rng.randint(0, len(own))
            own[at:at] = w.upper().split()[rng.randint(0, 3) :]
        texts.append((i, rng.choice([" ", ", ", "\n"]).join(own)))
    texts += [(90, None), (91, "same, same; same same")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumnRenamed("text", "body")
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    got = decontaminate.digest(decontaminate.contamination(docs, bench, item_text="body"))
    assert sorted((tuple(r)[:4] for r in got.collect()), key=repr) == brute_hits(texts, items)
    kept = {r.doc_id for r in decontaminate.clean(docs, bench, item_text="body").collect()}
    assert kept == {i for i, _, n, _ in brute_hits(texts, items) if not n}
    odd = decontaminate.digest(decontaminate.contamination(odd_docs, bench, item_text="body"))
    want = brute_hits([(r.doc_id, r.text) for r in odd_docs.collect()], items)
    assert sorted((tuple(r)[:4] for r in odd.collect()), key=repr) == want
    assert decontaminate.contamination(no_docs, bench, item_text="body").count() == 0
    assert not decontaminate.digest(decontaminate.contamination(docs, bench.limit(0), item_text="body")).where("contaminated").count()


def test_counts_and_base_score(spark):
    got = {r.doc_id: r for r in QUERIES["op7_recurrent_lm"](spark, SMALL).collect()}
    texts = {r.doc_id: [*(r.text or "").encode().lower().split(), None] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in texts}
    counts = Counter(w for i, t in texts.items() if not held[i] for w in t)
    n = sum(counts.values())
    room = math.log10(n + 0.1 * (len(counts) + 1))
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(t), sum(counts[w] > 0 for w in t), n)
        assert r.base_score == pytest.approx(sum(math.log10(counts[w] + 0.1) - room for w in t))
        assert r.score < 0


def small_vocabulary():
    head = np.arange(lm.WORDS, 0, -1).astype(float)
    none = np.zeros(0, np.int64)
    return lm.Vocabulary(none.astype(np.uint64), none, none, int(head.sum()), lm.WORDS, head, np.full(lm.ENDINGS, 50.0), np.full(lm.ENDINGS, 9.0))


def test_probabilities_sum_to_one():
    p = lm.views(lm.start(small_vocabulary()))
    number = np.arange(lm.WORDS + lm.ENDINGS)
    h = np.repeat(np.random.default_rng(0).normal(size=(1, lm.STATE)), len(number), axis=0)
    assert np.exp(lm.predictions(p, h, number)[0]).sum() == pytest.approx(1, abs=1e-4)


def test_training_follows_the_slope_and_learns():
    rng = np.random.default_rng(1)
    numbers = np.tile(np.array([0, 5, 900, 17, 4100, 33]), 9000)
    begin = lm.start(small_vocabulary())
    after = lm.train(begin, numbers)
    off = np.array([0, 600])
    score = [lm.likelihoods(lm.views(w), np.roll(numbers, -1)[:600], off)[0] / 600 for w in (begin, after)]
    assert score[1] > score[0] + 2
    # The state is carried through windows: a text scores as its tokens one after the other.
    p, h, last, total = lm.views(after), np.zeros((1, lm.STATE), np.float32), 0, 0.0
    text = rng.choice(numbers, 90)
    for n in text:
        h = lm.step(p, p["embedding"][[last]] @ p["w"] + p["b"], h)[0]
        total += lm.predictions(p, h, np.array([n]))[0][0]
        last = n
    both = lm.likelihoods(p, np.concatenate((text[:40], text, text[:1])), np.array([0, 40, 130, 131]))
    assert both[1] == pytest.approx(total, rel=1e-4)


def test_training_keeps_the_last_tokens():
    # 63 tokens more than the streams hold evenly; only the very last one is of its class.
    numbers = np.tile(np.array([0, 5, 900, 17]), 400)[:1343]
    numbers[-1] = 4000
    begin = lm.start(small_vocabulary())
    before, after = (lm.views(w)["word_b"][lm.class_of(4000)] for w in (begin, lm.train(begin, numbers)))
    assert after[4000 % (lm.WORDS // lm.CLASSES)] > before[4000 % (lm.WORDS // lm.CLASSES)]
    for n in (0, 1, 2, 65):
        assert np.isfinite(lm.train(begin, numbers[:n])).all()
    assert not np.array_equal(lm.train(begin, numbers[:1]), begin)


def test_slopes_are_those_of_the_predictions():
    rng = np.random.default_rng(2)
    flat = lm.start(small_vocabulary()).astype(float)
    h, number = rng.normal(size=(400, lm.STATE)), np.concatenate((rng.integers(0, lm.WORDS + lm.ENDINGS, 200), rng.integers(0, 70, 200)))
    grad = np.zeros_like(flat)
    back = lm.slopes(lm.views(flat), h, number, lm.views(grad))
    for name in ("class_w", "class_b", "word_w", "word_b"):
        move = np.zeros_like(flat)
        lm.views(move)[name][:] = rng.normal(size=lm.SHAPES[name])
        up, down = (lm.predictions(lm.views(flat + s * 1e-5 * move), h, number)[0].sum() for s in (1, -1))
        assert (grad * move).sum() == pytest.approx((down - up) / 2e-5, rel=1e-4)
    move = rng.normal(size=h.shape)
    up, down = (lm.predictions(lm.views(flat), h + s * 1e-5 * move, number)[0].sum() for s in (1, -1))
    assert (back * move).sum() == pytest.approx((down - up) / 2e-5, rel=1e-4)


def test_a_long_part_is_learned_in_wider_windows(monkeypatch):
    # 1,200,000 tokens took 938 windows of 64 streams, each with a step over all weights.
    seen, descend = [], lm.descend
    monkeypatch.setattr(lm, "descend", lambda *a: seen.append(a[4]) or descend(*a))
    numbers = np.tile(np.array([0, 5, 900, 17, 4100, 33]), 200_000)
    begin = lm.start(small_vocabulary())
    after = lm.train(begin, numbers)
    assert seen == list(range(1, lm.WINDOWS + 1))
    score = [lm.likelihoods(lm.views(w), np.roll(numbers, -1)[:600], np.array([0, 600]))[0] / 600 for w in (begin, after)]
    assert score[1] > score[0] + 2
    # Shorter parts keep narrow windows, so that there are enough of them.
    assert lm.streams_of(10**5) == lm.STREAMS < lm.streams_of(2 * 10**6) == lm.streams_of(10**9) == lm.WIDEST


def test_a_word_costs_few_exponentials_and_long_texts_score_in_any_order(monkeypatch):
    # Each word took 192 before, 128 for its class alone.
    p, rng, made = lm.views(lm.start(small_vocabulary())), np.random.default_rng(3), []
    h, number = rng.normal(size=(500, lm.STATE)).astype(np.float32), rng.integers(0, lm.WORDS + lm.ENDINGS, 500)
    exp = np.exp
    monkeypatch.setattr(lm.np, "exp", lambda x, **how: made.append(x.size) or exp(x, **how))
    logs = lm.predictions(p, h, number)[0]
    assert sum(made) <= 100 * len(h)
    monkeypatch.undo()
    alone = [lm.predictions(p, h[i : i + 1], number[i : i + 1])[0][0] for i in range(50)]
    assert logs[:50] == pytest.approx(alone, rel=1e-4)
    # Logits that no exponential holds.
    far = lm.predictions(p, h * np.float32(3000), number)[0]
    assert np.isfinite(far).all() and (far <= 1e-3).all()


def test_words_are_looked_up_as_by_search():
    texts = ["A b aB Zz\tx\u00e9 \u00e9", None, "", "q", "  one TWO two\n\u20ac", "Ab"]
    hashes, ending, off = lm.tokens(pa.record_batch([pa.array(texts)], ["text"]))
    words = [w for t in texts for w in [*(t or "").encode().lower().split(), None]]
    assert off.tolist() == [0, 7, 8, 9, 11, 16, 18]
    for i, w in enumerate(words):
        last = np.frombuffer((w or b"")[-2:], np.uint8)
        want = span_hash(last, np.array([0]), np.array([len(last)]))[0] % np.uint64(lm.ENDINGS) if w else 0
        assert ending[i] == want and (hashes[i] == lm.END) == (w is None)
    rng = np.random.default_rng(4)
    for n in (0, 1, 3, 70_000):
        known = np.unique(np.concatenate((rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2), rng.integers(0, 50, n).astype(np.uint64))))
        v = lm.Vocabulary(known, known, np.arange(len(known)), 1, 1, known, known, known)
        asked = np.concatenate((known, known + np.uint64(1), known - np.uint64(1), np.array([0, (1 << 64) - 1], np.uint64)))
        at, found = v.find(asked)
        assert found.tolist() == np.isin(asked, known).tolist()
        assert (known[at[found]] == asked[found]).all()


def test_the_network_learns_from_every_training_document(spark):
    docs = spark.createDataFrame([(i, f"w{i} w{i} w{i}") for i in range(400)], "key long, text string").repartition(3)
    v = lm.vocabulary(lm.word_counts(docs.select("text")))
    before, after = (lm.views(w)["embedding"] for w in (lm.start(v), lm.trained(docs, v)))
    words = np.arange(1, 401)
    assert (before[words] != after[words]).any(axis=1).all()
    assert lm.rounds_of(10**5) < lm.rounds_of(10**8) < lm.rounds_of(10**10)


def test_scores_of_odd_rows(odd_docs, no_docs):
    got = lm.scored(odd_docs).toPandas()
    assert len(got) == odd_docs.count() and (got.score < 0).all()
    assert set(got[got.doc_id.isin([4, 5, 6])].n_tokens) == {1}
    twice = got[got.doc_id == 1]
    assert len(twice) == 2 and twice.base_score.nunique() == 1
    same = got[(got.doc_id == 2) | (got.doc_id.isna() & (got.n_tokens > 1))]
    assert len(same) == 2 and same.base_score.round(6).nunique() == 1
    assert lm.scored(no_docs).count() == 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near duplicates", "repeated passages", "decontamination", "packing"]
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, before, SMALL))
        old, new = ({r.doc_id: r.text for r in x.collect()} for x in (before, after)) if name != "packing" else (None, None)
        if new is not None:
            assert after.columns == columns and set(new) <= set(old)
        if name in ("quality", "near duplicates", "decontamination"):
            assert all(new[i] == old[i] for i in new)
        if name == "near duplicates":
            from test_duplicates import brute_near

            assert set(new) == {i for i, (_, _, kept) in brute_near(old, 5).items() if kept}
        if name == "repeated passages":
            from test_duplicates import brute_repeats

            want = brute_repeats(old)
            assert set(new) == set(old) and all(len(old[i].encode()) - n >= len(new[i].encode()) for i, (_, n, _, _) in want.items())
            assert all(new[i] == old[i] for i, (_, n, _, _) in want.items() if not n)
            assert all(r.n_chars == len(r.text) for r in after.collect())
        if name == "decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
            assert set(new) == {i for i, _, n, _ in brute_hits(old.items(), items) if not n}
        before = after
    assert before.count() == corpus_pipeline.run(spark, SMALL).count()


@pytest.mark.parametrize("rows", ["odd", "none"])
def test_stages_on_odd_rows(spark, odd_docs, no_docs, rows):
    docs = odd_docs if rows == "odd" else no_docs
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, SMALL))
        if name != "packing":
            assert after.columns == odd_docs.columns
            docs = after
    assert (after.count() > 0) == (rows == "odd")


def test_negative_and_missing_ids_are_told_apart(spark, tmp_path):
    rows = [(-5, "a b c"), (-1, "d"), (0, "word " * 3000), (None, "word " * 3000), (None, None), (-(2**63), "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = token_output.records(token_output.write(token_output.shards(docs), str(tmp_path / "shards"))).collect()
    assert {r.doc_id for r in got} == {r[0] for r in rows}
    long = [sorted(r.piece for r in got if r.doc_id == i and r.piece > 0) for i in (0, None)]
    assert long[0] and long[0] == long[1] and all(r.piece >= 0 for r in got)
