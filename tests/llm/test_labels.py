"""Quality, language and toxicity: held-out accuracy, and rows of every odd kind."""

import numpy as np
import pyarrow as pa
import pytest

from anteframe.llm import langid, quality, queries, toxicity
from anteframe.llm._text import text_bytes

FOLDER = "/root/testdata/sf0.01"


def held(spark, name, truth):
    got = queries.QUERIES[name](spark, FOLDER).toPandas()
    assert not got.doc_id.duplicated().any() and got.score.between(0, 1).all()
    return got[got.held_out].merge(truth, on="doc_id")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{FOLDER}/labels.parquet")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_quality_of_held_out_texts(spark, labels):
    rows = held(spark, "op1_quality_knn", labels.toPandas())
    assert (rows.predicted == rows.quality).mean() > 0.93
    assert (rows.predicted == (rows.score >= 0.3)).all()
    assert rows[rows.quality == 1].predicted.mean() > 0.97


def test_toxicity_of_held_out_texts(spark, labels):
    rows = held(spark, "op8_toxicity_trees", labels.toPandas())
    assert (rows.predicted == rows.toxic).mean() > 0.9
    assert rows[rows.toxic == 0].predicted.mean() < 0.05


def test_language_of_held_out_texts(spark, docs):
    rows = held(spark, "op4_language_ecoc", docs.select("doc_id", "lang").toPandas())
    assert (rows.lang == rows.lang_pred).mean() > 0.98


def test_neighbours_are_the_nearest(docs, labels):
    model = quality.fit(docs, labels, sample=60)
    rng = np.random.default_rng(0)
    counts = np.abs(rng.normal(size=(20, quality.TERMS))).astype(np.float32)
    near = model.project(counts) @ model.vectors.T
    for row, score in zip(near, model.score(counts), strict=True):
        best = np.argsort(-row)[: quality.NEIGHBOURS]
        weight = np.maximum(row[best], 0) ** 4 * model.votes[best]
        assert score == pytest.approx((weight * model.labels[best]).sum() / weight.sum(), abs=1e-4)


def test_code_words_stay_apart():
    for n in (1, 2, 3, 5, 9, 40):
        words = langid.code_words(n)
        assert words.shape[0] == n
        if n > 1:
            assert len(np.unique(words, axis=0)) == n and (np.abs(words.sum(axis=0)) < n).all()
        if n > 8:
            assert ((words.shape[1] - words @ words.T) / 2 + np.eye(n) * 99).min() >= words.shape[1] / 5


def test_isotonic_rises_and_keeps_the_mean():
    rng = np.random.default_rng(0)
    value, weight = rng.normal(size=300), rng.random(300) + 0.1
    y = (rng.random(300) < 1 / (1 + np.exp(-2 * value))).astype(float)
    at, level = toxicity.isotonic(value, y, weight)
    assert (np.diff(at) >= 0).all() and (np.diff(level) >= 0).all()
    assert (np.interp(value, at, level) * weight).sum() == pytest.approx((y * weight).sum())


def test_trees_learn_what_no_line_parts():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    assert ((toxicity.Trees(x, y, np.ones(2000))(x) > 0) == y).mean() > 0.95


@pytest.mark.parametrize("which", ["odd", "none"])
def test_odd_rows(spark, docs, labels, odd_docs, no_docs, which):
    rows = odd_docs if which == "odd" else no_docs
    n = rows.count()
    good = quality.fit(docs, labels, sample=60)
    got = quality.scored(rows, good).toPandas()
    assert len(got) == n and got.score.between(0, 1).all()
    if n:
        assert (got[got.doc_id.isin([4, 5, 6])].score == good.prior).all()
        assert got[got.doc_id == 1].score.nunique() == 1 and (got.doc_id == 1).sum() == 2
    kept = quality.accepted(rows, good, threshold=0.0)
    assert kept.count() == n and kept.columns == rows.columns
    toxic = toxicity.scored(rows, toxicity.fit(docs, labels, sample=60)).toPandas()
    assert len(toxic) == n and toxic.score.between(0, 1).all()
    names = langid.predicted(rows, langid.fit(docs, sample=40)).toPandas()
    assert len(names) == n
    if n:
        assert set(names[names.doc_id.isin([4, 5, 6, 12])].lang_pred) == {"und"}
        assert (names[names.doc_id.isin([1, 9])].lang_pred != "und").all()


def test_nothing_to_learn_from(docs, labels, no_docs):
    none = labels.limit(0)
    few = docs.limit(5)
    assert (quality.scored(few, quality.fit(docs, none)).toPandas().score == 0.5).all()
    assert (toxicity.scored(few, toxicity.fit(docs, none)).toPandas().score == 0).all()
    assert set(langid.predicted(few, langid.fit(no_docs)).toPandas().lang_pred) == {"und"}
    one = labels.where("quality = 1")
    assert (quality.scored(few, quality.fit(docs, one)).toPandas().predicted == 1).all()


def test_short_texts_have_their_own_features():
    texts = ["", "a", "ab", "Zug 7", "ab", "x" * 40, "a", ""]

    def rows(of, cells):
        return of(*text_bytes(pa.array(cells, pa.string())))

    for of in (langid.ngrams, quality.term_counts):
        together = rows(of, texts)
        for i, t in enumerate(texts):
            assert np.array_equal(together[i], rows(of, [t])[0])
