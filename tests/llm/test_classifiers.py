"""Language ID and toxicity: held-out accuracy and edge rows."""

import os

import numpy as np
import pyarrow as pa
import pytest

from salesflow.llm import langid, toxicity
from salesflow.llm.queries import QUERIES

LARGER = os.environ.get("TEST_MODEL_DIR", "/root/testdata/sf0.1")


def test_language_of_held_out_documents(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "lang").collect()}
    got = QUERIES["op7_language_id"](spark, LARGER).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(truth) and 0.15 < len(held) / len(got) < 0.25
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.98
    accepted = [r.lang_pred == truth[r.doc_id] for r in held if not r.rejected]
    assert len(accepted) > 0.8 * len(held) and np.mean(accepted) > 0.98


def test_language_edges(spark):
    texts = pa.array(["the cat and the dog", "der Hund und die Katze"] * 20)
    model = langid.fit(texts, ["en", "de"] * 20, np.arange(40) % 5 == 0, epochs=3)
    rows = [(1, None), (2, ""), (3, "123 !? \n"), (4, "😀"), (None, "the dog"), (6, "der"), (6, "der"), (7, "das " * 400_000), (8, "日本")]
    df = spark.createDataFrame([(d, t, "xx", 9.0) for d, t in rows], "doc_id long, text string, lang_pred string, score double")
    got = langid.predict(df, model).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (1, 2, 3, 4))
    assert by[None].lang_pred == "en" and by[6].lang_pred == "de" and by[8].lang_pred in ("en", "de")
    assert all(0 <= r.score <= 1 for r in got)
    empty = langid.train(spark.createDataFrame([], "text string, lang string, held boolean"))
    assert {r.lang_pred for r in langid.predict(df, empty).collect()} == {"und"}
    assert langid.predict(df.limit(0), model).count() == 0


def test_toxicity_of_held_out_documents(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    got = [r for r in QUERIES["op8_toxicity"](spark, LARGER).collect() if r.held_out and r.doc_id in labels]
    hit = np.array([r.predicted == 1 for r in got])
    true = np.array([labels[r.doc_id] == 1 for r in got])
    # some labels are noise: texts that are marked but hold nothing that others marked do
    assert hit[true].mean() > 0.75 and hit[~true].mean() < 0.005
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in got)


def test_toxicity_edges(spark):
    texts = pa.array(["you stupid fool", "what a nice day", "stupid idea", "a fine idea"] * 10)
    model = toxicity.fit(texts, np.array([1, 0, 1, 0] * 10), np.ones(40))
    rows = [(1, None), (2, ""), (3, "Stupid!"), (3, "Stupid!"), (None, "nice"), (5, "fine day " * 200_000), (6, "x" * 2_000_000)]
    df = spark.createDataFrame([(d, t, 0.5, 1) for d, t in rows], "doc_id long, text string, score double, toxic int")
    got = toxicity.score(df, model)
    assert got.columns == ["doc_id", "text", "score", "toxic", "__score"] and got.count() == len(rows)
    by = {r.doc_id: r["__score"] for r in got.collect()}
    assert by[3] > 0.7 > 0.5 > max(by[None], by[5]) and by[1] == by[2]
    one_sided = toxicity.fit(texts, np.zeros(40, int), np.ones(40))
    assert max(toxicity.score_texts(pa.array(["stupid", None]), one_sided)) < 0.01
    none = toxicity.train(df.limit(0).select("doc_id", "text"), spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score_texts(pa.array([""]), none)[0] < 0.01


def test_toxic_terms_of_a_small_language_are_learnt():
    rng = np.random.default_rng(5)
    words = {k: ["".join(rng.choice(list(k), 7)) for _ in range(60)] for k in ("abcdefgh", "mnopqrst")}

    def text(letters, *terms):
        return " ".join([*rng.choice(words[letters], 30), *terms])

    rows = [(text("abcdefgh", "wretchedfool"), 1) for _ in range(600)] + [(text("abcdefgh"), 0) for _ in range(600)]
    rows += [(text("mnopqrst", "estupidillo"), 1) for _ in range(9)] + [(text("mnopqrst"), 0) for _ in range(100)]
    model = toxicity.fit(pa.array([t for t, _ in rows]), np.array([y for _, y in rows]), np.ones(len(rows)))
    # nine toxic texts of 609: a share below 2%
    found = toxicity.presences(pa.array(["estupidillo"]), model.hashes)[1]
    assert (model.weights[found] > 0).any()
    new = toxicity.score_texts(pa.array([text("mnopqrst", "estupidillo"), text("mnopqrst")]), model)
    assert new[0] >= toxicity.THRESHOLD > 0.5 > new[1]


def test_copies_do_not_fill_the_language_sample(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(langid, "fit", lambda texts, langs, held: taken.append((texts.to_pylist(), langs, held.tolist())))
    rows = [(f"copy {k}", "en", i == 0) for k in range(5) for i in range(400)] + [(f"text {i}", "de", False) for i in range(1000)]
    df = spark.createDataFrame(rows, "text string, lang string, held boolean").repartition(3)
    langid.train(df, rows=10_000)
    texts, langs, held = taken.pop()
    assert len(texts) == len(set(texts)) == 1005 and langs.count("en") == sum(held) == 5
    langid.train(df, rows=200)
    assert 140 < len(taken.pop()[0]) < 260


def test_a_repeated_id_does_not_take_the_toxic_sample(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, toxic, weights: taken.append((texts.to_pylist(), toxic.tolist())))
    rows = [(i, f"text {i}") for i in range(1000)] + [(5000, f"hot {i % 1500}") for i in range(2000)] + [(None, "no id")]
    marks = [(i, int(i % 5 == 0)) for i in range(1000)] + [(5000, 0)] * 2000 + [(3, None), (None, 1)]
    docs = spark.createDataFrame([(d, t, "m") for d, t in rows], "doc_id long, text string, mark string").repartition(3)
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    toxicity.train(docs, labels, rows=10_000)
    texts, toxic = taken.pop()
    assert len(texts) == len(set(texts)) == 2500 and sum(toxic) == 200
    toxicity.train(docs, labels, rows=400)
    texts, toxic = taken.pop()
    assert 300 < len(texts) < 500 and 150 < sum(toxic) <= 200


def test_a_score_needs_a_free_name(spark):
    df = spark.createDataFrame([(1, "a", 0.5)], "doc_id long, text string, __score double")
    model = toxicity.Model(np.zeros(0, np.uint32), np.zeros(0), 0.0)
    with pytest.raises(ValueError, match="__score"):
        toxicity.score(df, model)
