"""Language ID and toxicity: held-out accuracy, odd rows, empty tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from headway.llm.language_id import SLOTS, ftrl, identify, language_id, softmax, temperature, train
from headway.llm.shared import table
from headway.llm.toxicity import Trees, isotonic, toxicity

FOLDER = "/root/testdata/sf0.01"


def test_language_of_held_out_rows(spark):
    docs = table(spark, FOLDER, "documents")
    odd = spark.createDataFrame(
        [(9001, None, None), (9002, "", "en"), (9003, "123 ... !?", "de"), (9004, "A" * 300_000, None)], "doc_id bigint, text string, lang string"
    )
    every = docs.unionByName(odd.withColumn("held_out", F.lit("x")), allowMissingColumns=True)
    found = language_id(every).join(docs.select("doc_id", "lang"), "doc_id", "left").collect()
    assert len(found) == docs.count() + 4
    held = [r for r in found if r["held_out"] and r["lang"]]
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in found)
    names = {r["doc_id"]: r["lang_pred"] for r in found if r["doc_id"] >= 9001}
    assert names[9001] == names[9002] == names[9003] == "und" != names[9004]


def test_language_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "hello", None)], "doc_id bigint, text string, lang string")
    assert [(r["lang_pred"], r["score"]) for r in language_id(docs).collect()] == [("und", 0.0)]
    assert language_id(docs.limit(0)).collect() == []


def test_every_language_is_learned_and_rows_without_id_are_bounded(spark):
    """800 languages, each with a word of its own; a third of all rows is one row without an id."""
    rows = [(lang * 10 + k, f"w{chr(0x4E00 + lang)}{chr(0x5E00 + lang)} " * (3 + k), f"l{lang}") for lang in range(800) for k in range(3)]
    rows += [(None, "same words again", "l0")] * 1200
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = train(docs, max_rows=600)
    assert len(model.languages) == 800
    found = {r["doc_id"]: r["lang_pred"] for r in identify(docs, model).collect() if r["doc_id"] is not None}
    assert np.mean([found[d] == lang for d, _, lang in rows if d is not None]) > 0.9


def test_regression_against_a_plain_version():
    """FTRL-proximal one coordinate at a time."""
    rng = np.random.default_rng(4)
    slots = [np.append(np.sort(rng.choice(40, 6, replace=False)), SLOTS) for _ in range(60)]
    rows = [(s, np.append(rng.random(6), 1.0)) for s in slots]
    target = rng.integers(0, 3, 60)
    alpha, beta, l1, l2 = 0.5, 1.0, 0.02, 0.01
    z, n = {}, {}

    def weight(i, c):
        own = z.get((i, c), 0.0)
        return 0.0 if abs(own) <= l1 else -(own - np.sign(own) * l1) / ((beta + n.get((i, c), 0.0) ** 0.5) / alpha + l2)

    order = np.random.default_rng(11)
    for _ in range(2):
        for k in order.permutation(60):
            s, v = rows[k]
            score = np.exp([sum(x * weight(i, c) for i, x in zip(s, v, strict=True)) for c in range(3)])
            p = score / score.sum()
            w = {(i, c): weight(i, c) for i in s for c in range(3)}
            for i, x in zip(s, v, strict=True):
                for c in range(3):
                    g = x * (p[c] - (target[k] == c))
                    old = n.get((i, c), 0.0)
                    z[i, c] = z.get((i, c), 0.0) + g - ((old + g * g) ** 0.5 - old**0.5) / alpha * w[i, c]
                    n[i, c] = old + g * g
    found = ftrl(rows, target, 3, 2, alpha, beta, l1, l2)
    assert all(abs(found[i, c] - weight(i, c)) < 1e-9 for i in range(SLOTS + 1) for c in range(3))


def test_temperature_recovers_scale():
    rng = np.random.default_rng(1)
    logits = rng.normal(size=(4000, 3))
    target = np.array([rng.choice(3, p=p) for p in softmax(logits)])
    assert temperature(4 * logits, target) == pytest.approx(4, rel=0.15)


def test_toxicity_of_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    english = docs.filter("lang = 'en'")
    odd = spark.createDataFrame([(90001, None), (90002, ""), (90003, "x " * 100_000)], "doc_id bigint, text string")
    found = toxicity(english.unionByName(odd, allowMissingColumns=True), labels).join(labels, "doc_id", "left").collect()
    assert len(found) == english.count() + 3
    held = [(r["toxic"], r["predicted"]) for r in found if r["held_out"] and r["toxic"] is not None]
    assert np.mean([p for t, p in held if t == 1]) > 0.9 and np.mean([p for t, p in held if t == 0]) < 0.01
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in found)


def test_toxicity_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "hello"), (2, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, None)], "doc_id bigint, toxic int")
    assert [r["score"] for r in toxicity(docs, labels).collect()] == [0.0, 0.0]
    assert toxicity(docs.limit(0), labels).collect() == []


def test_toxicity_learns_from_a_bounded_sample_of_labels(spark):
    """Labels have no text: they are drawn by id, and more than `max_rows` of them still give a model."""
    rows = [(i, ("you vile grumplet " if i % 5 == 0 else "a calm and pleasant ") + f"day number{i % 7} " * 3) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = docs.selectExpr("doc_id", "int(doc_id % 5 = 0) AS toxic")
    found = toxicity(docs, labels, max_rows=300).collect()
    assert len(found) == 900 and all(r["predicted"] == (r["doc_id"] % 5 == 0) for r in found if r["held_out"])
    assert {r["held_out"] for r in found} == {True, False}


def test_trees_and_isotonic():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 4)).astype(np.float32)
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    assert np.mean((Trees(x, y, 40).score(x) > 0) == y) > 0.97
    points, values = isotonic(np.array([1.0, 2, 3, 4, 5, 5]), np.array([0.0, 1, 0, 1, 1, 0]))
    assert (np.diff(values) >= 0).all() and (np.diff(points) >= 0).all()
    assert np.interp([2, 3], points, values).tolist() == [0.5, 0.5]
