"""Language, toxicity and neighbours: gradients, held-out accuracy, recall against brute force."""

import random

import numpy as np
import pytest
from brute import DOCS, documents
from pyspark.sql import functions as F

from stagetrail.llm import language, nearest, toxicity

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_backpropagation_matches_differences():
    rng = np.random.default_rng(1)
    net = language.ByteGru(["a", "b", "c"], hidden=3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x = rng.integers(0, 256, (7, 4)).astype(np.intp)
    live = np.ones((7, 4), np.float32)
    live[5:, 1] = 0
    label = np.array([0, 1, 2, 1])
    _, grad = net.gradients(x, live, label)
    for name, value in net.p.items():
        for _ in range(4):
            at = (int(x[2, 2]), int(rng.integers(9))) if name[0] == "E" else tuple(rng.integers(0, s) for s in value.shape)
            old, step = value[at], 1e-2
            value[at] = old + step
            above = net.gradients(x, live, label)[0]
            value[at] = old - step
            below = net.gradients(x, live, label)[0]
            value[at] = old
            assert grad[name][at] == pytest.approx((above - below) / (2 * step), abs=2e-4), name


def test_states_do_not_depend_on_padding_or_neighbours():
    net = language.ByteGru(["a", "b"])
    texts = [b"one text", b"another, longer text " * 20, b"x", b"one text"]
    alone = [net.pooled([t])[0][0] for t in texts]
    together = net.pooled(texts)[0]
    assert np.allclose(alone, together, atol=1e-6) and np.allclose(together.sum(axis=1), 1)


def test_held_out_accuracy(spark, docs):
    got = language.predict_languages(docs).join(docs.select("doc_id", "lang"), "doc_id")
    rows = got.collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    tested = [r for r in rows if r["held_out"] and r["lang_pred"] != "und"]
    assert 0.2 < len(tested) / len(rows) < 0.3
    assert sum(r["lang_pred"] == r["lang"] for r in tested) / len(tested) > 0.97


def test_language_edge_cases(spark):
    texts = [None, "", " 123 !? ", "日本", "x" * 3000] + ["the house on the hill"] * 20 + ["das Haus auf dem Berg"] * 20
    rows = [(i, t, (None if i < 5 else "en" if i < 25 else "de"), None, None) for i, t in enumerate(texts)] + [(None, "the hill", "en", None, None)]
    many = spark.createDataFrame(rows, DOCS).withColumn("language", F.lit("clash"))
    got = language.predict_languages(many, steps=60).collect()
    found = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows) and [found[i]["lang_pred"] for i in (0, 1, 2)] == ["und"] * 3
    assert found[3]["lang_pred"] in ("de", "en") and not found[None]["held_out"]
    assert sum(found[i]["lang_pred"] == ("en" if i < 25 else "de") for i in range(5, 45)) > 36
    # Without a label nothing is learnt, and languages of held-out rows alone are no label.
    assert {r["lang_pred"] for r in language.predict_languages(many.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    hidden = many.withColumn("lang", F.when(language.held_out(), F.lit("zz")).otherwise(F.col("lang")))
    assert "zz" not in {r["lang_pred"] for r in language.predict_languages(hidden, steps=5).collect()}
    assert language.predict_languages(spark.createDataFrame([], DOCS)).count() == 0


# ---- toxicity ----


def test_thresholds_stay_ordered_and_share_weights():
    rng = np.random.default_rng(3)
    truth = rng.normal(size=30)
    rows = [np.sort(rng.choice(30, 8, replace=False)).astype(np.int32) for _ in range(1500)]
    grade = np.digitize([truth[r].sum() + rng.logistic() * 0.3 for r in rows], [0.0, 2.0, 4.0])
    model = toxicity.CumulativeLink(4, places=30).fit(rows, grade, np.ones(len(rows)), steps=400)
    assert (np.diff(model.thresholds) > 0).all()
    scores = np.array([model.weights[r].sum() for r in rows])
    assert np.corrcoef(scores, [truth[r].sum() for r in rows])[0, 1] > 0.97
    above = model.above(scores)
    assert (np.diff(above, axis=1) <= 0).all() and np.allclose(model.expected(scores), above.sum(axis=1))
    assert np.mean((above > 0.5).sum(axis=1) == grade) > 0.75


def test_severity_finds_toxic_documents(spark):
    rng = random.Random(5)
    plain = [f"word{i}" for i in range(300)]
    bad = ["vilest", "vilely", "grimmer", "grimmest"]

    def text(hits):
        words = [rng.choice(plain) for _ in range(rng.randrange(20, 120))]
        for _ in range(hits):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        return " ".join(words).capitalize() + "."

    hits = [rng.choice([1, 2, 4, 8]) if i % 4 == 0 else 0 for i in range(800)]
    texts = [text(h) for h in hits] + [None, "", "vilest " * 30000]
    docs = documents(spark, texts, extra=True)
    labels = spark.createDataFrame([(i, 1, int(h > 0)) for i, h in enumerate(hits) if i % 3] + [(None, 1, 1), (2, 1, None), (9999, 1, 1), (1, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.severity(docs, labels, docs_per_label=400).collect()}
    assert len(got) == len(texts)
    unseen = [i for i in range(800) if i % 3 == 0]
    assert np.mean([got[i]["toxic"] == (hits[i] > 0) for i in unseen]) > 0.95
    assert all((r["grade"] > 0) == r["toxic"] for r in got.values())
    assert got[802]["toxic"] and not got[800]["toxic"] and not got[801]["toxic"]
    mean = {h: np.mean([got[i]["expected_severity"] for i in unseen if hits[i] == h]) for h in (0, 1, 8)}
    assert mean[0] < 0.3 < mean[1] < mean[8] <= 3
    none = toxicity.severity(docs, labels.where("toxic = 0")).collect()
    assert {(r["expected_severity"], r["toxic"]) for r in none} == {(0.0, False)}
    assert toxicity.severity(spark.createDataFrame([], DOCS), labels).count() == 0


# ---- neighbours ----


def brute(vectors, query, k):
    scores = sorted(((-float((np.float64(v) * np.float64(vectors[query])).sum()), i) for i, v in vectors.items() if i != query))
    return scores[:k]


def test_recall_and_scores(spark):
    base = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    vectors = {r["vec_id"]: np.array(r["embedding"], np.float32) for r in base.collect()}
    got = {}
    for r in nearest.nearest_neighbours(base, base.where("vec_id % 20 = 0")).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {i for i in vectors if i % 20 == 0}
    hit = 0
    for query, rows in got.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, 21))
        assert [(-s, i) for _, i, s in rows] == sorted((-s, i) for _, i, s in rows)
        for _, i, s in rows:
            assert s == pytest.approx(float((np.float64(vectors[i]) * np.float64(vectors[query])).sum()), abs=1e-12)
        hit += len({i for _, i, _ in rows} & {i for _, i in brute(vectors, query, 20)})
    assert hit / (20 * len(got)) >= 0.9


def test_abandoning_loses_nothing_that_counts():
    rng = np.random.default_rng(2)
    rows = rng.normal(size=(3000, 48)).astype(np.float32) * rng.lognormal(0, 0.4, (3000, 1)).astype(np.float32)
    ids = np.arange(3000)
    fitted = nearest.Lists(rows, float(np.sqrt((rows.astype(float) ** 2).sum(axis=1).max())), 4)
    found = list(nearest.scan(rows[:50], ids[:50], rows, ids, fitted, 20))
    exact = rows[:50].astype(float) @ rows.T.astype(float)
    exact[np.arange(50), np.arange(50)] = -np.inf
    hits = [len(set(f[0]) & set(np.argsort(-e)[:20])) for f, e in zip(found, exact, strict=True)]
    assert np.mean(hits) / 20 > 0.98


def test_neighbour_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(nearest, "CELL", 16)
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(4)
    hot = [0.5, -1.0, 2.0]
    rows = [(i, hot) for i in range(100)] + [(100 + i, [float(x) for x in rng.normal(size=3)]) for i in range(60)]
    odd = [(900, None), (901, [0.0, 0.0, 0.0]), (902, [1.0, nan, 0.0]), (903, [inf, 0.0, 0.0]), (904, [1.0, None, 0.0]), (905, [1.0, 2.0]), (906, []), (None, [1.0, 1.0, 1.0])]
    base = spark.createDataFrame(rows + odd + [(5, hot)], "vec_id long, embedding array<float>").withColumns({"list": F.lit(1), "id": F.lit("x"), "score": F.lit(0)})
    got = {}
    for r in nearest.nearest_neighbours(base, base.where("vec_id % 20 = 0 or vec_id > 900 or vec_id is null"), k=20, lists=4, probes=4).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    vectors = {i: np.array(v, np.float32) for i, v in rows}
    assert set(got) == {0, 20, 40, 60, 80, 100, 120, 140}
    for query, found in got.items():
        assert [i for _, i, _ in sorted(found)] == [i for _, i in brute(vectors, query, 20)]
    few = spark.createDataFrame(rows[98:102], "vec_id long, embedding array<float>")
    assert nearest.nearest_neighbours(few, few, k=20).groupBy("query_id").count().where("count = 3").count() == 4
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert nearest.nearest_neighbours(none, none).count() == 0
    assert nearest.nearest_neighbours(few, none).count() == 0
