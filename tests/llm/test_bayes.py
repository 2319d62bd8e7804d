import random

import numpy as np

from tests.llm.fixtures import documents, empty
from vendorlens.llm import bayes

LABELS = "doc_id long, quality int, toxic int, key string"


def corpus(n=600, seed=1):
    rng = random.Random(seed)
    words = [f"{a}{b}{c}" for a in ("ri", "sto", "mi", "ha") for b in ("ver", "ne", "ll", "za") for c in ("s", "ing", "ed", "o")]
    docs, labels = [], []
    for i in range(n):
        w = [rng.choice(words) for _ in range(rng.randint(30, 120))]
        toxic, bad = i % 7 == 0, i % 5 == 1
        if toxic:
            for k in range(3):
                w[rng.randrange(len(w))] = rng.choice(["idiotic", "scummy", "trashy"])
        if bad:
            w = [x + "%%%" for x in w]
        docs.append((i, " ".join(w), "spam" if i % 5 == 1 and i % 2 else f"s{i % 11}", "en"))
        labels.append((i, int(not bad), int(toxic), "x"))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    given = spark.createDataFrame(labels[:400], LABELS)
    out = {r["doc_id"]: r for r in bayes.classify(spark.createDataFrame(docs, "doc_id long, text string, source string, lang string"), given).collect()}
    held = [(out[i], q, t) for i, q, t, _ in labels[400:]]
    assert np.mean([r["toxic"] == bool(t) for r, _, t in held]) >= 0.97
    assert np.mean([(r["p_quality"] >= 0.5) == bool(q) for r, q, _ in held]) >= 0.97
    assert np.mean([r["kept"] for r, q, t in held if q and not t]) >= 0.97


def test_each_target_uses_its_own_labels(spark):
    """Half of the documents have a quality label only, the others a toxic label only."""
    docs, labels = corpus()
    half = [(i, q if i % 2 else None, None if i % 2 else t, x) for i, q, t, x in labels[:500]]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string, lang string")
    out = {r["doc_id"]: r for r in bayes.classify(frame, spark.createDataFrame(half, LABELS)).collect()}
    held = [(out[i], q, t) for i, q, t, _ in labels[500:]]
    assert np.mean([r["toxic"] == bool(t) for r, _, t in held]) >= 0.97 and np.mean([(r["p_quality"] >= 0.5) == bool(q) for r, q, _ in held]) >= 0.97
    counts = bayes.count_features(bayes.labelled_sample(frame, spark.createDataFrame(half, LABELS), "doc_id", "text", 1000)).where("feature = 0").first()
    assert counts["quality0"] + counts["quality1"] > 150 and counts["toxic0"] + counts["toxic1"] > 150


def brute_features(rows):
    """(quality0, quality1, toxic0, toxic1) of each feature, counted by hand; rows: (text, quality, toxic)."""
    out = {}
    for text, q, t in rows:
        tokens = text.split()
        have = {bayes.repetition(tokens)} | {f for x in tokens for f in bayes.token_features(x)} if tokens else set()
        for i, label in ((0, q), (2, t)):
            if label is not None:
                for f in have:
                    out.setdefault(f, [0] * 4)[i + (label > 0)] += 1
    return {bayes.hashed(f): tuple(c) for f, c in out.items()}


def test_counts_against_brute_force(spark):
    docs, labels = corpus(80)
    rows = [(d[1], None if i % 3 == 0 else q, None if i % 4 == 0 else t) for i, (d, (_, q, t, _)) in enumerate(zip(docs, labels))]
    rows += [("", 1, 0), ("x" * 40 + "-12-YES" * 5, 0, 1)]
    sample = spark.createDataFrame([(*r, False) for r in rows], "text string, quality int, toxic int, held boolean").repartition(4)
    got = {r["feature"]: tuple(r[c] for c in bayes.CLASSES) for r in bayes.count_features(sample).collect()}
    got.pop(0)
    assert got == brute_features(rows)


def test_long_texts(spark):
    docs, labels = corpus(60)
    docs += [(900, "river " * 900_000, "s1", "en"), (901, "y" * (5 << 20), None, None), (902, "\n" * 300_000, "s1", None)]
    labels += [(900, 1, 0, "x"), (901, 0, None, "x")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string, lang string").repartition(3)
    assert bayes.classify(frame, spark.createDataFrame(labels, LABELS)).count() == len(docs)


def test_train_rows_bound_the_sample(spark):
    docs, labels = corpus(100)
    sample = bayes.labelled_sample(spark.createDataFrame([d[:2] for d in docs], "doc_id long, text string"),
                                   spark.createDataFrame(labels, LABELS), "doc_id", "text", 30)
    assert sample.count() == 30


def test_shrinkage(spark):
    from pyspark.sql import functions as F
    groups = spark.createDataFrame([(1, 1, 1.0), (2, 1000, 900.0), (3, 1000, 100.0), (4, 1000, 500.0)], "g int, n long, total double")
    groups, mean = bayes.shrunk(groups, F.lit(0.5), "n", "total")
    m = dict(map(tuple, groups.select("g", mean.alias("m")).collect()))
    assert 0.85 < m[2] <= 0.9 and 0.1 <= m[3] < 0.15 and abs(m[4] - 0.5) < 1e-9
    assert 0.5 < m[1] < 0.9  # a single document stays near the prior
    alike = spark.createDataFrame([(i, 10, 5.0) for i in range(20)], "g int, n long, total double")
    alike, mean = bayes.shrunk(alike, F.lit(0.4), "n", "total")
    assert all(abs(r["m"] - 0.4) < 0.01 for r in alike.select(mean.alias("m")).collect())


def test_edges(spark):
    docs = documents(spark)
    none = spark.createDataFrame([], LABELS)
    out = bayes.classify(docs, none).collect()
    assert len(out) == docs.count() and all(r["kept"] and not r["toxic"] for r in out)
    odd = spark.createDataFrame([(10, 1, 0, "x"), (10, 0, 1, "x"), (None, 1, 1, "x"), (11, None, 0, "x"), (12, 1, 0, "x"), (13, 1, 0, "x")], LABELS)
    assert bayes.classify(docs, odd).count() == docs.count()
    assert bayes.classify(empty(spark), odd).count() == 0
