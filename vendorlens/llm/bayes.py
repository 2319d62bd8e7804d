"""Quality classifier by hierarchical empirical Bayes.

Document evidence: word, prefix, shape and repetition features, weighted by their
presence in labelled documents of either class (naive Bayes on the significant and
strong ones, calibrated on a held-out fifth). It is fitted on at most ``train_rows``
labelled documents, those with the least hash of their key; this bound holds at any corpus size and bounds the
weights too, so they are broadcast. Each target is fitted on all documents of the sample that have its own label. Of sampled texts with the same min-hash of word triples, which near copies
share, one counts: else the words of a copied text would pass for signs of its class.

Site evidence: Spark sums the documents' probabilities per host and per path of all
documents (the columns given as ``host`` and ``path``; the documents have no url, so ``source`` and ``lang`` stand for them). Host means are shrunk toward the global mean and path means toward their
host's, with strengths from the observed spread (method of moments), so sparse sites
keep the prior of the level above. A document's posterior log-odds are its own plus
what its path's posterior differs from the global prior.

Defined results: a null or empty text has no features; a null host or path is a group of
its own; with several labels of a document the least quality and the most toxic count;
null labels are left out; without labels of both classes a target says nothing
(probability one half) and rejects nothing.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vendorlens.llm.common import as_sql_type, salted_join, stored, text_blocks, texts, worker_cache

TARGETS = ("quality", "toxic")
REMEMBERED = 300_000
_SHAPES = [(re.compile(p), s) for p, s in ((r"[^\W\d_]+", lambda m: "A" if m.group().isupper() and len(m.group()) > 1 else "a"),
                                           (r"\d+", "0"), (r"([^\w\s])\1+", r"\1\1"))]


def token_features(token: str) -> list[str]:
    """The features of a token: its letters, their prefixes, and the shape of the whole."""
    shape = token
    for pattern, to in _SHAPES:
        shape = pattern.sub(to, shape)
    out = [f"s:{shape}"]
    letters = re.sub(r"[\W\d_]+", "", token).lower()
    if letters:
        out.append(f"w:{letters}")
        out += [f"p:{letters[:k]}" for k in (4, 5) if len(letters) > k]
    return out


def repetition(tokens: list[str]) -> str:
    return f"r:{10 * len(set(tokens)) // max(1, len(tokens))}"


def hashed(feature: str) -> int:
    return xxhash.xxh3_64_intdigest(feature) - (1 << 63)


def document_features(tokens: list[str], known: dict[str, tuple[int, ...]]) -> set[int]:
    out = {hashed(repetition(tokens))} if tokens else set()
    for t in set(tokens):
        f = known.get(t)
        if f is None:
            f = known[t] = tuple(map(hashed, token_features(t)))
        out.update(f)
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, train_rows: int) -> DataFrame:
    """At most ``train_rows`` labelled documents: ``key``, ``text``, ``quality``, ``toxic``, ``held``."""
    own = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(
        F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    first = own.where("quality IS NOT NULL OR toxic IS NOT NULL").orderBy(F.xxhash64("key"), "key").limit(train_rows)
    held = F.pmod(F.xxhash64(F.lit("held"), "key"), F.lit(5)) == 0

    def sign(batches):
        for block in text_blocks(batches):
            yield pa.RecordBatch.from_arrays([*block.columns, pa.array([signature(t.split()) for t in texts(block)], pa.int64())],
                                             names=[*block.schema.names, "sign"])

    rows = docs.select(docs[key].alias("key"), docs[text].alias("text")).join(F.broadcast(first.withColumn("held", held)), "key")
    signed = rows.mapInArrow(sign, f"key {as_sql_type(docs, key)}, text string, quality {as_sql_type(rows, 'quality')}, "
                                   f"toxic {as_sql_type(rows, 'toxic')}, held boolean, sign long")
    one = W.partitionBy("sign").orderBy("key")  # a part of the sample
    return stored(signed.withColumn("copy", F.row_number().over(one)).where("copy = 1").drop("copy", "sign"), "sample")


def signature(tokens: list[str]) -> int:
    """The least hash of the text's word triples."""
    return min((hashed(" ".join(tokens[i:i + 3]).lower()) for i in range(max(1, len(tokens) - 2))), default=0)


#: The columns of counts: documents with the label 0 and 1 of each target.
CLASSES = ("quality0", "quality1", "toxic0", "toxic1")


def count_features(sample: DataFrame) -> DataFrame:
    """In how many documents with each label a feature occurs: ``feature`` and ``CLASSES``."""

    def run(batches):
        counts = [Counter() for _ in CLASSES]
        for block in text_blocks(batches):
            for t, *labels in zip(texts(block), *(block.column(c).to_pylist() for c in TARGETS)):
                have = document_features(t.split(), worker_cache("token_features", REMEMBERED))
                for i, label in enumerate(labels):
                    if label is not None:
                        counts[2 * i + (label > 0)].update(have)
                        counts[2 * i + (label > 0)][0] += 1  # the number of documents
        features = sorted(set().union(*counts))
        yield pa.RecordBatch.from_arrays([pa.array(features, pa.int64())] + [
            pa.array([c[f] for f in features], pa.int64()) for c in counts], names=["feature", *CLASSES])

    rows = sample.where(~F.col("held")).select("text", *TARGETS).mapInArrow(run, ", ".join(f"{c} long" for c in ("feature", *CLASSES)))
    return rows.groupBy("feature").agg(*[F.sum(c).alias(c) for c in CLASSES])


def feature_weights(counts: DataFrame, least: float, strong: float):
    """Weights of the significant and strong features and the prior log-odds of both targets (None: not both classes)."""
    n = counts.where("feature = 0").select(*CLASSES).first() or (0, 0, 0, 0)
    rows, priors = counts.where("feature <> 0"), {}
    for i, t in enumerate(TARGETS):
        o, y = float(n[2 * i] or 0), float(n[2 * i + 1] or 0)
        priors[t] = math.log(y / o) if y and o else None
        if priors[t] is None:
            rows = rows.withColumn(f"w_{t}", F.lit(0.0))
            continue
        b, a = (F.col(f"{t}{k}").cast("double") for k in (0, 1))
        both = (a + b) / (y + o)
        z = F.abs(a / y - b / o) / F.sqrt(F.greatest(both * (1 - both), F.lit(1e-12)) * (1 / y + 1 / o))
        weight = F.log((a + 0.5) / (y + 1)) - F.log((b + 0.5) / (o + 1))
        rows = rows.withColumn(f"w_{t}", F.when((z >= least) & (a + b >= 5) & (F.abs(weight) >= strong), weight).otherwise(0.0))
    top = rows.where("w_quality <> 0 OR w_toxic <> 0").toArrow()  # of the sample's features
    f = top.column("feature").to_numpy()
    order = np.argsort(f)
    return f[order], {t: top.column(f"w_{t}").to_numpy()[order] for t in TARGETS}, priors


def scores_of(block_texts: list[str], features: np.ndarray, weights, known: dict) -> dict[str, np.ndarray]:
    """The summed weights of each text's features. ``known``: a token to its places among the features."""
    place = known.setdefault("", {int(f): i for i, f in enumerate(features)})
    out = {t: np.zeros(len(block_texts)) for t in TARGETS}
    for n, t in enumerate(block_texts):
        tokens = t.split()
        if not tokens:
            continue
        have = {place.get(hashed(repetition(tokens)))}
        for x in set(tokens):
            f = known.get(x)
            if f is None:
                f = known[x] = tuple(i for i in (place.get(hashed(y)) for y in token_features(x)) if i is not None)
            if f:
                have.update(f)
        have.discard(None)
        at = sorted(have)
        for target in TARGETS:
            out[target][n] = weights[target][at].sum()
    return out


def calibration(score: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the log-odds of ``label`` over ``score``: logistic regression by damped Newton
    steps, with a weak pull to 0 that keeps separable labels finite."""
    scale = max(float(np.abs(score).max(initial=0.0)), 1e-9)
    x, pull = np.stack([score / scale, np.ones(len(score))], 1), 1e-3

    def loss(w):
        z = x @ w
        return float(np.logaddexp(0.0, z).sum() - label @ z + pull / 2 * w @ w)

    w = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        grad = x.T @ (p - label) + pull * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + pull * np.eye(2), grad)
        t, now = 1.0, loss(w)
        while t > 1e-6 and loss(w - t * step) > now - 1e-4 * t * grad @ step:
            t /= 2
        w = w - t * step
        if np.abs(t * step).max() < 1e-8:
            break
    return float(max(w[0], 0.0) / scale), float(w[1])


def scored(rows: DataFrame, model, keep: list[str]) -> DataFrame:
    """``keep`` columns and the raw score of each target for rows with ``text``."""
    shared, name = rows.sparkSession.sparkContext.broadcast(model), f"bayes-{uuid.uuid4().hex}"

    def run(batches):
        features, weights = shared.value
        for block in text_blocks(batches):
            known = worker_cache(name, REMEMBERED)
            got = scores_of(texts(block), features, weights, known)
            yield pa.RecordBatch.from_arrays([block.column(c) for c in keep] + [pa.array(got[t]) for t in TARGETS],
                                             names=[*keep, *[f"score_{t}" for t in TARGETS]])

    kinds = ", ".join(f"{c} {as_sql_type(rows, c)}" for c in keep)
    return rows.select(*keep, "text").mapInArrow(run, f"{kinds}, " + ", ".join(f"score_{t} double" for t in TARGETS))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", train_rows: int = 20_000,
        least: float = 5.0, strong: float = 2.0):
    """The document classifier: (features, weights) and per target (prior, slope, offset), None without labels."""
    sample = labelled_sample(docs, labels, key, text, train_rows)
    features, weights, priors = feature_weights(stored(count_features(sample), "features"), least, strong)
    held = scored(sample.where("held"), (features, weights), ["key", "quality", "toxic"]).toArrow()  # a part of train_rows
    links = {}
    for t in TARGETS:
        if priors[t] is None:
            links[t] = None
            continue
        given = [(x, float(y > 0)) for x, y in zip(held.column(f"score_{t}").to_pylist(), held.column(t).to_pylist()) if y is not None]
        x, label = (np.array(c, float) for c in zip(*given)) if given else (np.zeros(0), np.zeros(0))
        links[t] = (priors[t], *calibration(x + priors[t], label))
    return (features, weights), links


def logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def shrunk(groups: DataFrame, above: Column, n: str, total: str) -> tuple[DataFrame, Column]:
    """The posterior means of ``groups`` (``n`` documents with probabilities summing to ``total``) under a Beta
    prior around ``above``, whose strength is that of the spread beyond sampling."""
    m = F.col(total) / F.col(n)
    seen = groups.agg(F.sum(F.col(n) * (m - above) ** 2).alias("spread"), F.sum(F.col(n) * above * (1 - above)).alias("noise"),
                      F.sum(n).alias("n"), F.sum(F.col(n) * F.col(n)).alias("nn"), F.count("*").alias("k")).first()
    strength = 1e6
    if seen["n"] and seen["k"] > 1 and seen["noise"]:
        var = seen["noise"] / seen["n"]  # of one document
        excess = seen["spread"] - seen["k"] * var  # what sampling doesn't explain
        between = excess / max(seen["n"] - seen["nn"] / seen["n"], 1e-9)
        if between > 0:
            strength = min(max(var / between - 1, 1.0), 1e6)
    return groups, (F.lit(strength) * above + F.col(total)) / (F.lit(strength) + F.col(n))


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source",
             path: str = "lang", threshold: float = 0.5, train_rows: int = 20_000) -> DataFrame:
    """Per document row: ``key``, ``p_quality``, ``p_toxic``, ``toxic`` and ``kept``
    (not toxic, and of quality with at least ``threshold``)."""
    model, links = fit(docs, labels, key, text, train_rows)
    rows = docs.select(docs[key].alias("key"), docs[host].cast("string").alias("host"), docs[path].cast("string").alias("path"),
                       docs[text].alias("text"))
    rows = scored(rows, model, ["key", "host", "path"])
    for t in TARGETS:
        link = links[t] or (0.0, 0.0, 0.0)
        odds = F.lit(link[1]) * (F.col(f"score_{t}") + F.lit(link[0])) + F.lit(link[2])
        rows = rows.withColumn(f"own_{t}", F.least(F.greatest(odds, F.lit(-20.0)), F.lit(20.0)))
    site = F.struct("host", "path").alias("site")  # a null is a value of its own
    rows = stored(rows.select("key", site, *[f"own_{t}" for t in TARGETS]), "evidence")
    p = {t: 1 / (1 + F.exp(-F.col(f"own_{t}"))) for t in TARGETS}
    paths = rows.groupBy("site").agg(F.count("*").alias("n"), *[F.sum(p[t]).alias(t) for t in TARGETS])
    paths = stored(paths.withColumn("host", F.struct("site.host")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), *[F.sum(t).alias(f"h_{t}") for t in TARGETS])
    every = paths.agg(F.sum("n").alias("n"), *[F.sum(t).alias(t) for t in TARGETS]).first()
    base = {t: min(max((every[t] or 0) / (every["n"] or 1), 1e-6), 1 - 1e-6) for t in TARGETS}
    for t in TARGETS:
        hosts, mean = shrunk(hosts, F.lit(base[t]), "hn", f"h_{t}")
        hosts = hosts.withColumn(f"host_{t}", mean)
    paths = stored(salted_join(paths, hosts, ["host"], "inner"), "sites")
    for t in TARGETS:
        paths, mean = shrunk(paths, F.col(f"host_{t}"), "n", t)
        paths = paths.withColumn(f"shift_{t}", logit(F.least(F.greatest(mean, F.lit(1e-9)), F.lit(1 - 1e-9))) - math.log(base[t] / (1 - base[t])))
    out = salted_join(rows, paths.select("site", *[f"shift_{t}" for t in TARGETS]), ["site"])
    post = {t: 1 / (1 + F.exp(-(F.col(f"own_{t}") + F.coalesce(f"shift_{t}", F.lit(0.0))))) for t in TARGETS}
    toxic = (post["toxic"] >= threshold) if links["toxic"] else F.lit(False)
    good = (post["quality"] >= threshold) if links["quality"] else F.lit(True)
    return out.select(F.col("key").alias(key), *[post[t].alias(f"p_{t}") for t in TARGETS], toxic.alias("toxic"),
                      (good & ~toxic).alias("kept"))
