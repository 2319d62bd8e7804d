import math
import random
import re
from collections import Counter

import numpy as np

from tests.llm.fixtures import documents, empty, rows, sentence
from vendorlens.llm import search

ITEMS = "item_id long, text string, doc_id long, term string, score long, shard int"


def words(t):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute(table, items, k=10):
    docs = [(i, Counter(words(t)), len(words(t))) for i, t in table if words(t)]
    n, total = len(docs), sum(d[2] for d in docs)
    df = Counter(w for _, c, _ in docs for w in c)
    terms = {}
    for i, t in items:
        if i is not None and t is not None:
            terms.setdefault(i, set()).update(words(t))
    out = []
    for i, ts in terms.items():
        scored = []
        for key, tf, size in docs:
            m = 10 + 90 * size * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * tf[t] // (1000 * tf[t] + 8 * m)) for t in ts if t in tf)
            if s > 0:
                scored.append((-s, key is None, key or 0, key))
        out += [(i, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return ordered(out)


def ordered(table):
    return sorted(table, key=lambda r: r[:2])


def items_of(spark, table):
    return spark.createDataFrame([(i, t, 1, "t", 2, 3) for i, t in table], ITEMS)


def some_items(rng):
    out = [(i, sentence(rng, rng.randint(1, 40))) for i in range(12)]
    return out + [(3, "river OF stone"), (None, "of the river"), (50, None), (51, ""), (52, "wordthatisnowhere"), (53, "x" * 3000 + " 中文")]


def test_against_all_scores(spark):
    rng = random.Random(5)
    items = some_items(rng)
    want = brute([(r[0], r[1]) for r in rows()], items)
    for parts in (1, 9):
        got = search.rank(documents(spark, parts), items_of(spark, items)).collect()
        assert ordered(map(tuple, got)) == want


def test_many_shards_groups_and_bits(spark, monkeypatch):
    """Small shards, item groups, steps and a small bit table give the same rows."""
    rng = random.Random(6)
    items = some_items(rng)
    want = brute([(r[0], r[1]) for r in rows()], items)
    for name, value in (("SHARD_POSTINGS", 40), ("ITEM_GROUP", 3), ("CELLS", 5), ("SLOTS", 1 << 15)):
        monkeypatch.setattr(search, name, value)
    got = search.rank(documents(spark, 3), items_of(spark, items)).collect()
    assert ordered(map(tuple, got)) == want


def test_copies_tie_by_key(spark):
    table = [(i, "alpha beta gamma") for i in range(40, 0, -1)] + [(0, "beta delta"), (99, "delta epsilon")]
    docs = spark.createDataFrame(table, "doc_id long, text string").repartition(3)
    items = [(1, "gamma alpha"), (2, "delta")]
    got = ordered(map(tuple, search.rank(docs, items_of(spark, items)).collect()))
    assert got == brute(table, items) and [r[2] for r in got if r[0] == 1] == list(range(1, 11))


def test_long_text(spark):
    rng = random.Random(8)
    long = sentence(rng, 700_000)
    assert len(long) > 4 << 20
    table = [(1, long), (2, "river " * 900_000), (3, "of the river"), (4, "x" * (5 << 20))]
    items = [(1, "river stone hills"), (2, long[:200_000])]
    docs = spark.createDataFrame(table, "doc_id long, text string").repartition(2)
    assert ordered(map(tuple, search.rank(docs, items_of(spark, items)).collect())) == brute(table, items)


def test_empty(spark):
    assert search.rank(empty(spark), items_of(spark, [(1, "a b")])).count() == 0
    assert search.rank(documents(spark), items_of(spark, [])).count() == 0


def test_search_scores_few_documents():
    """Bounds leave most documents unscored where few are good."""
    rng = np.random.default_rng(1)
    n = 5000
    lists = [(np.sort(rng.choice(n, 2000, False)), np.ones(2000, np.int64), 10), (np.array([17, 400, 4000]), np.ones(3, np.int64), 9000)]
    shard = search.Shard(np.arange(n), rng.integers(50, 60, n), lists, n, 55 * n)
    seen = []
    maxima = shard.maxima
    shard.maxima = lambda a, b: (seen.append(len(a)), maxima(a, b))[1]
    docs, scores = shard.search([0, 1], 3)
    assert sorted(docs) == [17, 400, 4000] and sum(seen) < 200
