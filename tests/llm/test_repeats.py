import random
import re

import numpy as np
import pytest

from tests.llm.fixtures import documents, empty, rows
from vendorlens.llm import repeats


def brute(table, size=20):
    order = sorted(range(len(table)), key=lambda i: (table[i][0] is None, table[i][0] or 0))
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in table]
    first = {}
    for i in order:
        k = (table[i][0] is None, table[i][0] or 0)
        for p in range(len(words[i]) - size + 1):
            g = tuple(words[i][p:p + size])
            first[g] = min(first.get(g, (k, p)), (k, p))
    out = []
    for i, (key, _) in enumerate(table):
        k = (key is None, key or 0)
        gone = {j for p in range(len(words[i]) - size + 1) if first[tuple(words[i][p:p + size])] < (k, p) for j in range(p, p + size)}
        out.append((key, len(words[i]), len(gone), " ".join(w for j, w in enumerate(words[i]) if j not in gone)))
    return out


def ordered(table):
    return sorted(table, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


@pytest.mark.parametrize("parts, seed", [(1, 7), (9, 7), (25, 8)])
def test_against_all_windows(spark, parts, seed):
    got = repeats.remove_repeats(documents(spark, parts, seed=seed))
    assert ordered(map(tuple, got.collect())) == ordered(brute([(r[0], r[1]) for r in rows(seed=seed)]))


def test_shifted_passages(spark):
    rng = random.Random(2)
    fresh = lambda n: [f"{rng.randint(0, 10 ** 6)}" for _ in range(n)]
    passages = [fresh(rng.choice([19, 20, 21, 35, 90])) for _ in range(12)] + [["la"] * 45, ["do", "re"] * 30]
    table = []
    for i in range(90):
        words = []
        for _ in range(rng.randint(1, 4)):
            p = rng.choice(passages)
            cut = rng.randint(0, 12)
            words += fresh(rng.randint(0, 9)) + p[cut:cut + rng.randint(15, 90)]
        table.append((i, " ".join(words)))
    docs = spark.createDataFrame(table, "doc_id long, text string").repartition(11)
    assert ordered(map(tuple, repeats.remove_repeats(docs).collect())) == ordered(brute(table))


@pytest.mark.parametrize("rows_a_batch", [1, 3])
def test_names_that_go_on_in_the_next_batch(spark, rows_a_batch):
    """Passages that all texts share, in blocks of one text each and batches of a few rows."""
    rng = random.Random(6)
    shared = [f"s{i}" for i in range(70)]
    table = [(i, " ".join([f"{rng.randint(0, 10 ** 6)}" for _ in range(8)] + shared[rng.randint(0, 9):] + [f"e{i}"])) for i in range(60)]
    table += [(None, table[5][1]), (7, table[9][1])]
    docs = spark.createDataFrame(table, "doc_id long, text string").repartition(60)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows_a_batch)
    try:
        got = ordered(map(tuple, repeats.remove_repeats(docs).collect()))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == ordered(brute(table))


def test_long_texts(spark):
    rng = random.Random(7)
    long = " ".join(f"{rng.randint(0, 10 ** 9)}" for _ in range(450_000))
    assert len(long) > 4 << 20
    table = [(1, long), (2, long[1_000_000:2_000_000]), (3, "same " * 900_000), (4, "z" * (5 << 20)), (5, "\n" * 200_000)]
    got = {r["doc_id"]: r for r in repeats.remove_repeats(spark.createDataFrame(table, "doc_id long, text string").repartition(3)).collect()}
    assert got[1]["n_removed"] == 0 and got[2]["n_words"] - got[2]["n_removed"] <= 2 and got[5]["n_words"] == 0
    assert got[3]["n_removed"] == 899_980 + 19 and got[4]["kept"] == "z" * (5 << 20)


def test_equal_windows_share_their_anchor():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 40, 4000).astype(np.uint64)
    h[3000:3500] = h[100:600]
    doc, size = np.zeros(len(h), np.int64), 20
    whole = repeats.windows_of(h, size)
    start = np.arange(len(whole))
    name, place, _ = repeats.anchors_of(h, doc, start, whole, size)
    same = slice(100, 100 + 500 - size), slice(3000, 3000 + 500 - size)
    assert (name[same[0]] == name[same[1]]).all() and (place[same[0]] + 2900 == place[same[1]]).all()
    assert len(np.unique(place)) < len(start) / 2  # anchors are shared by windows


def test_empty(spark):
    assert repeats.remove_repeats(empty(spark)).count() == 0
