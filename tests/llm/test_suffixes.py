import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.fixtures import documents, empty, rows, sentence
from vendorlens.llm import suffixes
from vendorlens.llm.common import worker_cache


def brute(table, size=200):
    """table: (key, text)."""
    raw = [(t or "").encode() for _, t in table]
    seen = Counter(r[i:i + size] for r in raw for i in range(len(r) - size + 1))
    out = []
    for (key, _), r in zip(table, raw):
        cover = np.zeros(len(r) + 1, int)
        for i in range(len(r) - size + 1):
            if seen[r[i:i + size]] > 1:
                cover[i] += 1
                cover[i + size] -= 1
        gone = np.cumsum(cover)[:-1] > 0
        spans = int((gone & ~np.concatenate(([False], gone[:-1]))).sum()) if len(r) else 0
        out.append((key, len(r), int(gone.sum()), spans, bytes(np.frombuffer(r, np.uint8)[~gone])))
    return ordered(out)


def ordered(table):
    return sorted(table, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def result(docs, **kw):
    return ordered((r[0], r[1], r[2], len(r[3]), bytes(r[4])) for r in suffixes.remove_repeated_bytes(docs, **kw).collect())


@pytest.mark.parametrize("parts, seed, size", [(1, 7, 200), (9, 7, 200), (5, 8, 40), (3, 9, 16)])
def test_against_all_windows(spark, parts, seed, size):
    want = brute([(r[0], r[1]) for r in rows(seed=seed)], size)
    assert result(documents(spark, parts, seed=seed), length=size) == want and any(r[2] for r in want)


def cut_passages():
    rng = random.Random(2)
    fresh = lambda n: bytes(rng.choices(b"abcdefgh \n", k=n)).decode()
    passages = [fresh(rng.choice([199, 200, 201, 260, 900])) for _ in range(10)] + ["é中" * 120, "ab" * 300, "q" * 700]
    table = []
    for i in range(120):
        text = ""
        for _ in range(rng.randint(1, 4)):
            p = rng.choice(passages)
            cut = rng.randint(0, 40)
            text += fresh(rng.randint(0, 90)) + p[cut:cut + rng.randint(150, 900)]
        table.append((i, text))
    return table


@pytest.mark.parametrize("together", [20_000, 3])
def test_shifted_passages(spark, monkeypatch, together):
    """Repeats with other surroundings each time; ranks split by window names give the same rows."""
    monkeypatch.setattr(suffixes, "TOGETHER", together)
    table = cut_passages()
    docs = spark.createDataFrame(table, "doc_id long, text string").repartition(11)
    assert result(docs) == brute(table)


def test_pieces_of_texts(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE", 700)
    table = cut_passages()
    assert result(spark.createDataFrame(table, "doc_id long, text string").repartition(4)) == brute(table)


def test_threshold_and_copies(spark):
    rng = random.Random(3)
    a, b = sentence(rng, 80), sentence(rng, 80)
    table = [(1, a), (None, a), (1, a), (4, b), (5, "x" + b[:199] + "y"), (6, "z" + b[100:300] + "w"),
             (7, "s" * 199), (8, "s" * 200), (9, "t" * 201), (10, None), (11, ""), (12, "s" * 30)]
    docs = spark.createDataFrame(table, "doc_id long, text string").repartition(5)
    got = result(docs)
    assert got == brute(table)
    gone = {r[0]: r[2] for r in got}
    assert gone[5] == 0 and gone[6] == 200 and gone[8] == 0 and gone[9] == 201


def test_long_texts(spark):
    rng = random.Random(4)
    long = sentence(rng, 700_000)
    assert len(long) > 4 << 20
    table = [(1, long), (2, long[1_000_000:1_300_000] + "!"), (3, " " * (5 << 20)), (4, "\n" * 400_000), (5, " " * 250)]
    got = {r[0]: r for r in result(spark.createDataFrame(table, "doc_id long, text string").repartition(2))}
    assert got[1][2:4] == (300_000, 1) and got[1][4] == (long[:1_000_000] + long[1_300_000:]).encode()
    assert got[2][2:] == (300_000, 1, b"!") and [got[i][2] for i in (3, 4, 5)] == [5 << 20, 400_000, 250]


def test_periodic_text_has_few_anchors():
    shape = suffixes.Shape(200)
    for text in (b"a" * 100_000, b"ab" * 50_000, b"abcde" * 20_000):
        assert len(shape.anchors([text])[0]) < len(text) / 40


def test_anchors_are_sparse_and_follow_content():
    rng = np.random.default_rng(5)
    text = rng.integers(97, 123, 50_000).astype(np.uint8).tobytes()
    shape = suffixes.Shape(200)
    _, first, last, at, *_ = shape.anchors([text])
    assert len(at) < len(text) / 60 and first[0] == 0 and last[-1] == len(text) - 200
    assert (first[1:] == last[:-1] + 1).all() and ((first <= at) & (at - first < shape.gap)).all()
    cut = shape.anchors([text[10_003:30_000]])[3] + 10_003
    assert set(cut[2:-2]) <= set(at)


def test_empty(spark):
    assert result(empty(spark)) == []


def test_memory_of_a_piece():
    """What a task holds for its texts' anchors is bounded well below an executor's share, whatever the texts' length."""
    import tracemalloc
    rng = np.random.default_rng(6)
    texts = [rng.integers(97, 123, 2000).astype(np.uint8).tobytes().decode() for _ in range(1500)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(1500)), pa.array([1] * 1500), pa.array(texts)], names=["h", "tag", "text"])
    worker_cache("suffix_powers").clear()
    tracemalloc.start()
    for held in suffixes.pieces_of([batch], 200):
        suffixes.Shape(200).anchors([x[3] for x in held])
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 80 << 20
