import hashlib
import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tests.llm.fixtures import documents, empty
from tests.llm.test_jaccard import brute as components
from vendorlens.llm.queries import BYTE_BPE

pytestmark = pytest.mark.skipif(not os.path.exists(BYTE_BPE), reason="no public vocabulary here")


@pytest.fixture(scope="module")
def folder(spark, sf_dir, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("pipe"))
    spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(6).write.parquet(f"{d}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/benchmark.parquet").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_stages_against_brute_force(spark, folder):
    tokenizers = pytest.importorskip("tokenizers")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        docs = cp.stored(out, "test")
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    ruled, lined, single, clean = kept.values()
    assert set(lined) == set(ruled) and set(single) < set(lined) and set(clean) <= set(single)
    table = sorted(lined.items())
    assert set(single) == {k for k, _, c in components(table) if c == k}
    items = spark.read.parquet(f"{folder}/benchmark.parquet").collect()
    assert set(clean) == {k for k, t in single.items() if not contaminated(t, [r["text"] for r in items])}
    library = tokenizers.Tokenizer.from_file(BYTE_BPE)
    final = {r["doc_id"]: r["ids_sha256"] for r in cp.run(spark, folder).collect()}
    assert final == {k: hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in library.encode(t, add_special_tokens=False).ids)).hexdigest()
                     for k, t in clean.items()}


def contaminated(text, items):
    import re
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    w, hit = words(text), set()
    for item in map(words, items):
        n = min(13, len(item))
        grams = {tuple(item[i:i + n]) for i in range(len(item) - n + 1)} if item else set()
        for i in range(len(w) - n + 1):
            if tuple(w[i:i + n]) in grams:
                hit.update(range(i, i + n))
    return bool(hit) and 20 * len(hit) >= len(w)


def test_edge_rows(spark, folder):
    for docs in (documents(spark), empty(spark)):
        for _, stage in cp.STAGES[:-1]:
            out = stage(spark, docs, folder)
            assert out.columns == docs.columns
            docs = cp.stored(out, "edges")
        cp.STAGES[-1][1](spark, docs, folder).count()


def test_clashing_columns_and_long_texts(spark, folder):
    """Columns named like ours keep their values; texts beyond a block go through every stage."""
    import random
    from tests.llm.fixtures import sentence
    rng = random.Random(11)
    ours = ["__lines", "__row", "__salt", "row", "doc", "n_lines", "kept", "component_id", "key", "h", "text_hash"]
    texts = [sentence(rng, 700_000), sentence(rng, 300), sentence(rng, 80) + "\n" * 300_000] + [sentence(rng, 60) for _ in range(8)]
    table = [(i, t, "en", *[f"{c}{i}" for c in ours]) for i, t in enumerate(texts)]
    given = spark.createDataFrame(table, "doc_id long, text string, lang string, " + ", ".join(f"{c} string" for c in ours)).repartition(4)
    docs = given
    for name, stage in cp.STAGES[:-1]:
        docs = cp.stored(stage(spark, docs, folder), "clash")
        assert docs.columns == given.columns, name
        rows = docs.collect()
        assert all(r[c] == f"{c}{r['doc_id']}" for r in rows for c in ours), name
    assert {r["doc_id"]: r["text"] for r in rows}.items() <= dict(enumerate(texts)).items() and len(rows) >= 8
    assert cp.STAGES[-1][1](spark, docs, folder).count() == len(rows)


def test_near_duplicates_of_several_tasks(spark, folder):
    """Shingles that meet only after the shuffle, with keys whose parts are never null."""
    docs = documents(spark, 9)
    out = cp.near_duplicates(spark, docs, folder).collect()
    texts = [r["text"] for r in out if r["text"] and r["text"].split()]
    assert 0 < len(out) < docs.count() and len(texts) == len(set(texts))


def test_verdicts_apply_to_their_own_rows(spark, folder):
    from tests.llm.fixtures import sentence
    import random
    rng = random.Random(3)
    texts = [sentence(rng, 60) for _ in range(6)]
    table = [(None, t, "en") for t in texts] + [(7, "too short", "en"), (None, "bad", "en"), (7, sentence(rng, 60), "en")]
    docs = spark.createDataFrame(table, "doc_id long, text string, lang string")
    out = cp.quality_rules(spark, docs, folder).collect()
    assert {r["text"] for r in out if r["doc_id"] is None} == set(texts) and [r["text"] for r in out if r["doc_id"] == 7] == [table[-1][1]]
    rows = [(None, texts[0], "en"), (None, texts[0] + " end", "en"), (5, texts[1], "en"), (5, texts[1], "en"), (None, texts[1], "en"),
            (5, texts[2], "en"), (None, None, "en"), (None, None, "en")]
    out = cp.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string"), folder).collect()
    got = [(r["doc_id"], r["text"]) for r in out]
    assert sorted(t for k, t in got if k == 5) == sorted(texts[1:3])
    assert len(got) == 5 and len([t for k, t in got if k is None and t]) == 1
