import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import documents, empty, rows
from vendorlens.llm import bpe
from vendorlens.llm.queries import BYTE_BPE, bpe_digests

pytestmark = pytest.mark.skipif(not os.path.exists(BYTE_BPE), reason="no public vocabulary here")


@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(BYTE_BPE)


def test_blocks_equal_the_library(library):
    with open(BYTE_BPE, encoding="utf-8") as f:
        v = bpe.Vocabulary(f.read())
    rng = random.Random(3)
    texts = ["".join(rng.choice(" \n\t\x1c\x85\xa0abAB'sdlLrevm12é中\U0001F600.,<|endoftext|>　") for _ in range(rng.randint(0, 40)))
             for _ in range(1500)]
    texts += ["aaaaaaa" * 40, "it's I'LL we've", "  lead", "trail  ", "\r\n\r\n", "a<|endoftext|><|endoftext|>b", "x" * 5000]
    known, spaced = {}, {}
    for block in (texts[:700], texts[700:]):
        for t, ids in zip(block, bpe.encode_block(block, v, known, spaced)):
            want = library.encode(t, add_special_tokens=False).ids
            assert bpe.array_of(ids) == want, t
            assert bpe.decode_ids(ids, v) == library.decode(want, skip_special_tokens=False)


def test_rows_and_digests(spark, library):
    got = bpe_digests(documents(spark)).collect()
    want = []
    for r in rows():
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        want.append((r[0], len(ids), hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest(),
                     hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    order = lambda x: (x[0] is None, x[0] or 0, x[2])
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)


def test_round_trip_and_empty(spark):
    out = bpe.encode_decode(documents(spark), BYTE_BPE)
    assert out.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    texts = {r[0]: r[1] or "" for r in rows() if r[0] is not None and r[0] != 3}
    back = {r["doc_id"]: r["decoded"] for r in out.where("doc_id IS NOT NULL AND doc_id <> 3").collect()}
    assert back == texts
    assert bpe.encode_decode(empty(spark), BYTE_BPE).count() == 0


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        bpe.Vocabulary('{"model": {"type": "WordPiece", "vocab": {}, "merges": []}, "pre_tokenizer": null}')


def test_early_ranks_as_arrays_equal_the_library(library, monkeypatch):
    """Runs of one symbol, words that meet other words in a block, and every place where the array merges may end."""
    with open(BYTE_BPE, encoding="utf-8") as f:
        v = bpe.Vocabulary(f.read())
    monkeypatch.setattr(bpe, "LARGE", 1)
    rng = random.Random(5)
    words = ["aaaaaaa", "eeee", "nnnnn", "inining", "erererer", "thethethe", "é中文", "x's", "(on)", "a\nb", "'ll", "onon\tan"]
    words += ["".join(rng.choice(["th", "er", "on", "an", "in", "s", "e", ",", "7", "ß"]) for _ in range(rng.randint(1, 9))) for _ in range(400)]
    texts = [rng.choice(["", " ", "\n"]) + " ".join(rng.choice(words) for _ in range(rng.randint(0, 60))) + rng.choice(["", " ", ".", " <|endoftext|> a b c"])
             for _ in range(150)] + ["", " ", "a b", "a  b c d"]
    for early in (0, 3, 500, len(v.merge)):
        monkeypatch.setattr(bpe, "EARLY", early)
        for t, ids in zip(texts, bpe.encode_block(texts, v, {}, {})):
            assert bpe.array_of(ids) == library.encode(t, add_special_tokens=False).ids, (early, t)


def test_words_in_use_are_merged_once(monkeypatch):
    """What a worker forgets when it knows too many pre-tokens is not what all its blocks use."""
    with open(BYTE_BPE, encoding="utf-8") as f:
        v = bpe.Vocabulary(f.read())
    v.name = "words in use"
    merged, merge_words = [], bpe.merge_words
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    monkeypatch.setattr(bpe, "merge_words", lambda words, v: merged.extend(words) or merge_words(words, v))
    for k in range(30):
        bpe.encode_block(["begin river stone hills " + " ".join(f"w{k}x{i}" for i in range(7)) + " end"], v, *bpe.remembered(v))
        assert sum(map(len, bpe.remembered(v))) < 100
    assert [merged.count(x) for x in ("begin", " river", " stone", " hills", " end")] == [1] * 5
