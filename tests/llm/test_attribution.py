import os

import numpy as np
import pytest

from tests.llm.fixtures import documents, empty, rows
from vendorlens.llm import attribution, bpe
from vendorlens.llm.queries import BYTE_BPE

pytestmark = pytest.mark.skipif(not os.path.exists(BYTE_BPE), reason="no public vocabulary here")


def brute(text, library):
    """Owners by the rule, from the tokens' bytes, one token at a time."""
    with open(BYTE_BPE, encoding="utf-8") as f:
        v = bpe.Vocabulary(f.read())
    bounds = [0] + [i + 1 for i, c in enumerate(text) if c == "\n" and i + 1 < len(text)]
    ends = [*bounds[1:], len(text)]
    char_of = [i for i, c in enumerate(text) for _ in c.encode()]
    count, crossing, at = [0] * len(bounds), 0, 0
    for t in library.encode(text, add_special_tokens=False).ids:
        n = len(v.token_bytes[t])
        a, b = char_of[at], char_of[at + n - 1] + 1
        at += n
        share = [max(0, min(b, e) - max(a, s)) for s, e in zip(bounds, ends)]
        count[share.index(max(share))] += 1
        crossing += sum(x > 0 for x in share) > 1
    return count, crossing


def test_rule(spark):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(BYTE_BPE)
    more = ["a\n\n\nb", "x\n\n", "\n", "a \n\n  b", "中文\n\U0001F600 y"]
    table = [(i, r[1]) for i, r in enumerate(rows())] + [(500 + i, t) for i, t in enumerate(more)]
    got = {r["doc_id"]: r for r in attribution.token_counts(spark.createDataFrame(table, "doc_id long, text string"), BYTE_BPE).collect()}
    for i, t in table:
        r = got[i]
        count, crossing = brute(t, library) if t else ([], 0)
        assert (list(r["section_tokens"]), r["n_crossing"], r["n_tokens"], r["n_sections"]) == (count, crossing, sum(count), len(count)), t
    assert any(r["n_crossing"] for r in got.values())


def test_boundary_crossing_goes_to_the_larger_then_earlier_part():
    n, crossing = attribution.allocate(np.array([0, 2, 6]), np.array([2, 6, 7]), np.array([0, 3, 5]), 7)
    assert n.tolist() == [1, 1, 1] and crossing == 1  # characters 2 | 3 4 | 5
    n, _ = attribution.allocate(np.array([0]), np.array([4]), np.array([0, 2]), 4)
    assert n.tolist() == [1, 0]


def test_fields_and_edges(spark):
    out = attribution.token_counts(documents(spark), BYTE_BPE, fields=("lang", "text", "source")).collect()
    assert all(sum(r["section_tokens"]) == r["n_tokens"] and r["n_sections"] == 3 for r in out)
    assert len(out) == len(rows())
    assert attribution.token_counts(empty(spark), BYTE_BPE).count() == 0
