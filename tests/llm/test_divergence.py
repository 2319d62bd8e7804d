import random
import re
from collections import Counter, defaultdict

import numpy as np

from tests.llm.fixtures import documents, empty, rows, sentence
from vendorlens.llm import divergence


def words(t):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))


def brute(table, min_docs=30, added=5, top=50):
    """table: (text, lang, source)."""
    df, count = defaultdict(Counter), defaultdict(Counter)
    for t, lang, source in table:
        w = words(t)
        df[lang or ""].update(set(w))
        count[lang or "", source or ""].update(w)
    out = []
    for lang in df:
        kept = sorted((t for t, n in df[lang].items() if n >= min_docs), key=str.encode)
        groups = [g for g in count if g[0] == lang]
        n = {g: sum(count[g][t] for t in kept) for g in groups}
        rate = lambda c, total: 1 + 10 ** 9 * (c + added) // (total + added * len(kept))
        whole = [rate(sum(count[g][t] for g in groups), sum(n.values())) for t in kept]
        p = {g: [rate(count[g][t], n[g]) for t in kept] for g in groups}
        for g in groups:
            pairs = [(-sum(abs(a - b) for a, b in zip(p[g], p[h])), h[1].encode(), h[1]) for h in groups if h != g]
            out += [(*g, "pair", x[2], -x[0], r + 1) for r, x in enumerate(sorted(pairs))]
            terms = [(q - a, t.encode(), t) for t, a, q in zip(kept, p[g], whole) if count[g][t] and a > q]
            out += [(*g, "term", x[2], -x[0], r + 1) for r, x in enumerate(sorted(terms)[:top])]
    return sorted(out)


def table_of(data):
    return [(r[1], r[2], r[3]) for r in data]


def test_against_all_counts(spark):
    for parts, least in ((1, 30), (9, 3)):
        got = divergence.audit(documents(spark, parts), min_docs=least)
        assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
        assert sorted(map(tuple, got.collect())) == brute(table_of(rows()), least)


def test_many_shards_and_pieces(spark, monkeypatch):
    for name, value in (("CELLS", 1), ("LEAST", 4), ("MOST", 4), ("GATHERED", 500)):
        monkeypatch.setattr(divergence, name, value)
    got = divergence.audit(documents(spark, 3), min_docs=2, top=7)
    assert sorted(map(tuple, got.collect())) == brute(table_of(rows()), 2, top=7)


def test_no_kept_terms_and_empty_groups(spark):
    table = [("a b", "en", "x"), ("123", "en", "y"), (None, "en", None), ("c", None, "x"), ("", "", "z")]
    docs = spark.createDataFrame([(*r, 1) for r in table], "text string, lang string, source string, item int")
    assert sorted(map(tuple, divergence.audit(docs).collect())) == brute(table)
    assert divergence.audit(empty(spark)).count() == 0


def test_long_text(spark):
    rng = random.Random(4)
    table = [(sentence(rng, 700_000), "en", "x"), ("y" * (5 << 20), "en", "x"), ("中" * (2 << 20), "en", "y")]
    table += [(sentence(rng, 30), "en", "y") for _ in range(8)]
    docs = spark.createDataFrame(table, "text string, lang string, source string").repartition(3)
    assert sorted(map(tuple, divergence.audit(docs, min_docs=5).collect())) == brute(table, 5)


def test_transducer_is_minimal_and_orders():
    rng = random.Random(1)
    terms = sorted({bytes(rng.choices(b"abc", k=rng.randint(1, 7))) for _ in range(400)})
    machine = divergence.Transducer.loaded(divergence.Transducer.build(terms).dumped())
    others = [b"", b"abcabcabca", b"d", b"ad"]
    assert machine.ordinals(terms + others).tolist() == list(range(len(terms))) + [-1] * 4
    assert [machine.term(i) for i in range(len(terms))] == terms
    rest = {t[:i] for t in terms for i in range(len(t) + 1)}
    classes = {frozenset(t[len(p):] for t in terms if t.startswith(p)) for p in rest}
    assert len(machine.final) == len(classes)  # one state per set of continuations


def test_rates_are_exact_beyond_doubles():
    count = np.array([0, 7, 10 ** 13, 9 * 10 ** 14], np.int64)
    total = 3 * 10 ** 15 + 1
    assert divergence.rates(count, total).tolist() == [1 + 10 ** 9 * int(c) // total for c in count]
