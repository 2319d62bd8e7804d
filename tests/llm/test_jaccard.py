import re
from collections import defaultdict

import numpy as np
import pytest

from tests.llm.fixtures import documents, empty, rows
from vendorlens.llm import jaccard
from vendorlens.llm.components import components


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(table):
    sets, root = [shingles(t) for _, t in table], list(range(len(table)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    low = defaultdict(list)
    for i, (k, _) in enumerate(table):
        if k is not None:
            low[find(i)].append(k)
    return [(k, len(sets[i]), (min(low[find(i)], default=None) if sets[i] else k)) for i, (k, _) in enumerate(table)]


def ordered(table):
    return sorted(table, key=lambda r: tuple((x is None, x or 0) for x in r))


@pytest.mark.parametrize("seed", [7, 8])
def test_components(spark, seed):
    got = jaccard.near_duplicates(documents(spark, seed=seed))
    assert ordered(map(tuple, got.collect())) == ordered(brute([(r[0], r[1]) for r in rows(seed=seed)]))


def test_near_copies_of_one_text(spark):
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(80)]
    table = []
    for i in range(150):
        w = list(words)
        for j in rng.integers(0, 80, rng.integers(0, 4)):
            w[j] = f"x{i}"
        table.append((i, " ".join(w)))
    docs = spark.createDataFrame(table, "doc_id long, text string").repartition(5)
    assert ordered(map(tuple, jaccard.near_duplicates(docs).collect())) == ordered(brute(table))


def test_all_links(spark):
    table = [(r[0], r[1]) for r in rows() if r[0] is not None]
    links, member = jaccard.all_links(spark.createDataFrame(table, "doc_id long, text string"))
    sets = {}
    for r in member.collect():
        sets.setdefault(r["node"], []).append(r["doc_id"])
    got = {(r["a"], r["b"]): r["overlap"] for r in links.collect()}
    texts = {}
    for k, t in table:
        texts.setdefault(k, t)
    each = {n: shingles(texts[k[0]]) for n, k in sets.items() if n is not None and k[0] != 3}
    names = sorted(each)
    want = {(a, b): len(each[a] & each[b]) for i, a in enumerate(names) for b in names[i + 1:]
            if 100 * len(each[a] & each[b]) >= 80 * len(each[a] | each[b])}
    assert {k: v for k, v in got.items() if k[0] in each and k[1] in each} == want


def test_empty(spark):
    assert jaccard.near_duplicates(empty(spark)).count() == 0


def test_component_labels(spark):
    chain = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (103, 102), (101, 103)]
    got = dict(map(tuple, components(spark.createDataFrame(chain, "u long, v long")).collect()))
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 104)}}


def unlike_copies(n=150):
    """Texts that share most shingles with one another, and changes with some, but few of them enough."""
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(300)]
    table = []
    for i in range(n):
        w = list(words)
        for j in rng.choice(300, 10, replace=False):
            w[j] = f"x{j}y{rng.integers(3)}"
        table.append((i, " ".join(w)))
    return table


def test_pairs_below_the_threshold_are_not_counted(spark):
    """Signatures settle pairs that can't link, so the overlaps that are counted grow with the links, not with a group's square."""
    table = unlike_copies()
    join = jaccard.Join(spark.createDataFrame(table, "doc_id long, text string").repartition(5), "doc_id", "text", 5, 4, 5)
    pairs = jaccard.stored(join.all_pairs(join.mixed(None)))
    assert pairs.count() > 500 and join.sized(pairs).count() <= join.verify(pairs).count() + pairs.count() // 10


def test_pairs_that_signatures_rule_out_are_not_made(spark):
    """All pairs of the lists that may link are rows, and hardly any other, so that rows don't grow with the square of a group's size."""
    table = unlike_copies()
    join = jaccard.Join(spark.createDataFrame(table, "doc_id long, text string").repartition(5), "doc_id", "text", 5, 4, 5)
    every = jaccard.stored(join.all_pairs(join.mixed(None)))
    made = jaccard.stored(join.all_pairs(join.signed(join.mixed(None))))
    links = {tuple(r) for r in join.verify(every).collect()}
    assert {tuple(r) for r in join.verify(made).collect()} == links
    assert len(links) <= made.count() <= len(links) + every.count() // 10


def test_signatures_bound_the_overlap():
    rng = np.random.default_rng(7)
    for size in (1, 5, 400, 5000):
        a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
        b = np.unique(np.concatenate((a[size // 7:], rng.integers(0, 1 << 63, size // 5).astype(np.uint64))))
        bits = np.bitwise_count((jaccard.signature(a) ^ jaccard.signature(b)).view(np.uint64)).sum()
        assert bits <= len(np.setxor1d(a, b)) and jaccard.signature(a).size * 64 == jaccard.SIGNATURE


def test_rows_without_a_partner_leave_the_buckets(spark):
    """A row stays if its set and place allow a link with another set of its shingle: with brute force over all pairs."""
    table = unlike_copies(40) + [(100 + i, t) for i, (_, t) in enumerate(unlike_copies(40))] + [(200, " ".join(f"w{i}" for i in range(60)))]
    join = jaccard.Join(spark.createDataFrame(table, "doc_id long, text string").repartition(5), "doc_id", "text", 5, 4, 5)
    index = jaccard.prefixes(join.sets, join.order, 4, 5).collect()
    by = defaultdict(list)
    for r in index:
        by[r["h"]].append(r)
    need = {(x["h"], x["node"]) for group in by.values() for x in group for y in group if x["node"] != y["node"]
            and 9 * (x["n"] - x["pos"]) >= 4 * (x["n"] + y["n"]) and 9 * (y["n"] - y["pos"]) >= 4 * (x["n"] + y["n"])}
    got = {(r["h"], r["node"]) for r in join.buckets.collect()}
    several = {(x["h"], x["node"]) for group in by.values() for x in group if len(group) > 1}
    assert need <= got < several
