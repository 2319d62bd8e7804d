import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tests.llm.fixtures import documents, empty, rows
from vendorlens.llm import quality, wordgrams
from vendorlens.llm.common import worker_cache


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    hit = {j for i in range(len(words) - 7) if grams[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit))


def test_base_counts(spark):
    out = quality.assess(documents(spark)).collect()
    order = lambda x: (x[0] is None, x[0] or 0, x[1:])
    want = sorted([(r[0], *base(r[1])) for r in rows()], key=order)
    assert sorted([tuple(r[c] for c in ("doc_id", *quality.COUNTS)) for r in out], key=order) == want
    for r in out:
        fails = r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]
        assert r["base_failed"] == fails and not (fails and r["kept"])
        assert (r["log_perplexity"] is None) == (r["n_words"] == 0)


def test_empty_table(spark):
    assert quality.assess(empty(spark)).count() == 0


def brute_model(texts):
    """Interpolated modified Kneser-Ney by the textbook, on the symbol classes."""
    n = quality.ORDER
    seqs = [[0] * (n - 1) + [int(quality.CLASSES[b]) for b in t.encode()] for t in texts]
    counts = [Counter(tuple(s[i - n + 1:i + 1]) for s in seqs for i in range(n - 1, len(s)))]
    for k in range(n - 1, 0, -1):
        counts.append(Counter(g[1:] for g in counts[-1]))
    counts = counts[::-1]

    def prob(g):
        if not g:
            return 1 / 64
        c = counts[len(g) - 1]
        d = quality.discounts([sum(x == k for x in c.values()) for k in (1, 2, 3, 4)])
        disc = lambda x: d[min(x, 3) - 1]
        same = [x for h, x in c.items() if h[:-1] == g[:-1]]
        if not same:
            return prob(g[1:])
        own = max(c[g] - disc(c[g]), 0) if c[g] else 0
        return own / sum(same) + sum(map(disc, same)) / sum(same) * prob(g[1:])
    return prob


def test_probabilities_are_kneser_ney(spark):
    texts = ["the mill turns", "the hill turns the mill", "Über 12% of mills!", "turn, turn; turn"]
    model = quality.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    prob = brute_model(texts)
    assert all(len(m["gram"]) <= 1 << 6 * (4 - k) and (np.diff(m["gram"]) > 0).all() for k, m in enumerate(model))
    for t in (*texts, "unseen quartz 99", "mill the"):
        grams, _ = quality.grams_of([t.encode()])
        got = quality.probabilities(grams, model)
        want = [prob(tuple(int(g) >> 6 * k & 63 for k in (3, 2, 1, 0))) for g in grams]
        assert np.allclose(got, want, rtol=1e-4), t
    some = [prob((3, 4, 5, x)) for x in range(64)]
    assert math.isclose(sum(some), 1, rel_tol=1e-6)


def test_noise_is_rejected_and_prose_stays(spark):
    rng = np.random.default_rng(5)
    words = ["the", "river", "stone", "turns", "under", "seven", "hills", "slowly", "green", "night", "mill", "of", "and"]
    prose = [(i, " ".join(rng.choice(words, 120)) + ".", "en") for i in range(300)]
    noise = [(1000 + i, " ".join(w + "%%%&&&" for w in rng.choice(words, 120)), "en") for i in range(6)]
    out = {r["doc_id"]: r["kept"] for r in quality.assess(spark.createDataFrame(prose + noise, "doc_id long, text string, lang string")).collect()}
    assert all(out[i] for i, *_ in prose) and not any(out[i] for i, *_ in noise)


def test_words_in_random_order_are_rejected(spark):
    rng = np.random.default_rng(3)
    # all begin and end alike, so no character 4-gram tells which word follows
    names = ["tor" + "".join(rng.choice(list("aeioulmnrst"), 5)) + "ment" for _ in range(400)]
    after = rng.integers(0, 400, (400, 3))  # each word has three that follow it

    def text(i):
        w = [i]
        while len(w) < 200:
            w.append(int(after[w[-1], rng.integers(3)]))
        return [names[k] for k in w]
    ordered = [(i, " ".join(text(i % 400)), "en") for i in range(400)]
    mixed = [(1000 + i, " ".join(rng.permutation(text(i))), "en") for i in range(6)]
    out = {r["doc_id"]: r["kept"] for r in quality.assess(spark.createDataFrame(ordered + mixed, "doc_id long, text string, lang string")).collect()}
    assert sum(out[i] for i, *_ in ordered) >= 390 and not any(out[i] for i, *_ in mixed)


def word_model(texts):
    """Leave-one-out losses of distinct texts by the textbook: counts of the other texts, their discounts from all."""
    texts = sorted(set(t for t in texts if t.split()))
    pairs = {t: Counter(zip(["", *t.split()], t.split())) for t in texts}
    every = sum(pairs.values(), Counter())
    d = [0.0, *quality.discounts([sum(c == k for c in every.values()) for k in (1, 2, 3, 4)])]
    out = {}
    for t in texts:
        other = Counter({p: c - pairs[t][p] for p, c in every.items() if c > pairs[t][p]})
        loss = 0.0
        for (v, w), times in pairs[t].items():
            same = [c for (x, _), c in other.items() if x == v]
            p = 1 / wordgrams.VOCABULARY
            if same:
                p = (max(other[v, w] - d[min(other[v, w], 3)], 0) + sum(d[min(c, 3)] for c in same) * p) / sum(same)
            loss -= times * math.log(p)
        out[t] = loss / len(t.split())
    return out


def word_scores(spark, texts, parts=3):
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(parts)
    hashes = docs.select("text", F.xxhash64("text").alias("text_hash")).distinct()
    return {r["text"]: r["word_loss"] / len(r["text"].split()) for r in wordgrams.word_losses(docs, quality.discounts).join(hashes, "text_hash").collect()}


def random_texts(seed=4, n=60):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(40)]
    return [" ".join(rng.choice(words, rng.integers(1, 60), p=np.arange(1, 41) / 820)) for _ in range(n)]


def test_copies_in_several_blocks_of_a_task(spark, monkeypatch):
    from vendorlens.llm import common
    monkeypatch.setattr(common, "BLOCK_BYTES", 300)
    monkeypatch.setattr(common.text_blocks, "__defaults__", ("text", 300))
    texts = random_texts(n=40)
    want = word_model(texts)
    got = word_scores(spark, texts * 3, 1)
    assert set(got) == set(want) and all(math.isclose(got[t], want[t], rel_tol=1e-6) for t in want)


def test_word_model_leaves_one_out(spark):
    texts = ["the mill turns the wheel", "The hill and the mill", "a mill turns", "turns the mill", "one", "", "one one one"] + random_texts()
    want = word_model(texts)
    for given, parts in ((texts, 1), (texts + texts[:30] + [texts[8]] * 20, 7)):  # copies change nothing
        got = word_scores(spark, given, parts)
        assert set(got) == set(want) and all(math.isclose(got[t], want[t], rel_tol=1e-6) for t in want)


def test_buckets_and_parts_of_contexts(spark, monkeypatch):
    texts = random_texts(n=200)
    monkeypatch.setattr(wordgrams, "BLOCK", 2000)
    monkeypatch.setattr(wordgrams, "BUCKET", 500)
    got = word_scores(spark, texts)
    assert set(got) == set(texts) and all(0 < x < 14 for x in got.values())
    monkeypatch.setattr(wordgrams, "PART", 200)
    assert set(word_scores(spark, texts)) == set(texts)


def test_losses_do_not_depend_on_buckets_and_parts(spark, monkeypatch):
    texts = random_texts(n=80)
    want = word_model(texts)
    monkeypatch.setattr(wordgrams, "BLOCK", 3000)
    for bucket, part in ((300, 1 << 20), (150, 40), (1 << 20, 25)):
        monkeypatch.setattr(wordgrams, "BUCKET", bucket)
        monkeypatch.setattr(wordgrams, "PART", part)
        got = word_scores(spark, texts + texts[:20])
        assert set(got) == set(want) and all(math.isclose(got[t], want[t], rel_tol=1e-6) for t in want), (bucket, part)


def test_tabulated_probabilities(spark):
    texts = ["the mill turns", "the hill turns the mill", "Über 12% of mills!", "turn, turn; turn"]
    for given in (texts, [""]):
        model = quality.train(spark.createDataFrame([(t,) for t in given], "text string"))
        begin, logs = quality.tabulated(model)
        grams = np.concatenate((np.arange(0, 1 << 24, 37, np.int32), model[0]["gram"].astype(np.int32)))
        assert (logs[begin[grams >> 6] + (grams & 63)] == np.log(quality.probabilities(grams, model))).all()


def test_sketch_of_contexts_is_that_of_the_texts(spark):
    docs = documents(spark)
    found = quality.measured(docs, quality.train(docs))
    ours = wordgrams.added_sketch(found.where("piece IS NOT NULL").select("piece", "counts"))
    assert (ours == wordgrams.added_sketch(wordgrams.context_counts(docs))).all() and ours[0].sum() > 0


def test_bands_against_brute_force(spark):
    rng = np.random.default_rng(6)
    table = [(i, float(np.exp(rng.normal(1, 0.3)) * (50 if i % 40 == 0 else 1)), int(rng.integers(5, 400)), [None, "en"][i % 2]) for i in range(600)]
    df = spark.createDataFrame(table, "doc_id long, log_perplexity double, n_words long, lang string")
    got = {r["grp"]["g"]: (r["centre"], r["lower"], r["upper"]) for r in quality.bands(df, 5.0, 200.0, 0.1).collect()}
    for lang in (None, "en"):
        mine = [(round(math.log(x) / quality.BIN), n) for _, x, n, g in table if g == lang and n >= 20]
        middle = lambda xs: sorted(xs)[(len(xs) + 1) // 2 - 1]
        mid = middle([b for b, _ in mine])
        mad = middle([round(abs(b - mid) / (1 + math.sqrt(200 / n))) for b, n in mine])
        reach = max(5 * 1.4826 * mad, 0.1 / quality.BIN)
        assert np.allclose(got[lang], (mid, mid - reach, mid + reach))


def test_kept_follows_the_bands(spark):
    texts = random_texts(n=150) + ["qq%%% " * 30 + "x" * i for i in range(3)] + ["one", "same " * 60]
    docs = spark.createDataFrame([(i, t, ["en", None][i % 2]) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    out = quality.assess(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    rows_ = spark.createDataFrame([(r["lang"], r["n_words"], r["log_perplexity"], r["word_log_perplexity"]) for r in out],
                                  "lang string, n_words long, log_perplexity double, word_log_perplexity double")
    inside = {i: True for i in range(len(texts))}
    for loss in ("log_perplexity", "word_log_perplexity"):
        ends = {r["grp"]["g"]: r for r in quality.bands(rows_, 5.0, 200.0, 0.1, loss=loss).collect()}
        for r in out:
            band = ends[r["lang"]]
            off = (math.log(max(r[loss], 1e-6)) / quality.BIN - band["centre"]) / (1 + math.sqrt(200 / max(r["n_words"], 1)))
            inside[r["doc_id"]] &= band["lower"] - band["centre"] <= off <= band["upper"] - band["centre"]
    assert all(r["kept"] == (not r["base_failed"] and inside[r["doc_id"]]) for r in out)
    assert any(r["kept"] for r in out) and not all(inside.values())


def test_unseen_words_copies_and_unspaced_texts(spark):
    """Words that no other text has score worse than prose, copies don't help, and unspaced languages are kept."""
    rng = np.random.default_rng(7)
    words = [f"{a}{b}" for a in ("mor", "tel", "san", "vig", "lub", "ker") for b in ("a", "ent", "isk", "ov", "um")]
    prose = [" ".join(rng.choice(words, 150, p=np.arange(1, 31) / 465)) for _ in range(200)]
    made = [" ".join("".join(rng.choice(list("bcdfghjklmnpqrstvwxz"), 6)) for _ in range(150)) for _ in range(5)]
    hanzi = [chr(0x4E00 + i) for i in range(600)]
    chinese = ["\n".join("".join(rng.choice(hanzi, rng.integers(150, 400))) for _ in range(rng.integers(25, 40))) for _ in range(120)]
    table = [(i, t, "en") for i, t in enumerate(prose)] + [(1000 + i, made[i % 5 if i < 5 else 0], "en") for i in range(44)]
    table += [(2000 + i, t, "zh") for i, t in enumerate(chinese)]
    out = {r["doc_id"]: r for r in quality.assess(spark.createDataFrame(table, "doc_id long, text string, lang string").repartition(5)).collect()}
    worst = max(out[i]["word_log_perplexity"] for i in range(200))
    assert all(out[1000 + i]["word_log_perplexity"] > worst and not out[1000 + i]["kept"] for i in range(44))
    assert all(out[2000 + i]["kept"] for i in range(120)) and sum(out[i]["kept"] for i in range(200)) >= 198


def test_long_texts(spark):
    rng = np.random.default_rng(8)
    table = [(1, " ".join(rng.choice(["mill", "river", "stone", "hill"], 900_000))), (2, "x" * (6 << 20)), (3, "\n" * 200_000), (4, "mill river")]
    out = {r["doc_id"]: r for r in quality.assess(spark.createDataFrame([(*r, "en") for r in table], "doc_id long, text string, lang string")).collect()}
    assert len(out) == 4 and out[1]["n_words"] == 900_000 and out[2]["word_chars"] == 6 << 20 and out[3]["n_words"] == 0


def test_word_hashes_without_a_table_of_words():
    raw = [b"", b" \t\n", b"mill", b"the mill\x0bturns \x1c\xc2\x85 the " + b"x" * 31 + b" " + b"x" * 32, b"x" * 33 + b"\r" + b"x" * 33 + b" x\x00 x", b"mill"]
    hashes, size = wordgrams.words_of(raw)
    words = [w for t in raw for w in t.split()]
    assert size.tolist() == [len(t.split()) for t in raw] and len(hashes) == len(words)
    assert len(set(zip(words, hashes.tolist()))) == len(set(words)) == len(set(hashes.tolist()))
    many, _ = wordgrams.words_of([b" ".join(b"%d" % i for i in range(400_000))])
    assert len(np.unique(many)) == 400_000 and not worker_cache("word_hashes")
    low = np.bincount((many & np.uint64(1023)).astype(np.int64), minlength=1024)
    assert 0.8 < low.var() / low.mean() < 1.2


def test_tasks_let_go_of_other_operators_caches(spark):
    docs = documents(spark, parts=16)  # enough for every worker

    def left(batches):
        for batch in batches:
            worker_cache("bpe_known")["w"] = 1
            yield batch

    schema = docs.select("text").schema
    assert docs.select("text").mapInArrow(left, schema).count() > 0
    quality.count_grams(docs).count()

    def seen(batches):
        list(batches)
        yield pa.RecordBatch.from_arrays([pa.array([len(worker_cache("bpe_known"))], pa.int64())], names=["n"])

    assert not any(r["n"] for r in docs.select("text").mapInArrow(seen, "n long").collect())


def test_a_portion_is_unpacked_by_itself():
    rng = np.random.default_rng(9)
    hashes = np.unique(rng.integers(0, 1 << 63, 50).astype(np.uint64))
    key = np.sort(rng.integers(0, 1 << 40, 3000).astype(np.uint64)) % np.uint64(500)
    key.sort()
    word, text, count = (rng.integers(0, k, 3000).astype(np.uint32) for k in (1 << 24, len(hashes), 9))
    ctx, *rest = wordgrams.unpacked(wordgrams.packed(key, word, text, count), wordgrams.unpacked_texts(wordgrams.packed_texts(hashes)))
    assert (ctx == key).all() and all((a == b).all() for a, b in zip(rest, (word, hashes[text], count)))
