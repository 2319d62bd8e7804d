"""Small tables with the cases that every operator must define a result for."""

import random

WORDS = "the of and river stone quietly runs over under seven green hills where old mills turn slowly by night".split()
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "key string, n_words string, row string, part int, grp string, tag string, host string, path string, node string, h int")


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 999)) * (rng.random() < 0.3) for _ in range(n))


def rows(seed=7, n=60):
    rng = random.Random(seed)
    texts = [sentence(rng, rng.randint(1, 120)) for _ in range(n)]
    passage = sentence(rng, 60)
    out = [None, "", " \n\t ", "one", "a b c d", "x" * 3000, "buy now " * 80, "same " * 50]
    out += texts
    for t in texts[:6]:
        out += [t, t.upper(), t + " tail", t.replace(" ", "  \n")]
    for t in texts[6:20]:
        words = t.split()
        at = rng.randint(0, len(words))
        out.append(" ".join(words[:at]) + "\n" + passage + "\n" + " ".join(words[at:]))
    for t in texts[20:30]:
        w = t.split()
        w[len(w) // 2] = "changed"
        out.append(" ".join(w))
    out += ["é 中文   tab\tend \U0001F600 <|endoftext|> x", "\x00 nul \x1f", "line one here now\n" * 4]
    table = [(i, t, ["en", None, "fr"][i % 3], ["a", "b", None][i % 3], len(t or ""), "k", "w", "r", 1, "g", "t", "h", "p", "n", 2)
             for i, t in enumerate(out)]
    again = [table[10], table[10], (None, table[12][1], *table[12][2:]), (None, None, *table[0][2:]),
             (3, "another text with the same number", *table[3][2:])]
    return table + again


def documents(spark, parts=7, **kw):
    return spark.createDataFrame(rows(**kw), SCHEMA).repartition(parts)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
